import random
from collections import defaultdict

import pytest

from corpusloom.llm import mixing


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size string")


def rows(seed=1, n=300):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        source = rng.choices(["a", "b", "c", "é", None], [30, 3, 10, 2, 4])[0]
        out.append((i, " ".join(["kata"] * rng.choice([0, 1, 5, 50, 400])) + rng.choice(["", "\n"]), "id", source, 1, "x"))
    return [*out, (None, "tanpa nama", "id", "a", 1, "x"), (9999, None, "id", "b", None, "x"), out[7], out[7]]


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest, free = total - sum(3 * sizes[s] for s in capped), [s for s in names if s not in capped]
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return {s: 3.0 * sizes[s] if s in capped else share[s] for s in names}
        capped |= over


def test_targets_and_words_taken(spark):
    data = rows()
    got = mixing.query(table(spark, data)).collect()
    assert len(got) == len(data)
    of = {i: s for i, _, _, s, _, _ in data if i is not None}
    sizes, taken, targets = defaultdict(int), defaultdict(int), {}
    for r in got:
        s = of[r["doc_id"]] if r["doc_id"] is not None else "a"
        sizes[s] += r["size"]
        taken[s] += r["taken"]
        targets[s] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    want = brute_targets(dict(sizes))
    for s in sizes:
        assert targets[s] == pytest.approx(want[s])
        assert abs(taken[s] - targets[s]) <= 1
    again = mixing.query(table(spark, data).repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mixed_documents_are_whole_and_near_the_target(spark):
    data = rows(2)
    df = table(spark, data)
    targets = {s: t for s, t in mixing.mix(df).select("source", "target").distinct().collect()}
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    got, words = out.collect(), defaultdict(int)
    assert {r["text"] for r in got} <= {t for _, t, *_ in data}
    for r in got:
        words[r["source"]] += len((r["text"] or "").split())
    assert words.keys() == targets.keys() and all(abs(words[s] - t) <= 201 for s, t in targets.items())
    assert any(not (r["text"] or "").split() for r in got)  # texts without words are sampled too


def test_a_place_of_many_rows_is_dealt_out_row_by_row(spark):
    """A third of the rows are equal and without id, and the border falls among them."""
    data = [(None, "sama sama saja", "id", "a", 3, "x")] * 400 + [(i, "kata lain", "id", "a", 2, "x") for i in range(400)] + [(i, "b " * 9, "id", "b", 9, "x") for i in range(1000, 1400)]
    got = mixing.mix(table(spark, data)).collect()
    total = sum(r["whole"] * r["size"] + r["part"] for r in got if r["source"] == "a")
    assert len(got) == 1200 and abs(total - [r["target"] for r in got if r["source"] == "a"][0]) <= 1
    same = [r["part"] for r in got if r["doc_id"] is None]
    assert len(same) == 400 and sum(0 < p < 3 for p in same) <= 1


def test_a_very_long_text(spark):
    data = [(1, "kata " * 300_000, "id", "a", 1, "x"), (2, "dua kata", "id", "b", 1, "x")]
    got = {r["doc_id"]: (r["size"], r["taken"]) for r in mixing.query(table(spark, data)).collect()}
    assert got[1][0] == 300_000 and got[2] == (2, 6) and abs(got[1][1] - 299_996) <= 1


def test_one_source_and_no_words(spark):
    one = [(i, "a b c", "id", "s", 5, "x") for i in range(5)]
    assert sum(r["taken"] for r in mixing.query(table(spark, one)).collect()) == 15
    none = [(1, "", "id", "s", 0, "x"), (2, None, "id", None, 0, "x")]
    assert [r["taken"] for r in mixing.query(table(spark, none)).collect()] == [0, 0]
    assert mixing.mixed_documents(table(spark, none)).count() == 0


def test_empty_table(spark):
    assert mixing.query(table(spark, [])).count() == 0
