from dataclasses import replace

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from corpusloom.llm import near, simhash


def shingle_set(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets, root = [shingle_set(t or "") for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a == sets[j] or 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return {rows[i][0] for i in range(len(rows)) if find(i) == i}


def corpus(n=60):
    rng = np.random.default_rng(4)
    words = [f"kata{i}" for i in range(5000)]
    rows = []
    for _ in range(n):
        text = [words[i] for i in rng.integers(0, 5000, rng.integers(60, 400))]
        rows.append(text)
        for cuts in (1, 2, 3, 5, 8, 12):
            copy = list(text)
            for i in rng.choice(len(copy), cuts, replace=False):
                copy[i] = "lain"
            rows.append(copy)
    return [(i, " ".join(t)) for i, t in enumerate(rows)] + [(9000, ""), (9001, None), (9002, "a b"), (9003, "A  b")]


def test_stage_keeps_one_of_each_group_of_similar_texts(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    stage = dict(corpus_pipeline.STAGES)["simhash near-dedup"]
    assert {r["doc_id"] for r in stage(spark, df, "").collect()} == brute(rows)


def test_heavy_groups_are_cut_into_cells_without_loss(spark):
    rows = corpus(12)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["i"] for r in near.groups(df, scheme=replace(near.SCHEME, weight=500, chunk=4, whole=7)).select(F.col("__b.i").alias("i")).collect()} == brute(rows)


def test_recall_on_planted_pairs(spark):
    """Pairs of a similarity between 0.8 and 0.95, far from all others: the second of each pair goes."""
    rng, rows = np.random.default_rng(9), []
    while len(rows) < 600:
        text = [f"k{i}" for i in rng.integers(0, 100_000, rng.integers(80, 500))]
        copy = list(text)
        for i in rng.choice(len(copy), max(1, len(copy) // int(rng.integers(45, 130))), replace=False):
            copy[i] = "lain"
        a, b = shingle_set(" ".join(text)), shingle_set(" ".join(copy))
        if 0.8 <= len(a & b) / len(a | b) <= 0.95:
            rows += [(len(rows), " ".join(text)), (len(rows) + 1, " ".join(copy))]
    kept = {r["doc_id"] for r in near.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == set(range(0, 600, 2))
    close = near.close_fingerprints(spark.createDataFrame([(i, 1, int(np.array([simhash.fingerprint(t.encode(), 5)], np.uint64).view(np.int64)[0])) for i, t in rows], "__set long, __n long, __fp long"))
    assert 30 < close.where("b = a + 1 OR a = b + 1").count() < 300  # what operator 4 alone would find


def test_very_long_and_short_texts(spark):
    long = " ".join(f"k{i % 70_000}" for i in range(300_000))
    rows = [(1, long), (2, long + " lain"), (3, "k1 k2"), (4, "K1  k2"), (5, "\n"), (6, None)]
    kept = near.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in kept} == {1, 3, 5}


def test_repeated_rows_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(1, "x y z", "a"), (1, "x y z", "b"), (None, "x y z", "c"), (None, "sendiri", "d")], "doc_id long, text string, n string")
    kept = near.one_of_each(df).collect()
    assert len(kept) == 2 and {r["doc_id"] for r in kept} == {1, None} and kept[0].__fields__ == ["doc_id", "text", "n"]
    assert near.one_of_each(df.limit(0)).count() == 0
