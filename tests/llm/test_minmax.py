import numpy as np
import pytest

from corpusloom.llm import minmax
from corpusloom.llm.minmax import Scheme


def words_of(text, n):
    w = [x for x in "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()]
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute(rows, n, p, q):
    """doc_id to (set size, smallest id reachable), for distinct ids."""
    sets, root = [words_of(t, n) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and q * len(a & b) >= p * len(a | b):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (x, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), x), x)
    return {x: (len(sets[i]), least[find(i)]) for i, (x, _) in enumerate(rows)}


def planted(seed, n, copies=4):
    """Texts and copies with words replaced, so that similarities lie on both sides of the threshold."""
    rng = np.random.default_rng(seed)
    vocab, rows = [f"kata{i}" for i in range(3000)], []
    for _ in range(n):
        text = [vocab[i] for i in rng.integers(0, 3000, rng.integers(5, 300))]
        rows.append(text)
        for _ in range(copies):
            copy = list(text)
            for i in rng.choice(len(copy), min(len(copy), int(rng.integers(0, max(2, len(copy) // 20)))), replace=False):
                copy[i] = "lain"
            rows.append(copy)
    order = rng.permutation(len(rows))
    return [(int(i) * 3 + 1, " ".join(rows[k])) for i, k in enumerate(order)]


ODD = [(9001, ""), (9002, None), (9003, " \n\t"), (9004, "a b"), (9005, "A  b"), (9006, "a b c"), (9007, "É a b"), (9008, "é a b")]


@pytest.mark.parametrize("scheme", [Scheme(), Scheme(chunk=3, weight=300), Scheme(words=5, least=(4, 5), permutations=80)])
def test_equals_brute_force(spark, scheme):
    rows = planted(3, 50) + ODD
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["__id"]: (r["__n"], r["__component"]) for r in minmax.components(df, scheme=scheme).collect()}
    assert got == brute(rows, scheme.words, *scheme.least)


def test_query_on_the_tables(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    want = brute(rows, 3, 85, 100)
    got = minmax.query(docs).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_one_evaluation_gives_two_unbiased_values(spark):
    scheme, rng = Scheme(permutations=400), np.random.default_rng(1)
    pool = rng.integers(0, 1 << 64, 1200, np.uint64)
    low, high = zip(*(scheme.extremes(s) for s in (pool[:1000], pool[200:])), strict=True)
    same = [np.mean(low[0] == low[1]), np.mean(high[0] == high[1])]
    assert all(abs(x - 800 / 1200) < 0.08 for x in same)
    by_hand = (pool[:1000] ^ scheme.seeds[0][5]) * scheme.seeds[1][5]
    assert (low[0][5], high[0][5]) == (by_hand.min(), by_hand.max())


def test_large_group_of_copies_and_of_near_copies(spark):
    rng = np.random.default_rng(5)
    text = [f"kata{i}" for i in rng.integers(0, 3000, 120)]
    near = []
    for _ in range(300):
        copy = list(text)
        copy[int(rng.integers(120))] = f"x{rng.integers(10**9)}"
        near.append(" ".join(copy))
    rows = [(i, t) for i, t in enumerate([" ".join(text)] * 400 + near)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = minmax.components(df, scheme=Scheme(chunk=40, weight=6000)).collect()
    assert len(got) == 700 and {r["__component"] for r in got} == {0}


def test_odd_rows(spark):
    kind = "doc_id long, text string, __set string, a string"
    rows = [(None, "x y z", "p", "q"), (5, "x y z", "p", "q"), (5, "x y z", "p", "q"), (None, "sendiri saja ini", "", ""), (7, "kata " * 200_000, "", ""), (8, "kata " * 200_001, "", "")]
    got = minmax.query(spark.createDataFrame(rows, kind)).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in got) == [
        ("5", 1, "5", True), ("5", 1, "5", True), ("7", 1, "7", True), ("8", 1, "7", False), ("None", 1, "5", False), ("None", 1, "None", True),
    ]
    assert minmax.query(spark.createDataFrame([], kind)).count() == 0
