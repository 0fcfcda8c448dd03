import numpy as np
import xxhash
from pyspark.sql import functions as F

from corpusloom.llm import simhash
from corpusloom.llm.components import connected_components


def brute_fingerprint(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(prints))]


def test_fingerprints(spark):
    texts = ["", None, " \n", "Satu", "a b c", "a b c d", "a b c d e f a b c d", "É é A\x0bb", "x y " * 40_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["fingerprint"] for r in simhash.query(df).collect()}
    assert got == {i: f"{brute_fingerprint(t):016x}" for i, t in enumerate(texts)}


def test_hash_is_sparks(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b c d"))).first()[0] == np.array([xxhash.xxh64_intdigest(b"a b c d", 42)], np.uint64).view(np.int64)[0]


def planted(seed, n, spread):
    rng = np.random.default_rng(seed)
    centres = [int(x) for x in rng.integers(0, 1 << 63, 4)]
    out = []
    for _ in range(n):
        x = centres[rng.integers(4)]
        for b in rng.choice(64, rng.integers(0, spread), replace=False):
            x ^= 1 << int(b)
        out.append(x)
    return [*out, *(int(x) for x in rng.integers(0, 1 << 63, 50)), 0, (1 << 64) - 1]


def check(spark, prints, chunk):
    signed = [int(np.array([p], np.uint64).view(np.int64)[0]) for p in prints]
    df = spark.createDataFrame([(p,) for p in set(signed)], "__fp long")
    got = {r["node"]: r["root"] for r in connected_components(simhash.links(df, chunk=chunk)).collect()}
    want = brute_components(prints)
    groups = {}
    for p, w in zip(signed, want, strict=True):
        groups.setdefault(w, set()).add(p)
    big = {frozenset(g) for g in groups.values() if len(g) > 1}
    ours = {}
    for n, r in got.items():
        ours.setdefault(r, set()).add(n)
    assert {frozenset(g) for g in ours.values()} == big


def test_links_connect_what_brute_force_connects(spark):
    check(spark, planted(1, 300, 6), simhash.CHUNK)


def test_hot_keys_are_cut_into_cells_without_loss(spark):
    check(spark, planted(2, 400, 9), 40)


def test_components_name_the_smallest_id(spark):
    long = " ".join(f"kata{i}" for i in range(400))
    rows = [(7, long, "a"), (3, long, "b"), (9, long + " lagi", "c"), (None, long, "d"), (5, "", "e"), (6, None, "f"), (8, "lain sekali ini", "g"), (7, long, "a"), (None, "sendiri saja di sini", "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, __fp string")
    got = {(r["doc_id"], r["component_id"]) for r in simhash.query(df).collect()}
    assert got == {(7, 3), (3, 3), (9, 3), (None, 3), (5, 5), (6, 5), (8, 8), (None, None)}
    kept = simhash.one_of_each(df).collect()
    assert sorted(r["__fp"] for r in kept) == ["b", "e", "g", "h"] and kept[0].__fields__ == ["doc_id", "text", "__fp"]


def test_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5000)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert len({got[i] for i in range(301)}) == 1 and len({got[1000 + i] for i in range(200)}) == 1 and got[0] != got[1000] and 5000 in got


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.query(df).count() == 0 and simhash.one_of_each(df).count() == 0


def test_components_by_one_task_are_those_by_rounds(spark):
    rng = np.random.default_rng(8)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(1000 + i, 1001 + i) for i in range(40)] + [(7, 7)]
    df, parts = spark.createDataFrame(edges, "a long, b long"), []
    for whole in (0, 50, 10_000):
        by = {}
        for r in connected_components(df, whole).collect():
            by.setdefault(r["root"], set()).add(r["node"])
        parts.append(sorted(map(sorted, by.values())))
    assert parts[0] == parts[1] == parts[2] and sum(map(len, parts[0])) == len({x for e in edges for x in e})
