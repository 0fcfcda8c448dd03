import hashlib

from corpusloom.llm import line_dedup

ROWS = [
    (3, "Baris  yang sama\npendek\nBaris lain saja", 1), (1, " baris  yang SAMA \t\nsendiri di sini ya\npendek", 2), (2, "BARIS  YANG SAMA\nBaris  yang sama", 3), (4, None, 4), (5, "", 5), (6, "\n\n", 6),
    (7, "dua kali di satu\ndua kali di satu", 7), (3, "Baris  yang sama\npendek\nBaris lain saja", 1), (None, "sendiri di sini ya\nÉ baris unik nol", 8), (8, "É baris unik nol\nx", 9), (9, "0123456789\n012345678", 10), (10, "0123456789\n012345678", 11),
]


def key(line):
    s = line.strip(" \t\n\x0b\x0c\r")
    return "".join(c.lower() if c.isascii() else c for c in s)


def brute(rows):
    first = {}
    for i, t, _ in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                k = key(line)
                first[k] = i if k not in first else first[k] if i is None else i if first[k] is None else min(first[k], i)
    out = []
    for i, t, _ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or first[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_against_brute_force(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, __h int")
    got = sorted(map(tuple, line_dedup.query(df).collect()), key=str)
    assert got == sorted([(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute(ROWS)], key=str)


def test_applied_to_documents(spark):
    df = spark.createDataFrame([(*r[:2], 99, r[2]) for r in ROWS], "doc_id long, text string, n_chars long, __h int")
    out = line_dedup.dedup_lines(df)
    want = {(i, t) for i, _, d, t in brute(ROWS) if d}
    assert out.columns == df.columns and out.count() == len(ROWS)
    changed = [(r["doc_id"], r["text"], r["n_chars"]) for r in out.collect() if r["n_chars"] != 99]
    assert {c[:2] for c in changed} == want and all(n == len(t) for _, t, n in changed)


def test_hot_lines_take_the_other_way(spark):
    rows = [(i, f"baris yang sangat umum\nunik nomor {i} di sini", 0) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, x int")
    got = {r["doc_id"]: r["n_dropped"] for r in line_dedup.query(df).collect()}
    assert got == {i: int(i > 0) for i in range(300)}


def test_keep_runs(spark):
    df = spark.createDataFrame([([0, 1, 4], 6), ([5], 6), ([0], 1), ([2, 3], 6)], "d array<int>, n int")
    from pyspark.sql import functions as F

    got = [[tuple(x) for x in r[0]] for r in df.select(line_dedup.keep_runs(line_dedup.runs(F.col("d")), F.col("n"))).collect()]
    assert got == [[(2, 3), (5, 5)], [(0, 4)], [], [(0, 1), (4, 5)]]


def test_lines_around_the_hot_threshold_agree(spark, monkeypatch):
    """Hashes of 60 to 70 occurrences, all looked at: some are hot, some just below."""
    monkeypatch.setattr(line_dedup, "LOOK", 1)
    rows = [(i, "\n".join(f"baris bersama {k}" for k in range(60, 71) if i < k)) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {i: (n, d) for i, n, d, _ in brute([(*r, 0) for r in rows])}
    assert {r["doc_id"]: (r["n_lines"], r["n_dropped"]) for r in line_dedup.query(df).collect()} == want


def test_a_very_long_text(spark):
    text = "\n".join(f"baris panjang nomor {i % 50_000}" for i in range(100_000))
    df = spark.createDataFrame([(1, text), (2, text + "\nyang baru di sini")], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"]) for r in line_dedup.query(df).collect()}
    assert got == {1: (100_000, 0), 2: (100_001, 100_000)}


def test_empty_table(spark):
    assert line_dedup.query(spark.createDataFrame([], "doc_id long, text string")).count() == 0
