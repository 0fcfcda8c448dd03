"""The pipeline against plain Python, stage by stage, and its contract."""

import hashlib
from collections import Counter, defaultdict

import corpus_pipeline
from corpusloom.llm import mixing, quality
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_mixing import brute_targets
from tests.llm.test_near import brute as brute_near

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_brute_force(spark, data, tmp_path):
    docs, seen = spark.read.parquet(f"{data}/documents.parquet"), []
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, data).write.parquet(str(tmp_path / str(n)))
        seen.append((docs.collect(), spark.read.parquet(str(tmp_path / str(n)))))
        docs = seen[-1][1]
    for _, out in seen[:-1]:
        assert out.columns == COLUMNS
    by_id = lambda rows: {r["doc_id"]: r for r in rows}

    given, out = seen[0]
    labels = spark.read.parquet(f"{data}/labels.parquet")
    model = quality.train(spark.createDataFrame(given), labels)
    scores = {r["doc_id"]: r["__score"] for r in quality.scored(spark.createDataFrame(given), model).collect()}
    assert {tuple(r) for r in out.collect()} == {tuple(r) for r in given if scores[r["doc_id"]] >= 0.3}

    given, out = seen[1]
    want = {i: t for i, _, _, t in brute_lines([(r["doc_id"], r["text"], 0) for r in given])}
    assert {r["doc_id"]: r["text"] for r in out.collect()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in out.collect() if r["text"] != by_id(given)[r["doc_id"]]["text"])

    given, out = seen[2]
    given = sorted(given, key=lambda r: r["doc_id"])
    assert {r["doc_id"] for r in out.collect()} == brute_near([(r["doc_id"], r["text"]) for r in given])

    given, out = seen[3]
    sizes = defaultdict(int)
    for r in given:
        sizes[r["source"]] += len(r["text"].split())
    mixed = defaultdict(int)
    longest = {s: max(len(r["text"].split()) for r in given if r["source"] == s) for s in sizes}
    for r in out.collect():
        mixed[r["source"]] += len(r["text"].split())
        assert r["text"] == by_id(given)[r["doc_id"]]["text"]
    for s, t in brute_targets(dict(sizes)).items():
        assert abs(mixed[s] - t) <= longest[s] / 2 + 1
    times = Counter(r["doc_id"] for r in out.collect())
    assert max(times.values()) <= mixing.MAX_EPOCHS

    given, out = seen[4]
    rows = out.collect()
    assert sorted((r["doc_id"], r["text_sha256"]) for r in rows) == sorted((r["doc_id"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in given)
    assert all(r["lossless"] and r["n_pieces"] == len(r["pieces"]) for r in rows)


def test_run_and_edges(spark, data, tmp_path):
    assert corpus_pipeline.run(spark, data).count() > 0
    folder = tmp_path / "t"
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "satu dua tiga", "en", None, 3), (3, "kata " * 30_000, "en", "s", 9)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
    got = corpus_pipeline.run(spark, str(folder)).collect()
    assert all(r["lossless"] for r in got) and {3, None} <= {r["doc_id"] for r in got}
    empty = tmp_path / "e"
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(empty / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(empty / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(empty)).count() == 0
