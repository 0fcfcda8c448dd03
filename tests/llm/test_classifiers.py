import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import language, quality

BIG = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{BIG}/documents.parquet").cache()


def test_quality_on_held_out_rows(spark, docs):
    labels = spark.read.parquet(f"{BIG}/labels.parquet")
    rows = quality.query(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.93
    assert np.mean([r["predicted"] for r in rows if r["quality"] == 1]) > 0.97


def test_compiled_rules_equal_their_meaning(spark):
    model = quality.RuleEnsemble(0.5, [(1.25, (("a", 0.3, True), ("b", 2.0, False))), (-2.0, (("a", 0.1, False),))], [(0.7, "b", 0.0, 3.0)])
    rows = [(a / 10, float(b)) for a in range(6) for b in range(-1, 6)]
    got = [r[0] for r in spark.createDataFrame(rows, "a double, b double").select(model.score()).collect()]
    for (a, b), s in zip(rows, got, strict=True):
        z = 0.5 + 1.25 * (a <= 0.3 and b > 2.0) - 2.0 * (a > 0.1) + 0.7 * min(max(b, 0.0), 3.0)
        assert s == pytest.approx(1 / (1 + np.exp(-z)))


def test_lasso_is_sparse_and_fits():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(800, 12))
    y = (1 / (1 + np.exp(-3 * x[:, 4])) > rng.random(800)).astype(float)
    w, _ = quality._lasso(x, y, 0.05)
    assert w[4] > 0.5 and (np.abs(np.delete(w, 4)) < 1e-9).sum() >= 9


def test_quality_edges(spark):
    rows = [(1, None, 1), (2, "", 2), (None, "teks", 3), (3, "kata " * 100_000, 4), (3, "kata", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __score int")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in quality.query(df, none).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1), (2, None), (None, 0), (3, 1), (3, 1)], "doc_id long, quality int")
    assert all(0.5 < r["score"] <= 1 and r["predicted"] == 1 for r in quality.query(df, one).collect())
    assert quality.query(df.limit(0), one).count() == 0


def test_language_on_held_out_rows(spark, docs):
    rows = language.query(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_edges(spark):
    rows = [(i, "the and of was were", "en", 0) for i in range(20)] + [(100 + i, "der die und nicht", "de", 0) for i in range(20)]
    rows += [(300, None, "en", 0), (301, "", None, 0), (302, "123 !!", "en", 0), (None, "the and of", "en", 0), (303, "the and of was " * 20_000, None, 0), (304, "DER DIE UND", None, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, __score int")
    got = {r["doc_id"]: r["lang_pred"] for r in language.query(df).collect()}
    assert got[300] == got[301] == got[302] == "und" and got[303] == "en" and got[304] == "de" and got[None] == "en"
    assert language.query(df.limit(0)).count() == 0
    assert {r["lang_pred"] for r in language.query(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_pair_tables_are_the_filters():
    rng = np.random.default_rng(0)
    model = language.ByteCnn(["a"], [rng.normal(size=(k, 256, language.FILTERS)) for k in language.WIDTHS], np.zeros(24), np.zeros((24, 1)), np.zeros(1))
    x = rng.integers(0, 256, (3, language.WINDOW)).astype(np.uint8)
    want = [max(sum(f[j][x[w, p + j], c] for j in range(k)) for p in range(language.WINDOW - k + 1)) for w in range(3) for k, f in zip(language.WIDTHS, model.filters, strict=True) for c in range(language.FILTERS)]
    assert np.allclose(language._maxima(model.pair_tables(), x).ravel(), want, atol=1e-4)


def test_windows_cover_the_text():
    assert [language.windows(b"x" * n).shape[0] for n in (0, 1, 256, 257)] == [1, 1, 1, 2]
    assert language.windows(b"ab" * 200).tobytes().rstrip(b"\0") == b"ab" * 200


def plain_statistics(text):
    """The quality statistics in plain Python."""
    n, lines = max(len(text), 1), text.split("\n")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    count = lambda chars: sum(c in chars for c in text) / n
    import unicodedata

    return {
        "log_chars": np.log1p(len(text)), "word_len": n / (len(words) + 1), "line_len": n / len(lines), "upper": sum(unicodedata.category(c) == "Lu" for c in text) / n,
        "digit": count("0123456789"), "symbol": count("#$%&*+<=>@^_`~\\{}[]"), "pipe": count("|"), "shout": count("!"), "stop": count("."), "comma": count(","),
        "same_lines": 1 - len(set(lines)) / len(lines), "word_kinds": len(set(text.split(" "))) / (len(words) + 1), "closed_lines": sum(x.endswith(".") for x in lines) / len(lines),
    }


def plain_quality(model, text):
    s = plain_statistics(text)
    z = model.intercept + sum(w * all((s[n] <= b) == below for n, b, below in path) for w, path in model.rules) + sum(w * min(max(s[n], a), b) for w, n, a, b in model.linear)
    return 1 / (1 + np.exp(-min(max(z, -40), 40)))


def test_quality_scores_against_plain_python(spark, docs):
    labels = spark.read.parquet(f"{BIG}/labels.parquet")
    model = quality.train(docs, labels)
    assert model.rules and model.linear
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    got = {r["doc_id"]: (r["score"], r["predicted"]) for r in quality.query(docs, labels).collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        want = plain_quality(model, text)
        assert got[i][0] == pytest.approx(want, abs=1e-6) and (abs(want - 0.3) < 1e-6 or got[i][1] == (want >= 0.3))


def plain_language(model, text):
    """Label and score by sliding every filter over every window, byte by byte."""
    data = text.encode().lower()
    if not any(c.isalpha() for c in text):
        return "und", 0.0
    total = np.zeros(len(model.labels))
    for a in range(0, max(len(data), 1), language.WINDOW):
        part = data[a : a + language.WINDOW]
        x = part.ljust(language.WINDOW, b"\0")
        top = []
        for k, f in zip(language.WIDTHS, model.filters, strict=True):
            top += np.max([sum(f[j][x[p + j]] for j in range(k)) for p in range(language.WINDOW - k + 1)], axis=0).tolist()
        top = np.array(top) + model.bias
        z = np.maximum(top, 0.1 * top) @ model.dense + model.dense_bias
        total += len(part) * (z - z.max() - np.log(np.exp(z - z.max()).sum()))
    total /= len(data)
    p = np.exp(total - total.max())
    return model.labels[int(np.argmax(p))], float(p.max() / p.sum())


def test_language_scores_against_a_plain_forward_pass(spark, docs):
    some = docs.orderBy(F.length("text").desc(), "doc_id").limit(3).unionByName(docs.where("doc_id % 25 = 1")).unionByName(spark.createDataFrame([(10**9, "Ärger übel", None, None, 1), (10**9 + 1, "1 2", None, None, 1)], docs.schema))
    model = language.train(docs)
    got = {r["__id"]: (r["__lang"], r["__score"]) for r in language.predicted(some, model).collect()}
    for r in some.collect():
        label, score = plain_language(model, r["text"] or "")
        assert got[r["doc_id"]][0] == label and got[r["doc_id"]][1] == pytest.approx(score, abs=2e-3)


def test_all_bytes_of_wide_characters_are_learned():
    """Only what stands beyond the first window's bytes tells these languages apart."""
    texts = [("ა" * 90 + ("ბ" if i % 2 else "გ") * 90).encode() for i in range(400)]
    model = language.fit(texts, ["xx" if i % 2 else "yy" for i in range(400)])
    assert [plain_language(model, "ა" * 90 + c * 90)[0] for c in "ბგ"] == ["xx", "yy"]


def test_sparse_labels_of_two_languages(spark):
    rows = spark.range(400_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 20_000 < 10_000, "the and of was were").otherwise("der die und nicht auch").alias("text"), F.when(F.col("id") % 10_000 == 1, F.when(F.col("id") % 20_000 < 10_000, "en").otherwise("de")).alias("lang"))
    assert rows.where("lang IS NOT NULL").count() == 40
    assert language.train(rows).labels == ["de", "en"]


def test_labels_of_other_documents_change_nothing(spark, docs):
    few = spark.read.parquet(f"{BIG}/labels.parquet").select("doc_id", "quality")
    wide = few.unionByName(spark.range(10**6, 10**6 + 60_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality")))
    models = [quality.train(docs, labels, sample=200) for labels in (few, wide)]
    assert models[0] == models[1] and (models[0].rules or models[0].linear)
