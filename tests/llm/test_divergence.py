import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
KIND = "doc_id long, text string, lang string, source string"


def brute(rows, least=30):
    docs = defaultdict(list)
    for _, text, lang, source in rows:
        docs[lang or "", source or ""].append(["".join(c.lower() if c.isascii() else c for c in t) for t in TERM.findall(text or "")])
    out = set()
    for lang in {k[0] for k in docs}:
        own = {s: d for (x, s), d in docs.items() if x == lang}
        df = Counter(t for d in own.values() for words in d for t in set(words))
        kept = {t for t, n in df.items() if n >= least}
        tf = {s: Counter(t for words in d for t in words if t in kept) for s, d in own.items()}
        share = lambda c: (lambda n: {t: 1 + 10**9 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept})(sum(c.values()))
        p, q = {s: share(c) for s, c in tf.items()}, share(sum(tf.values(), Counter()))
        for s in own:
            pairs = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in own if o != s)
            terms = sorted((q[t] - p[s][t], t.encode(), t) for t in kept if tf[s][t] and p[s][t] > q[t])
            out |= {(lang, s, "pair", o, -f, i + 1) for i, (f, _, o) in enumerate(pairs)}
            out |= {(lang, s, "term", t, -f, i + 1) for i, (f, _, t) in enumerate(terms[:50])}
    return out


def got(df):
    rows = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def corpus(seed, docs, sources):
    rng, out = np.random.default_rng(seed), []
    vocab = np.array([f"{'kata' if i % 3 else 'Élan'}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)])
    for i in range(docs):
        s = int(rng.integers(sources)) if rng.random() < 0.6 else 0
        words = vocab[np.minimum(rng.zipf(1.3, rng.integers(0, 60)) + s, 299)]
        out.append((i, " ".join(words) + ("\n1st-Class don't" if i % 2 else ""), ["en", "de", None][i % 3], None if s == 1 else f"s{s}"))
    return out


@pytest.mark.parametrize("how", [{}, {"pods": 4, "slice_terms": 16}, {"pods": 2, "slice_terms": 7, "budget": 20}])
def test_equals_brute_force(spark, how):
    rows = corpus(1, 400, 13)
    df = spark.createDataFrame(rows, KIND)
    assert got(divergence.audit(df, least=5, **how)) == brute(rows, 5)


def test_query_on_the_tables(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]
    assert got(divergence.query(docs)) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, None, None, None), (1, "", "xx", "a"), (1, "", "xx", "a"), (2, "sendiri", "xx", "b"), (3, "saja " * 300_000, "yy", "a")]
    wide = spark.createDataFrame(rows, KIND).withColumn("term", F.lit("x")).withColumn("slice", F.lit(1))
    assert got(divergence.audit(wide, least=1)) == brute(rows, 1)
    assert got(divergence.audit(wide)) == brute(rows) == {("xx", "a", "pair", "b", 0, 1), ("xx", "b", "pair", "a", 0, 1)}
    assert divergence.query(wide.limit(0)).count() == 0


def test_every_two_pods_meet_once(spark):
    for pods in (2, 4, 16):
        rows = spark.range(pods).withColumnRenamed("id", "p").crossJoin(spark.range(pods - 1).withColumnRenamed("id", "t"))
        met = [(r["p"], r["o"], r["t"]) for r in rows.withColumn("o", divergence.partner(F.col("p"), F.col("t"), pods)).collect()]
        assert all((o, p, t) in met and o != p for p, o, t in met)
        assert sorted((p, o) for p, o, _ in met) == [(p, o) for p in range(pods) for o in range(pods) if o != p]


def test_shares_are_exact_beyond_64_bits(spark):
    row = spark.range(1).select(divergence.share(F.lit(10**14), F.lit(3 * 10**14)).alias("p")).first()
    assert row["p"] == 1 + 10**9 * (10**14 + 5) // (3 * 10**14)
