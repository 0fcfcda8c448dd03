import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import ann


def brute(rows, every=20, k=20):
    ok = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok[i] = np.array(v, float)
    out = {}
    for q in (i for i in ok if i % every == 0):
        scored = sorted((-float((ok[q] * v).sum()), i) for i, v in ok.items() if i != q)
        out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def ours(df):
    out = {}
    for r in ann.query(df).orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, score int")


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8)]) for i in range(300)]
    rows += [(300 + i, rows[40][1]) for i in range(60)]  # copies of a query's vector
    rows += [(1000, None), (1020, [0.0] * 8), (1040, [float("nan")] * 8), (1060, [1.0] * 7 + [None]), (1080, []), (None, [1.0] * 8), (1100, [float("inf")] + [0.0] * 7)]
    got, want = ours(frame(spark, rows)), brute(rows)
    assert got.keys() == want.keys()
    for q, near in want.items():
        assert [i for i, _ in got[q]] == [i for i, _ in near]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in near], abs=1e-12)


def test_fewer_candidates_than_asked(spark):
    rows = [(i, [1.0, float(i)]) for i in (20, 21, 22)]
    assert {q: [i for i, _ in n] for q, n in ours(frame(spark, rows)).items()} == {20: [22, 21]}
    assert ours(frame(spark, [(20, [1.0])])) == {}


def test_norms_count(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6) * rng.uniform(0.1, 9)]) for i in range(200)]
    got, want = ours(frame(spark, rows)), brute(rows)
    assert {q: [i for i, _ in n] for q, n in got.items()} == {q: [i for i, _ in n] for q, n in want.items()}


def recall_of(got, x):
    found = []
    for q, near in got.items():
        s = x.astype(float) @ x[q].astype(float)
        s[q] = -np.inf
        found.append(len(near & set(np.argsort(-s)[:20].tolist())) / 20)
    return np.mean(found)


def test_recall_at_default_parameters(spark):
    x = np.random.default_rng(3).normal(size=(6000, 32)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for q, near in ours(df).items():
        got[q] = {i for i, _ in near}
        assert len(near) == 20 and [-s for _, s in near] == sorted(-s for _, s in near)
    assert len(got) == 300 and recall_of(got, x) >= 0.9


def test_queries_that_lie_apart_get_whole_lists(spark):
    rng = np.random.default_rng(12)
    sheet = rng.normal(size=(20_000, 3)) @ rng.normal(size=(3, 32)) + 0.01 * rng.normal(size=(20_000, 32))
    sheet[:4000:20] = rng.normal(size=(200, 32))  # 200 of 1,000 queries are off the sheet
    x = (sheet / np.linalg.norm(sheet, axis=1, keepdims=True)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {q: {i for i, _ in near} for q, near in ours(df).items()}
    assert len(got) == 1000 and all(len(near) == 20 for near in got.values())
    assert recall_of({q: n for q, n in got.items() if q < 4000}, x) >= 0.9 and recall_of(got, x) >= 0.9


def test_lengths_are_searched_apart(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(np.float32(v)) for v in rng.normal(size=4 if i % 3 else 5)]) for i in range(200)] + [(1000, [1.0] * 9), (1001, [2.0] * 7)]
    got, want = ours(frame(spark, rows)), {}
    for dim in (4, 5, 7, 9):
        want |= brute([r for r in rows if len(r[1]) == dim])
    assert {q: [i for i, _ in n] for q, n in got.items()} == {q: [i for i, _ in n] for q, n in want.items() if n}


def test_repeated_rows_count_once_and_an_id_may_have_two_vectors(spark):
    rows = [(20, [1.0, 0.0]), (20, [1.0, 0.0]), (21, [3.0, 1.0]), (21, [3.0, 1.0]), (21, [0.0, 5.0])]
    got = ours(frame(spark, rows))
    assert got == {20: [(21, 3.0), (21, 0.0)]}


def test_scored_rows_grow_far_slower_than_the_table():
    rng = np.random.default_rng(7)
    flat = rng.normal(size=(40_000, 4)) @ rng.normal(size=(4, 32))  # four dimensions inside 32
    top = float(np.linalg.norm(flat, axis=1).max())
    one = ann.fit(flat[:5_000], 40_000, top)  # fitted on an eighth
    home, found = one.forest.leaves(flat), []
    for q in flat[5_000:5_060]:
        scores = flat @ q
        visited = set(one.forest.visits(q, one.count))
        found.append(np.mean([any(v in visited for v in home[i].tolist()) for i in np.argsort(-scores)[1:21]]))
    assert np.mean(found) >= 0.9 and one.scored <= 10_000
    assert one.forest.depth > one.forest.filled
    assert ann.fit(flat[:5_000], 40_000_000, top).scored <= 50 * one.scored  # of a thousand times as many


def test_a_query_scores_no_more_rows_than_there_are():
    x = np.random.default_rng(8).normal(size=(9000, 96))  # hard: distances hardly differ
    for n in (100, 2000, 9000):
        assert ann.fit(x[:n], n, float(np.linalg.norm(x, axis=1).max())).scored <= n


def test_forest_assigns_every_vector_once_a_tree():
    x = np.random.default_rng(4).normal(size=(500, 5))
    f = ann.Forest(x, 10.0, 4, 3)
    leaves = f.leaves(x)
    assert leaves.shape == (500, 3) and ((leaves >> 4) == np.arange(3)).all()
    assert sorted(f.visits(x[0], 48)) == list(range(48))


def test_empty_table(spark):
    assert ann.query(frame(spark, [])).count() == 0
