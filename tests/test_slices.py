import pyarrow as pa

from corpusloom.functions import slices
from corpusloom.functions.slices import by_slices, pieces
from corpusloom.operators import journal


def test_pieces_are_bounded_by_rows_and_bytes():
    rows = pa.array(["x" * 10] * 150)
    assert [len(p[0]) for p in pieces((rows,))] == [64, 64, 22]
    large = pa.array(["x" * (slices.BYTES // 3)] * 5)
    assert [len(p[0]) for p in pieces((large,))] == [2, 2, 1]


def test_rows_keep_their_places(spark):
    both = by_slices(lambda m, t: {"a": (m or {}).get("k"), "n": None if t is None else len(t)}, "a string, n int")
    df = spark.range(0, 1000, 1, 3).selectExpr("id", "CASE WHEN id % 3 > 0 THEN map('k', cast(id as string)) END AS m", "CASE WHEN id % 7 > 0 THEN repeat('x', cast(id as int)) END AS t")
    rows = df.select("id", both("m", "t").alias("r")).collect()
    assert len(rows) == 1000 and all(r["r"]["a"] == (str(r["id"]) if r["id"] % 3 else None) and r["r"]["n"] == (r["id"] if r["id"] % 7 else None) for r in rows)
    assert df.where("id < 0").select(both("m", "t")).collect() == []


def test_a_page_of_the_experiment_is_parsed_once(spark, data):
    rows = journal.experiment_records(spark.read.parquet(f"{data}/pages.parquet"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("run(html") == 1 and plan.count("ArrowEvalPython ") == 2
