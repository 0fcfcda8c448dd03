import os
import re

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import frontier
from corpusloom.operators.changelog import ChangeLog
from corpusloom.queries import _jobs



def now():
    return F.expr("timestamp'2024-01-15 00:00:00'")


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def logged(rows):
    return sorted((r["id"], r["status"], r["attempts"], r["last_error"], r["title"]) for r in rows.collect())


@pytest.fixture
def jobs(spark, data):
    return _jobs(spark, data)


def test_frontier_operators_on_the_log_equal_those_on_the_table(spark, jobs, tmp_path):
    log = ChangeLog(spark, str(tmp_path / "f"), "id", frontier.SCHEMA, 4)
    log.append(jobs, 0)
    table = jobs
    done = jobs.where("id % 50 = 1").select("id", F.lit("t").alias("title"), F.lit("c").alias("content_markdown"), F.create_map(F.lit("k"), F.lit("v")).alias("metadata"))
    lost = jobs.where("id % 50 IN (1, 2)").select("id", F.lit("HTTP 500").alias("error"))
    new = spark.createDataFrame([("https://neu.example.org/a",)], "url string")
    for n, step in enumerate((lambda t: frontier.complete(t, done, now()), lambda t: frontier.fail(t, lost, now()))):
        keys = (done, lost)[n].select("id")
        log.append(step(log.rows(keys)), n + 1)
        table = step(table)
    made = frontier.enqueue(table, new, now())
    log.append(made, 3)
    table = table.unionByName(made)
    assert logged(log.rows()) == logged(table)
    log.compact()
    assert logged(log.rows()) == logged(table) and log.batches() == 0
    again = ChangeLog(spark.newSession(), str(tmp_path / "f"), "id", frontier.SCHEMA, 4)  # whose catalog is empty but for the folders
    assert again.version == 1 and logged(again.rows()) == logged(table)
    assert log.vacuum() == [0] and not os.path.exists(tmp_path / "f" / "base" / "0") and logged(log.rows()) == logged(table)


def test_no_side_of_the_frontier_is_shuffled(spark, jobs, tmp_path):
    log = ChangeLog(spark, str(tmp_path / "f"), "id", frontier.SCHEMA, 16)
    log.append(jobs, 0)
    log.compact()
    log.append(jobs.where("id % 9 = 0"), 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys = spark.range(0, 1000, 7)
        plan = frontier.ignore(log.rows(keys), keys.withColumn("reason", F.lit("x")), now())._jdf.queryExecution().executedPlan().toString()
        whole = log.rows()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in whole

    def depth(line):
        return len(re.match(r"[\s:|+*-]*", line)[0])

    lines = plan.split("\n")
    for i, line in enumerate(lines):
        if "Scan parquet" in line and "changes_" in line:
            at = depth(line)
            for above in reversed(lines[:i]):
                if depth(above) < at:
                    at = depth(above)
                    assert "Exchange" not in above, plan
                    if "Join" in above:  # what is above holds the rows asked for only
                        assert "LeftSemi" in above
                        break
    assert "Scan parquet" in plan and "Exchange" in plan  # of the keys


def test_a_batch_writes_by_its_changes_and_a_replay_nothing_more(spark, tmp_path):
    kind = "id long, status string, body string"
    log = ChangeLog(spark, str(tmp_path / "f"), "id", kind, 4)
    log.append(spark.range(20_000).select("id", F.lit("pending").alias("status"), F.sha2(F.col("id").cast("string"), 512).alias("body")), 0)
    log.compact()
    whole = size(tmp_path / "f")
    few = log.rows(spark.range(40)).withColumn("status", F.lit("completed"))
    log.append(few, 1)
    once = size(tmp_path / "f") - whole
    assert once < whole / 50
    log.append(few, 1)
    assert size(tmp_path / "f") - whole == once and log.batches() == 1
    log.append(log.rows(spark.range(10)).withColumn("status", F.lit("failed")), 2)
    got = {r["status"]: r["n"] for r in log.rows().groupBy("status").agg(F.count("*").alias("n")).collect()}
    assert got == {"pending": 19_960, "completed": 30, "failed": 10}


def test_keys_of_text_and_an_empty_log(spark, tmp_path):
    log = ChangeLog(spark, str(tmp_path / "s"), "domain", "domain string, selector string", 2)
    assert log.rows().count() == 0 and log.batches() == 0
    log.append(spark.createDataFrame([("a", ".x"), ("b", None)], "domain string, selector string"), 5)
    asked = spark.createDataFrame([("a",), ("a",), ("z",), (None,)], "domain string")
    assert [tuple(r) for r in log.rows(asked).collect()] == [("a", ".x")]
