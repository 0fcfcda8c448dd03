import datetime as dt
import time

from pyspark.sql import functions as F

from corpusloom.operators.changelog import ChangeLog
from corpusloom.operators.dedupe import cap_per_key, keep_first
from corpusloom.settings import Settings
from corpusloom.streaming import crawl_stream as S


def feed(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(path))


def drain(df, tmp_path, mode="append"):
    name = f"q{time.time_ns()}"
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return df.sparkSession.table(name)


PAGES = [(1, "a.com", "Isi  satu"), (2, "a.com", "isi SATU"), (3, "b.com", "dua"), (4, "a.com", "tiga"), (5, "a.com", "empat")]
PAGE = "id long, host string, content string"


def test_streaming_dedupe_equals_batch(spark, tmp_path):
    feed(spark, tmp_path / "in", PAGES, PAGE)
    stream = spark.readStream.schema(PAGE).json(str(tmp_path / "in"))
    got = drain(S.first_contents(stream), tmp_path)
    batch = keep_first(spark.read.schema(PAGE).json(str(tmp_path / "in")).withColumn("fp", F.lower(F.regexp_replace("content", " +", " "))), ["fp"], ["id"])
    assert got.count() == batch.count() == 4


def test_streaming_cap_over_batches(spark, tmp_path):
    feed(spark, tmp_path / "in", PAGES[:2], PAGE)
    feed(spark, tmp_path / "in", PAGES[2:], PAGE)
    stream = spark.readStream.schema(PAGE).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    got = drain(S.capped(stream, 2), tmp_path).collect()
    assert len([r for r in got if r["host"] == "a.com"]) == 2 and len(got) == 3
    batch = cap_per_key(spark.read.schema(PAGE).json(str(tmp_path / "in")), ["host"], ["id"], 2)
    assert batch.count() == 3


def test_retries(spark, tmp_path):
    t = dt.datetime(2024, 1, 1)
    kind = "url_hash string, at timestamp, unit double"
    feed(spark, tmp_path / "in", [("h", t, 0.0), ("h", t + dt.timedelta(seconds=1), 1.0), ("h", t + dt.timedelta(seconds=2), 0.0), ("g", t, 0.5)], kind)
    stream = spark.readStream.schema(kind).json(str(tmp_path / "in"))
    got = {(r["url_hash"], r["attempts"]): (r["status"], r["retry_at"]) for r in drain(S.retries(stream, Settings()), tmp_path).collect()}
    assert got[("h", 1)] == ("pending", t + dt.timedelta(seconds=10)) and got[("h", 2)] == ("pending", t + dt.timedelta(seconds=26)) and got[("h", 3)] == ("failed", None)
    assert got[("g", 1)][1] == t + dt.timedelta(seconds=11.25)


def test_selector_cache_and_counts(spark, tmp_path):
    kind = "domain string, selector string, last_seen long, quality double"
    feed(spark, tmp_path / "in", [("a", ".x", 1, 0.5), ("a", ".y", 2, 0.6)], kind)
    feed(spark, tmp_path / "in", [("b", ".z", 1, 0.5), ("a", ".w", 1, 0.1)], kind)
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    S.each_batch(stream, S.selector_cache_step(str(tmp_path / "cache")), str(tmp_path / "cp")).awaitTermination(120)
    got = {r["domain"]: r["selector"] for r in ChangeLog(spark, str(tmp_path / "cache"), "domain", S.SELECTORS, 16).rows().collect()}
    assert got == {"a": ".y", "b": ".z"}
    feed(spark, tmp_path / "r", [("x",), (None,), ("x",)], "reject_reason string")
    counts = drain(S.outcome_counts(spark.readStream.schema("reject_reason string").json(str(tmp_path / "r"))), tmp_path, "complete")
    assert {r["outcome"]: r["n"] for r in counts.collect()} == {"x": 2, "accepted": 1}
    assert S.rescan_seconds(0.001) == 60.0


def test_worker_settles_jobs_over_batches_and_replays(spark, tmp_path):
    from corpusloom.operators import frontier
    from tests.test_crawl import prose

    path, kind = str(tmp_path / "crawl"), "id long, url string, html string, status int"
    jobs = spark.createDataFrame([(i, f"https://a.com/{i}", "pending", 0) for i in range(1, 8)], "id long, url string, status string, attempts int")
    have = set(jobs.columns)
    for field in frontier.SCHEMA.replace("map<string,string>", "map").split(", "):
        name, k = field.split(" ")
        if name not in have:
            jobs = jobs.withColumn(name, F.lit(None).cast("map<string,string>" if k == "map" else k))
    S.jobs_log(spark, path, 4).append(jobs, -1)
    page = lambda t: f"<article><p>{prose(t)}</p></article>"
    step = S.worker_step(path, now=F.expr("timestamp'2024-01-01 00:00:00'"), keywords=["guru"], buckets=4, keep=1)
    batches = [[(1, "https://a.com/1", page("satu"), 200), (2, "https://a.com/2", page("satu"), 200), (3, "https://a.com/3", None, 500)], [(4, "https://a.com/4", page("satu"), 200), (5, "https://a.com/5", page("lima"), 200), (1, "https://a.com/1", page("satu"), 200), (99, "https://a.com/99", page("x"), 200)]]
    for n, rows in enumerate(batches):
        for _ in range(2):  # the second time is a replay
            step(spark.createDataFrame(rows, kind), n)
    got = {r["id"]: (r["status"], r["last_error"]) for r in S.jobs_log(spark, path, 4).rows().collect()}
    assert got == {1: ("completed", None), 2: ("ignored", "duplicate_content"), 3: ("pending", "HTTP 500"), 4: ("ignored", "duplicate_content"), 5: ("completed", None), 6: ("pending", None), 7: ("pending", None)}
    assert sorted(r["id"] for r in spark.read.parquet(f"{path}/records/0", f"{path}/records/1").collect()) == [1, 5]
    assert [r["domain"] for r in ChangeLog(spark, f"{path}/selectors", "domain", S.SELECTORS, 4).rows().collect()] == ["a.com"]
    assert S.jobs_log(spark, path, 4).version == 2  # each replay found the log too long, and compacted what came before its batch
