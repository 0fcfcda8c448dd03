from pyspark.sql import functions as F

from corpusloom.plans import crawl
from corpusloom.settings import Settings
from corpusloom.sources.archive import archived_pages, record, write_archive


def one(url, status, body, kind="response", head="", extra=0):
    response = b"HTTP/1.1 " + status + b"\r\n" + head.encode() + b"\r\n" + body
    uri = f"WARC-Target-URI: {url}\r\n" if url else ""
    return f"WARC/1.0\r\nWARC-Type: {kind}\r\n{uri}WARC-Date: 2024-01-15T01:02:03Z\r\nContent-Length: {len(response) + extra}\r\n\r\n".encode() + response + b"\r\n\r\n"


def test_records_of_every_kind(spark, tmp_path):
    html = "<p>é 日本\r\n\r\nlagi</p>"
    data = one(None, b"200 OK", b"x", kind="warcinfo") + one("http://a/1", b"200 OK", html.encode()) + one("http://a/2", b"404 Not Found", b"gone", head="content-type: text/html\r\n")
    data += one("http://a/3", b"200 OK", "é".encode("latin-1"), head="Content-Type: text/html; charset=ISO-8859-1\r\n") + one("http://a/4", b"200 OK", b"\xff\xfe?")
    data += one(None, b"200 OK", b"x") + one("http://a/5", b"200 OK", b"short", extra=9) + one("http://a/6", b"nonsense", b"x") + one("http://a/7", b"200 OK", b"")
    (tmp_path / "x.warc").write_bytes(data)
    got = {r["url"]: (r["status"], r["html"], r["error"]) for r in archived_pages(spark, str(tmp_path)).collect()}
    assert got == {
        "http://a/1": (200, html, None), "http://a/2": (404, "gone", None), "http://a/3": (200, "é", None), "http://a/4": (200, "��?", None), "http://a/7": (200, "", None),
        None: (None, None, "record without URL"), "http://a/5": (None, None, "record of another length"), "http://a/6": (None, None, "no status line"),
    }
    assert {str(r["fetched_at"]) for r in archived_pages(spark, str(tmp_path)).collect()} == {"2024-01-15 01:02:03"}


def test_several_tasks_read_what_one_does(spark, data, tmp_path):
    pages = spark.read.parquet(f"{data}/pages.parquet")
    write_archive(pages.coalesce(1).select(record(F.col("url"), F.lit(200), F.col("html"))), str(tmp_path / "a"))
    want = sorted((r["url"], r["html"]) for r in pages.collect())
    for size in ("128m", "3000", "977"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
        try:
            rows = archived_pages(spark, str(tmp_path / "a"))
            tasks = rows.rdd.getNumPartitions()
            got = rows.collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
            spark.conf.unset("spark.sql.files.minPartitionNum")
        assert (tasks == 1) == (size == "128m") and sorted((r["url"], r["html"]) for r in got) == want and all(r["error"] is None for r in got)


def test_the_crawl_takes_archived_pages(spark, tmp_path):
    (tmp_path / "x.warc").write_bytes(one("http://a.id/1", b"500 X", b"") + one("http://a.id/2", b"200 OK", b"<p>pendek</p>") + one("http://a.id/3", b"200 OK", b"x", extra=1))
    pages = archived_pages(spark, str(tmp_path)).withColumn("id", F.xxhash64("url"))
    got = {r["url"]: r["reject_reason"] for r in crawl.curated(pages, s=Settings()).collect()}
    assert got["http://a.id/1"] == "HTTP 500" and got["http://a.id/2"] == "no_content" and got["http://a.id/3"] == "fetch:record of another length"


def test_columns_that_nobody_asks_for_are_not_made(spark, tmp_path):
    (tmp_path / "x.warc").write_bytes(one("http://a/1", b"200 OK", b"x"))
    plan = archived_pages(spark, str(tmp_path)).select("url", "fetched_at")._jdf.queryExecution().optimizedPlan().toString()
    assert "make_valid_utf8" not in plan and "validate" not in plan.lower()
