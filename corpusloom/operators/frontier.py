"""The crawl frontier as a table: enqueue, claim, complete, ignore, fail and retry, count.

Rows: id, url_hash, url, domain, status, title, content_markdown, metadata,
created_at, updated_at, attempts, next_retry_at, last_error, priority. Every
operator returns a new table; time and jitter come from outside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import urls as U
from corpusloom.operators.dedupe import cap_per_key
from corpusloom.settings import Settings

SCHEMA = "id long, url_hash string, url string, domain string, status string, title string, content_markdown string, metadata map<string,string>, created_at timestamp, updated_at timestamp, attempts int, next_retry_at timestamp, last_error string, priority int"


def enqueue(jobs: DataFrame, urls: DataFrame, now: Column, whitelist: list[str] = (), priority: Column | None = None) -> DataFrame:
    """The new rows for ``urls`` (url): normalised, valid, whitelisted, not in ``jobs``, once each."""
    new = urls.select(U.normalize_url(F.col("url")).alias("url"))
    new = new.where((F.col("url") != "") & U.is_valid_crawl_url(F.col("url")) & U.in_whitelist(F.col("url"), list(whitelist)))
    new = new.dropDuplicates(["url"]).withColumn("url_hash", U.url_hash(F.col("url")))
    new = new.join(jobs.select("url_hash"), "url_hash", "left_anti")
    made = {
        "id": F.xxhash64("url_hash"), "domain": U.host(F.col("url")), "status": F.lit("pending"), "created_at": now, "updated_at": now,
        "attempts": F.lit(0), "priority": priority if priority is not None else U.url_priority(F.col("url")),
    }
    fields = [f.strip().rsplit(" ", 1) for f in SCHEMA.replace("map<string,string>", "map").split(",")]
    kinds = {n: ("map<string,string>" if k == "map" else k) for n, k in fields}
    return new.select(*[(made.get(n) if n in made else F.col(n) if n in new.columns else F.lit(None)).cast(k).alias(n) for n, k in kinds.items()])


def ready(now: Column, whitelist: list[str] = ()) -> Column:
    return (F.col("status") == "pending") & (F.col("next_retry_at").isNull() | (F.col("next_retry_at") <= now)) & (U.under_any(F.col("domain"), list(whitelist)) if whitelist else F.lit(True))


def claim(jobs: DataFrame, now: Column, n: int, whitelist: list[str] = ()) -> DataFrame:
    """The ``n`` jobs to do next: by priority, age and id."""
    return jobs.where(ready(now, whitelist)).orderBy("priority", "created_at", "id").limit(n)


def mark_processing(jobs: DataFrame, claimed: DataFrame, now: Column) -> DataFrame:
    return _set(jobs, claimed.select("id"), {"status": F.lit("processing"), "updated_at": now})


def recover(jobs: DataFrame) -> DataFrame:
    """After a crash: what was being processed is pending again."""
    return jobs.withColumn("status", F.when(F.col("status") == "processing", "pending").otherwise(F.col("status")))


def complete(jobs: DataFrame, done: DataFrame, now: Column) -> DataFrame:
    """``done``: id, title, content_markdown, metadata; its keys win over the job's."""
    extra = done.select("id", F.col("title").alias("__t"), F.col("content_markdown").alias("__c"), F.col("metadata").alias("__m"))
    empty = F.create_map().cast("map<string,string>")
    old = F.map_filter(F.coalesce("metadata", empty), lambda k, v: ~F.array_contains(F.map_keys(F.coalesce("__m", empty)), k))
    return _set(jobs, extra, {"status": F.lit("completed"), "title": F.col("__t"), "content_markdown": F.col("__c"), "metadata": F.map_concat(old, F.coalesce("__m", empty)), "last_error": F.lit(None).cast("string"), "updated_at": now})


def ignore(jobs: DataFrame, rejected: DataFrame, now: Column) -> DataFrame:
    """``rejected``: id, reason (500 characters are kept)."""
    return _set(jobs, rejected.select("id", F.col("reason").alias("__r")), {"status": F.lit("ignored"), "last_error": F.substring("__r", 1, 500), "updated_at": now})


def retry_delay(attempts: Column, unit: Column, s: Settings = Settings()) -> Column:
    """Seconds before attempt ``attempts`` + 1: doubled each time, and a share ``unit`` (0 to 1) of the jitter more."""
    delay = s.retry_seconds * F.pow(F.lit(2.0), F.greatest(attempts - 1, F.lit(0)))
    return delay + unit * F.least(F.lit(s.retry_jitter), delay * 0.25)


def fail(jobs: DataFrame, failed: DataFrame, now: Column, unit: Column | None = None, s: Settings = Settings()) -> DataFrame:
    """``failed``: id, error. Pending again after a delay, or failed for good after the last attempt."""
    n = F.coalesce("attempts", F.lit(0)) + 1
    last = n >= s.retry_attempts
    at = F.timestamp_micros((F.unix_micros(now) + (retry_delay(n, unit if unit is not None else F.lit(0.0), s) * 1e6).cast("long")).cast("long"))
    new = {"status": F.when(last, "failed").otherwise("pending"), "attempts": n, "last_error": F.substring("__e", 1, 500), "next_retry_at": F.when(~last, at), "updated_at": now}
    return _set(jobs, failed.select("id", F.col("error").alias("__e")), new)


def _set(jobs: DataFrame, keys: DataFrame, new: dict[str, Column]) -> DataFrame:
    both = jobs.join(keys.withColumn("__hit", F.lit(True)), "id", "left")
    return both.select(*[F.when(F.col("__hit"), new[c]).otherwise(F.col(c)).cast(jobs.schema[c].dataType).alias(c) if c in new else F.col(c) for c in jobs.columns])


def upsert_selectors(cache: DataFrame, seen: DataFrame) -> DataFrame:
    """(domain, selector, last_seen, quality): the latest of each domain."""
    last = F.max_by(F.struct("selector", "last_seen", "quality"), F.struct("last_seen", "selector")).alias("s")
    return cache.unionByName(seen).groupBy("domain").agg(last).select("domain", "s.*")


def counts(jobs: DataFrame, now: Column) -> DataFrame:
    """(status, n) with rows ``total`` and ``pending_ready``: one pass, then a few rows."""
    by = jobs.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.count_if(ready(now)).alias("r"))
    per = F.array(F.struct(F.col("status").alias("status"), F.col("n").alias("n")), F.struct(F.lit("total").alias("status"), F.col("n").alias("n")), F.struct(F.lit("pending_ready").alias("status"), F.col("r").alias("n")))
    return by.select(F.explode(per).alias("x")).groupBy("x.status").agg(F.sum("x.n").alias("n"))


def backfill_priority(jobs: DataFrame) -> DataFrame:
    """Old rows (priority null, 2 or 10) get their priority by the start of their URL, else by the end of their domain, in any case."""
    starts = lambda x: F.startswith(F.lower("url"), F.lit(x))
    new = F.when(starts("https://www.kompas.com/edu/") | starts("https://www.kompas.com/skola/"), 0).when(starts("https://edukasi.kompas.com/"), 1)
    new = new.when(F.endswith(F.lower("domain"), F.lit("kompas.com")), 2).otherwise(10)
    return jobs.withColumn("priority", F.when(F.col("priority").isNull() | F.col("priority").isin(2, 10), new).otherwise(F.col("priority")))


def spider_links(links: DataFrame, s: Settings = Settings(), allow: list[str] = (), focused: bool = False) -> DataFrame:
    """Links (page, pos, url) worth following, the first ``spider_links`` of a page."""
    edu = U.is_education_url(F.col("url"))
    article = F.contains(F.lower(U.path(F.col("url"))), F.lit("/read/"))
    worth = (U.contains_any(F.col("url"), list(allow)) if allow else F.lit(True)) & (article | edu) if focused else edu
    return cap_per_key(links.where(worth), ["page"], ["pos"], s.spider_links)
