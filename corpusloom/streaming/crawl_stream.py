"""The crawl's stateful behaviour as Structured Streaming.

Claim order inside a micro-batch, exactly-once effects and recovery come from
the checkpoint; everything that a loop kept in memory is keyed state.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from corpusloom.functions import text as X
from corpusloom.operators import frontier
from corpusloom.operators.changelog import ChangeLog
from corpusloom.operators.dedupe import keep_first
from corpusloom.plans import crawl
from corpusloom.settings import Settings
from corpusloom.storage import stored

#: Reasons that come before a page's fingerprint counts as seen.
EARLY = "^(?:no_content|too_short_raw|too_short_clean|too_short_main|low_extraction_quality|HTTP |fetch:)"


def first_contents(pages: DataFrame, content: str = "content") -> DataFrame:
    """A stream of pages without contents that came before; state holds one fingerprint each."""
    return pages.withColumn("fingerprint", X.fingerprint(F.col(content))).dropDuplicates(["fingerprint"])


def first_contents_within(pages: DataFrame, time: str, delay: str, content: str = "content") -> DataFrame:
    """The same with state bounded by a watermark."""
    rows = pages.withColumn("fingerprint", X.fingerprint(F.col(content))).withWatermark(time, delay)
    return rows.dropDuplicatesWithinWatermark(["fingerprint"])


def capped(pages: DataFrame, cap: int, key: str = "host", order: str = "id") -> DataFrame:
    """The first ``cap`` rows of each key over the stream's life, by ``order`` inside a micro-batch."""
    schema = pages.schema

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n = state.get[0] if state.exists else 0
        best: pd.DataFrame | None = None
        for b in batches:  # never more than cap rows are kept
            best = (b if best is None else pd.concat([best, b])).sort_values(order).head(max(0, cap - n))
        if best is not None:
            state.update((n + len(best),))
            yield best

    return pages.groupBy(key).applyInPandasWithState(run, schema, "n long", "append", GroupStateTimeout.NoTimeout)


def retries(failures: DataFrame, s: Settings = Settings()) -> DataFrame:
    """A stream of failures (url_hash, at timestamp, unit double) as (url_hash, attempts, status, retry_at).

    ``unit`` (0 to 1) is the share of the jitter, so that replays agree.
    """

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n = state.get[0] if state.exists else 0
        for b in batches:
            rows = []
            for at, unit in zip(*(b.sort_values("at")[c] for c in ("at", "unit")), strict=True):
                n += 1
                delay = s.retry_seconds * 2 ** max(0, n - 1)
                delay += unit * min(s.retry_jitter, delay * 0.25)
                last = n >= s.retry_attempts
                rows.append((key[0], n, "failed" if last else "pending", pd.NaT if last else at + pd.Timedelta(seconds=delay)))
            state.update((n,))
            yield pd.DataFrame(rows, columns=["url_hash", "attempts", "status", "retry_at"])

    return failures.groupBy("url_hash").applyInPandasWithState(run, "url_hash string, attempts int, status string, retry_at timestamp", "attempts int", "append", GroupStateTimeout.NoTimeout)


def outcome_counts(pages: DataFrame) -> DataFrame:
    """Running counts by reject reason; an update or complete sink shows them."""
    return pages.groupBy(F.coalesce("reject_reason", F.lit("accepted")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def each_batch(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, seconds: float | None = None):
    """Runs ``step`` on micro-batches: once over what is there, or every ``seconds``."""
    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if seconds is None else writer.trigger(processingTime=f"{max(1.0, seconds)} seconds")
    return writer.start()


SELECTORS = "domain string, selector string, last_seen long, quality double"


def selector_cache_step(path: str, buckets: int = 16, keep: int = 50) -> Callable[[DataFrame, int], None]:
    """Upserts (domain, selector, last_seen, quality) into a change log, of which ``keep`` batches are read before it is compacted."""

    def step(batch: DataFrame, n: int) -> None:
        cache = _log(batch.sparkSession, path, "domain", SELECTORS, buckets, keep, n)
        cache.append(frontier.upsert_selectors(cache.rows(batch, n), batch), n)

    return step


def _log(spark: SparkSession, path: str, key: str, schema: str, buckets: int, keep: int, n: int) -> ChangeLog:
    """The log as batch ``n`` finds it: what comes before it is compacted if it is long."""
    log = ChangeLog(spark, path, key, schema, buckets)
    if log.batches() > keep:
        log.compact(n)
        log.vacuum()
    return log


def jobs_log(spark: SparkSession, path: str, buckets: int = 64) -> ChangeLog:
    """The frontier of a worker under ``path``; what it begins with is appended as batch -1."""
    return ChangeLog(spark, f"{path}/jobs", "id", frontier.SCHEMA, buckets)


def worker_step(path: str, sites: DataFrame | None = None, s: Settings = Settings(), now: Column | None = None, buckets: int = 64, keep: int = 50, **lists) -> Callable[[DataFrame, int], None]:
    """A crawl worker's step for :func:`each_batch`: fetched pages (id, url, html, ...) in, changes of the crawl's tables out.

    Under ``path`` lie :func:`jobs_log`, the change logs ``seen`` (fingerprint)
    and ``selectors`` (domain), and ``records`` with each batch's accepted
    pages. A batch looks up its own jobs, and writes what it changes; neither
    grows with the frontier, which is not shuffled. It takes only pages whose
    job is pending or being worked on, so a page that comes again does nothing;
    of several pages of one job the first by its columns counts. A batch that
    is run again reads what was there before it, and writes its part again.
    """
    now = F.current_timestamp() if now is None else now

    def step(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        jobs = _log(spark, f"{path}/jobs", "id", frontier.SCHEMA, buckets, keep, n)
        seen = _log(spark, f"{path}/seen", "fingerprint", "fingerprint string", buckets, keep, n)
        cache = _log(spark, f"{path}/selectors", "domain", SELECTORS, buckets, keep, n)
        open_ = jobs.rows(batch, n).where(F.col("status").isin("pending", "processing")).select("id")
        pages = keep_first(batch.join(open_, "id", "left_semi"), ["id"], [c for c in batch.columns if c != "id"])
        rows = stored(crawl.curated(pages, sites, s, selectors=cache.rows(before=n), seen=seen.rows(before=n), **lists))
        reached = rows.where(F.col("fingerprint").isNotNull() & ~F.coalesce(F.col("reject_reason").rlike(EARLY), F.lit(False)))
        found = stored(crawl.selectors_seen(rows, F.unix_timestamp(now), s))
        jobs.append(crawl.settled(jobs.rows(rows, n), rows, now, s=s), n)
        seen.append(reached.select("fingerprint").distinct(), n)
        cache.append(frontier.upsert_selectors(cache.rows(found, n), found), n)
        rows.where(F.col("reject_reason").isNull()).write.mode("overwrite").parquet(f"{path}/records/{n}")

    return step


def stop_after(query, successes: Callable[[], int], most: int) -> bool:
    """Stops a query whose count of successes has reached ``most``; says whether it did."""
    if successes() < most:
        return False
    query.stop()
    return True


def rescan_seconds(hours: float) -> float:
    """The pause between two scans of the sitemaps: a minute at least."""
    return max(60.0, hours * 3600)
