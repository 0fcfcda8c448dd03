"""JSON-lines sinks."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from corpusloom.functions.text import token_count


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def overwrite_jsonl(df: DataFrame, path: str) -> None:
    """In as many files as ``df`` has partitions."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_tiers(raw: DataFrame, processed: DataFrame, folder: str, instance: str = "") -> None:
    """Raw and training records beside each other; an instance has its own files."""
    suffix = f"_{instance}" if instance else ""
    append_jsonl(raw, f"{folder}/dataset_raw{suffix}.jsonl")
    append_jsonl(processed, f"{folder}/dataset_raw_processed_1{suffix}.jsonl")


def outcomes() -> list[Column]:
    """Counts of rows (reject_reason): pages, accepted, failed, skipped."""
    ok = F.col("reject_reason").isNull()
    failed = F.coalesce(F.col("reject_reason").rlike("^(?:HTTP |fetch:)"), F.lit(False))
    return [F.count(F.lit(1)).alias("pages"), F.count_if(ok).alias("accepted"), F.count_if(failed).alias("failed"), F.count_if(~ok & ~failed).alias("skipped")]


def observed(df: DataFrame, name: str = "crawl") -> tuple[DataFrame, Observation]:
    """``df`` (reject_reason), which counts itself while an action writes it, and where the counts are found after."""
    seen = Observation(name)
    return df.observe(seen, *outcomes()), seen


def notify(seen: Observation, send: Callable[[str], None]) -> None:
    """Sends a line of counts; a callback that fails stops nothing, as a notice is no part of the run."""
    try:
        send(" | ".join(f"{k}={v}" for k, v in seen.get.items()))
    except Exception as error:  # noqa: BLE001
        logging.getLogger(__name__).warning("notice not sent: %s", error)


def run_counters(df: DataFrame, tokens: Callable[[Column], Column] = token_count) -> DataFrame:
    """One row: pages, accepted, rejected, tokens, of (reject_reason, main); ``tokens`` counts a text's."""
    ok = F.col("reject_reason").isNull()
    tokens = F.sum(tokens(F.when(ok, F.col("main")))).cast("long")
    return df.agg(F.count(F.lit(1)).alias("pages"), F.count_if(ok).alias("accepted"), F.count_if(~ok).alias("rejected"), F.coalesce(tokens, F.lit(0)).alias("tokens"))
