"""First-wins and cap operators over keys that one value may dominate."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_of_key(df: DataFrame, key: Sequence[str], order: Sequence[str], name: str = "first") -> DataFrame:
    """``df`` with ``name``: whether a row is the first of its key, by ``order`` (which must tell rows apart).

    The minimum of each key is aggregated before the shuffle, and the join
    that marks it may be split where a key is hot: no task gathers a key.
    """
    least = df.groupBy(*[F.col(k).alias(f"__{k}") for k in key]).agg(F.min(F.struct(*order)).alias("__least"))
    same = reduce(Column.__and__, [df[k].eqNullSafe(F.col(f"__{k}")) for k in key])
    both = df.join(least, same)
    return both.select(*[df[c] for c in df.columns], (F.struct(*[df[o] for o in order]) == F.col("__least")).alias(name))


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key: a bounded window that is limited before the shuffle."""
    by = W.partitionBy(*key).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(by)).where(F.col("__n") == 1).drop("__n")


def cap_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str], cap: int | Column) -> DataFrame:
    """The first ``cap`` rows of each key; a constant cap is applied before the shuffle too."""
    by = W.partitionBy(*key).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(by)).where(F.col("__n") <= cap).drop("__n")


def ordered_distinct(df: DataFrame, key: Sequence[str], position: str) -> DataFrame:
    """Each key once, at its first position."""
    return df.groupBy(*key).agg(F.min(position).alias(position))


def not_seen(df: DataFrame, seen: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.join(seen.select(*key).distinct(), list(key), "left_anti")
