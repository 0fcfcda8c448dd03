"""What happens to pages that are worked off one after another, as joins in rounds.

A page whose host has its cap of accepted pages by then is not looked at. Any
other page that passes the early gates leaves its fingerprint, and is a
duplicate if one before it did; then come the late gates. So whether a page is
accepted depends on pages of its host before it, and these on pages of other
hosts with their contents.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.storage import stored


class Settled(NamedTuple):
    """Pages with ``reject_reason``, and the rounds that it took."""

    rows: DataFrame
    rounds: int


def _nth(rows: DataFrame, order: Sequence[str], cap: int, name: str) -> DataFrame:
    """(__host, name): the place of the row that fills each host's cap; what is beyond the cap is dropped before the shuffle."""
    nth = F.row_number().over(W.partitionBy("__host").orderBy(*order))
    first = rows.withColumn("__n", nth).where(F.col("__n") <= cap)
    return first.where(F.col("__n") == cap - F.col("__used")).select("__host", F.struct(*order).alias(name))


def _used(accepted: DataFrame) -> DataFrame:
    return accepted.groupBy(F.coalesce("host", F.lit("")).alias("__host")).agg(F.sum("n").alias("__used"))


def _before(live: DataFrame, seen: DataFrame | None, accepted: DataFrame | None) -> DataFrame:
    """``live`` with __used, pages that its host has accepted before, and __known, whether its fingerprint was seen."""
    none = F.lit(0).cast("long")
    live = live.withColumn("__used", none) if accepted is None else live.join(_used(accepted), "__host", "left").withColumn("__used", F.coalesce("__used", none))
    if seen is None:
        return live.withColumn("__known", F.lit(False))
    known = seen.select(F.col("fingerprint").alias("__fp"), F.lit(True).alias("__known")).distinct()
    return live.join(known, "__fp", "left").withColumn("__known", F.coalesce("__known", F.lit(False)))


def in_claim_order(rows: DataFrame, order: Sequence[str], cap: int, host: str = "host", fingerprint: str = "fingerprint", seen: DataFrame | None = None, accepted: DataFrame | None = None) -> Settled:
    """``rows`` (early, late, a host, a fingerprint) with the reason that each meets if they are taken by ``order``, which must tell them apart.

    ``domain_cap:`` and the host goes before ``early``, then come
    ``duplicate_content`` and ``late``; null is acceptance. ``seen``
    (fingerprint) and ``accepted`` (host, n) are what was there before. A null
    host is the host ''.

    Every round knows, for each page, whether it is beyond the cap, a duplicate
    or accepted, or that this is open. If even the pages that are surely
    accepted fill the cap before a page, it is beyond; if not even those that
    may be do, it is not. If a page before it surely left the fingerprint, it
    is a duplicate; if none may have, it is not. The first open page is always
    settled, so the rounds end; there are as many as the longest chain of pages
    that wait for one another. A round shuffles places, hosts and fingerprints;
    a host sends ``cap`` rows a task at most, a fingerprint one.
    """
    me, key = F.struct(*order), F.coalesce(F.col(host), F.lit(""))
    live = rows.where(F.col("early").isNull()).select(*order, key.alias("__host"), F.col(fingerprint).alias("__fp"), F.col("late").isNull().alias("__ok"))
    live = _before(live, seen, accepted)
    start = {"__capped": F.when(F.col("__used") >= cap, True), "__dup": F.when(F.col("__known"), True)}
    live = stored(live.withColumns(start).drop("__known"))
    reached, may_reach = ~F.coalesce("__capped", F.lit(True)), ~F.coalesce("__capped", F.lit(False))
    sure = reached & ~F.coalesce("__dup", F.lit(True)) & F.col("__ok")
    may = may_reach & ~F.coalesce("__dup", F.lit(False)) & F.col("__ok")
    still_open = F.col("__capped").isNull() | (~F.col("__capped") & F.col("__dup").isNull())
    rounds = 0
    while not live.where(still_open).isEmpty():
        rounds += 1
        full = _nth(live.where(sure), order, cap, "__sure").join(_nth(live.where(may), order, cap, "__may"), "__host", "full")
        first = live.groupBy("__fp").agg(F.min(F.when(reached, me)).alias("__left"), F.min(F.when(may_reach, me)).alias("__maybe"))
        both = live.join(first, "__fp").join(full, "__host", "left")
        beyond = F.when(me > F.col("__sure"), True).when(F.col("__may").isNull() | (me <= F.col("__may")), False)
        again = F.when(F.col("__left") < me, True).when(F.col("__maybe").isNull() | (F.col("__maybe") >= me), False)
        live = stored(both.withColumns({"__capped": F.coalesce("__capped", beyond), "__dup": F.coalesce("__dup", again)}).select(*live.columns))
    dups = live.where("NOT __capped AND __dup").select(*[F.col(c).alias(f"__{c}") for c in order], F.lit(True).alias("__again"))
    out = rows.withColumn("__host", key).join(_nth(live.where(sure), order, cap, "__sure"), "__host", "left")
    out = out.withColumn("__used", F.lit(0)) if accepted is None else out.join(_used(accepted), "__host", "left")
    gone = F.coalesce(me > F.col("__sure"), F.lit(False)) | (F.coalesce("__used", F.lit(0)) >= cap)
    out = out.join(dups, reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in order]), "left")
    reason = F.when(gone, F.concat(F.lit("domain_cap:"), "__host")).otherwise(F.coalesce("early", F.when(F.col("__again"), "duplicate_content"), "late"))
    return Settled(out.select(*[c for c in rows.columns if c not in ("early", "late")], reason.alias("reject_reason")), rounds)


def accepted_per_host(rows: DataFrame, host: str = "host") -> DataFrame:
    """(host, n): how many pages of each host were accepted; hosts without any are left out."""
    return rows.where(F.col("reject_reason").isNull()).groupBy(F.col(host).alias("host")).agg(F.count(F.lit(1)).alias("n"))
