"""Mixing sources to target weights (DataFrame functions only).

Targets come from capped water-filling: every source gets the level times its
weight, held at ``max_epochs`` times its size, and the level is the one at
which the targets use up the total. Sorted by cap over weight, the level that
follows from capping the first k sources is largest at the right k, so one
pass over the sorted sources replaces the repeated clamping and resharing.

A target of r times its source takes floor(r) whole repetitions of every
document and, for the rest, whole documents in a seeded order until the words
are used up; of the document at the border some words are due. The border is
found by two rounds of 256 hash buckets, so no task ever sorts a whole source.
Rows share a place in that order if their ids are equal (null ids: their
texts); the words due to them are dealt out row by row, in tasks that count
shares of such a group, never all of it. What a row takes follows from the row
and its source's border alone, so texts are not shuffled but for those at it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.llm.common import WORD_PATTERN, boxed, field, unboxed
from corpusloom.storage import stored

MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)
SEED = "mix-1"
#: Shares into which rows of one place are dealt to be counted.
DEAL = 64


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) of (source, source_size), one row per source.

    Sources by code point, null last, take the weights in turn. There are as
    many rows as sources, so its windows without a key stay small.
    """
    order = W.orderBy(F.asc_nulls_last("source"))
    w = sizes.withColumn("__w", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")).cast("long"))
    w = w.withColumn("__cap", F.col("source_size") * max_epochs)
    by = W.orderBy(F.col("__cap") / F.col("__w"), F.asc_nulls_last("source"))
    upto, every = by.rowsBetween(W.unboundedPreceding, W.currentRow), W.partitionBy(F.lit(0))
    left = F.sum("source_size").over(every) - (F.sum("__cap").over(upto) - F.col("__cap"))
    weight = F.sum("__w").over(every) - (F.sum("__w").over(upto) - F.col("__w"))
    w = w.withColumn("__level", left / weight).withColumn("__level", F.max("__level").over(every))
    return w.select("source", "source_size", F.least(F.col("__cap").cast("double"), F.col("__level") * F.col("__w")).alias("target"))


def _border(rows: DataFrame, need: DataFrame, bucket: str, rest: str, out: str) -> DataFrame:
    """``need`` with the bucket in which a source's words run out, and what is left for that bucket."""
    sums = rows.groupBy("__s", bucket).agg(F.sum("__size").alias("__b"))
    cum = F.sum("__b").over(W.partitionBy("__s").orderBy(bucket).rowsBetween(W.unboundedPreceding, W.currentRow))
    sums = sums.withColumn("__cum", cum).withColumnRenamed("__s", "__s2")
    at = need.join(sums, (need["__s"] == sums["__s2"]) & (sums["__cum"] > need[rest]) & (sums["__cum"] - sums["__b"] <= need[rest]), "left")
    return at.select(*need.columns, F.col(bucket).alias(f"{out}_b"), (F.col(rest) - (F.col("__cum") - F.col("__b"))).alias(out))


def _keyed(text: Column, ident: Column, source: Column, seed: str) -> dict[str, Column]:
    """A row's source as a key safe of nulls, size, and place in the seeded order with its two buckets."""
    place = F.coalesce(ident.cast("string"), F.concat(F.lit("null:"), F.md5(F.coalesce(text, F.lit("")).cast("binary"))))
    order = F.md5(F.concat(F.lit(f"{seed}:"), place).cast("binary"))
    return {"__s": F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("-")), "__size": word_count(text), "__u": order, "__b1": F.substring(order, 1, 2), "__b2": F.substring(order, 3, 2)}


def _borders(rows: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """A row a source: its size, target, whole repetitions, and the buckets in which its words run out with what is left for them."""
    sizes = rows.groupBy("__s").agg(F.first("source").alias("source"), F.sum("__size").alias("source_size"))
    targets = source_targets(sizes.select("source", "source_size"), weights, max_epochs)
    targets = targets.withColumn("__s", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-"))).drop("source")
    ratio = F.when(F.col("source_size") > 0, F.floor(F.round("target").cast("long") / F.col("source_size"))).otherwise(0)
    need = targets.withColumn("__whole", ratio.cast("long"))
    need = stored(need.withColumn("__f", F.round("target").cast("long") - F.col("__whole") * F.col("source_size")))
    need = _border(rows, need, "__b1", "__f", "__f1")
    inside = rows.join(_small(need.select(F.col("__s").alias("__s2"), F.col("__f1_b"))), (F.col("__s") == F.col("__s2")) & (F.col("__b1") == F.col("__f1_b")))
    return stored(_border(inside.select(*rows.columns), need, "__b2", "__f1", "__f2"))


def _small(sources: DataFrame) -> DataFrame:
    """Rows by source, to be broadcast if there are few."""
    return F.broadcast(sources) if sources.count() <= 10_000 else sources


def _taken(rows: DataFrame, need: DataFrame) -> DataFrame:
    """``rows`` (see ``_keyed``) with ``__whole`` repetitions, ``__part`` words more, and ``__more``: whether they stand for the whole row."""
    all_rows = rows.join(_small(need.withColumnRenamed("__s", "__s2")), F.col("__s") == F.col("__s2")).drop("__s2")
    before = F.coalesce((F.col("__b1") < F.col("__f1_b")) | ((F.col("__b1") == F.col("__f1_b")) & (F.col("__b2") < F.col("__f2_b"))), F.lit(False))
    at = F.coalesce((F.col("__b1") == F.col("__f1_b")) & (F.col("__b2") == F.col("__f2_b")), F.lit(False))
    plain = all_rows.where(~at).withColumns({"__part": F.when(before, F.col("__size")).otherwise(F.lit(0).cast("long")), "__more": before})
    edge = stored(all_rows.where(at).withColumn("__deal", F.pmod(F.monotonically_increasing_id(), F.lit(DEAL))))
    place = ["__s", "__u", "__size"]
    held = edge.groupBy(*place, "__deal").agg(F.count(F.lit(1)).alias("__k"), F.first("__f2").alias("__f2"))
    kinds = held.groupBy(*place).agg((F.sum("__k") * F.col("__size")).alias("__w"), F.first("__f2").alias("__f2"))
    order = W.partitionBy("__s").orderBy("__u", "__size").rowsBetween(W.unboundedPreceding, -1)
    kinds = kinds.withColumn("__due", F.col("__f2") - F.coalesce(F.sum("__w").over(order), F.lit(0))).drop("__f2", "__w")
    ahead = W.partitionBy(*place).orderBy("__deal").rowsBetween(W.unboundedPreceding, -1)
    held = held.withColumn("__ahead", F.coalesce(F.sum("__k").over(ahead), F.lit(0))).drop("__k", "__f2")
    info = kinds.join(held, place).withColumnsRenamed({c: f"{c}2" for c in [*place, "__deal"]})
    edge = edge.withColumn("__n", F.row_number().over(W.partitionBy(*place, "__deal").orderBy(F.lit(0))))
    edge = edge.join(info, [F.col(c) == F.col(f"{c}2") for c in [*place, "__deal"]])
    due = F.col("__due") - (F.col("__ahead") + F.col("__n") - 1) * F.col("__size")
    edge = edge.withColumn("__part", F.greatest(F.lit(0).cast("long"), F.least(F.col("__size"), due)))
    # with no words to count, a row goes along if anything is due at its place
    edge = edge.withColumn("__more", (due > 0) & (F.col("__part") * 2 >= F.col("__size")))
    return plain.unionByName(edge.select(*plain.columns))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, whole, part) for every row.

    ``whole`` repetitions of the row and ``part`` of its words more. Null text
    has size 0 and takes nothing; null sources form one source, the last; rows
    with one id share a place in the seeded order (null ids go by their text).
    Equal rows are interchangeable there. Texts count whole at any length;
    other columns don't matter. An empty table gives no rows.
    """
    text, ident, source = F.col(text_col), F.col(id_col), F.col(source_col)
    rows = stored(docs.select(ident.alias("doc_id"), source.alias("source"), *[c.alias(n) for n, c in _keyed(text, ident, source, seed).items()]))
    out = _taken(rows, _borders(rows, weights, max_epochs))
    return out.select("doc_id", "source", F.col("__size").alias("size"), "source_size", "target", F.col("__whole").alias("whole"), F.col("__part").alias("part"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The mix itself: a row of ``docs`` for each repetition, the same columns of any name.

    Texts stay whole: the document at a source's border comes once more if at
    least half of its words are due, so a source's words are off its target by
    half of one document at most. Texts without words are sampled by their
    place like any other. Other cases as in :func:`mix`.
    """
    keys = {n: c for n, c in _keyed(field(text_col), field(id_col), field(source_col), seed).items()}
    rows = boxed(docs).select("__row", *[c.alias(n) for n, c in keys.items()])
    small = stored(rows.select(field(source_col).alias("source"), *keys))
    out = _taken(rows, _borders(small, weights, max_epochs))
    times = F.col("__whole") + F.col("__more").cast("long")
    return unboxed(out.withColumn("__again", F.explode(F.array_repeat(F.lit(True), times.cast("int")))), docs.columns)


def query(docs: DataFrame) -> DataFrame:
    taken = F.col("whole") * F.col("size") + F.col("part")
    return mix(docs).select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"))


SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null:' || md5(coalesce(text, '')))) AS u
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS w, source_size * 3 AS cap FROM s),
l AS (SELECT *, ((sum(source_size) OVER ())::BIGINT - ((sum(cap) OVER o)::BIGINT - cap))::DOUBLE
             / ((sum(w) OVER ())::BIGINT - ((sum(w) OVER o)::BIGINT - w))::DOUBLE AS lvl
      FROM w WINDOW o AS (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
t AS (SELECT source, source_size, least(cap::DOUBLE, (max(lvl) OVER ()) * w) AS target FROM l),
n AS (SELECT *, CASE WHEN source_size > 0 THEN floor(round(target)::BIGINT / source_size::DOUBLE)::BIGINT ELSE 0 END AS whole FROM t),
r AS (SELECT d.doc_id, d.size, n.source_size, n.target, n.whole, round(n.target)::BIGINT - n.whole * n.source_size AS f,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.u ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS b
      FROM d JOIN n ON d.source IS NOT DISTINCT FROM n.source)
SELECT doc_id, size, source_size, target, (whole * size + greatest(0, least(size, f - b)))::BIGINT AS taken FROM r
"""
