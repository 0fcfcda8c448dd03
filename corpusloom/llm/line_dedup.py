"""Line dedup with per-document keep bitmaps (DataFrame functions only).

Occurrences (key hash, document, position) are range-partitioned by hash and
sorted by document and position inside each partition; a window streams each
hash's run and marks what follows its first document. Hashes of very many
occurrences are found in a sample of them and settled by a partial minimum
instead, so that no run grows into one huge task; which way a hash takes
changes no result. Text never takes part in that shuffle: what comes back per
document is a run-length coded bitmap of the lines it loses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.llm.common import SPACES, ascii_lower, boxed, field, unboxed
from corpusloom.storage import stored

#: One occurrence of so many is looked at for hot hashes. A hash is hot beyond a share of all occurrences, but at
#: HOT of them at the latest; that many hashes, or MOST, can be hot at once, about.
LOOK, SHARE, HOT, MOST = 64, 1_024, 100_000, 50_000


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _row_key(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(__id, __text, __th): rows with one id and one text are one document."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("__id"), text.alias("__text"), F.xxhash64(text).alias("__th"))


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, hot: int = HOT) -> DataFrame:
    """(__id, __th, __gone): the runs of positions that each document loses, as sorted (s, e), both included.

    A line's key is the line stripped of ASCII white space, with A-Z in lower
    case. Keys of ``min_chars`` code points or more stay only in the smallest
    id that holds them, and there with all their lines. Null text counts as
    one empty line. Rows with a null id count as one document, the largest;
    rows with one id as one document. Documents that lose nothing are absent;
    an empty table gives no rows. Texts are read whole at any length.
    """
    rows = _row_key(docs, id_col, text_col)
    line = rows.select("__id", "__th", F.posexplode(_lines(F.col("__text"))).alias("__pos", "__line"))
    key = F.btrim(F.col("__line"), F.lit(SPACES))
    occ = stored(
        line.select("__id", "__th", "__pos", key.alias("__key"))
        .where(F.char_length("__key") >= min_chars)
        .select("__id", "__th", "__pos", F.unhex(F.md5(ascii_lower(F.col("__key")).cast("binary"))).alias("__h"))
    )
    total = occ.count()
    least = max(64, min(hot, total // SHARE), total // MOST)
    looked = occ.where(F.pmod(F.xxhash64("__id", "__th", "__pos"), F.lit(LOOK)) == 0)
    many = stored(looked.groupBy("__h").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") * LOOK > least).select("__h"))
    many = F.broadcast(many)  # by its filter, about MOST rows at most
    first = stored(occ.join(many, "__h").groupBy("__h").agg(F.min("__id").alias("__first")))
    cold = occ.join(many, "__h", "left_anti").repartitionByRange("__h")
    run = W.partitionBy("__h").orderBy(F.asc_nulls_last("__id"), "__pos")
    cold = cold.withColumn("__first", F.first("__id").over(run))
    lost = cold.select("__id", "__th", "__pos", "__first").unionByName(occ.join(F.broadcast(first), "__h").select("__id", "__th", "__pos", "__first"))
    lost = lost.where(~F.col("__id").eqNullSafe(F.col("__first"))).groupBy("__id", "__th").agg(F.sort_array(F.collect_set("__pos")).alias("__drop"))
    return lost.select("__id", "__th", runs(F.col("__drop")).alias("__gone"))


def runs(drop: Column) -> Column:
    """Sorted positions as runs: array of (s, e), both included."""
    last = F.size(drop) - 1
    starts = F.filter(drop, lambda x, i: (i == 0) | (F.get(drop, i - 1) != x - 1))
    ends = F.filter(drop, lambda x, i: (i == last) | (F.get(drop, i + 1) != x + 1))
    return F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("s"), e.alias("e")))


def keep_runs(gone: Column, n_lines: Column) -> Column:
    """The lines between ``gone``'s runs, as runs."""
    opens = F.concat(F.array(F.lit(0)), F.transform(gone, lambda r: r["e"] + 1))
    closes = F.concat(F.transform(gone, lambda r: r["s"] - 1), F.array(n_lines - 1))
    between = F.zip_with(opens, closes, lambda s, e: F.struct(s.alias("s"), e.alias("e")))
    return F.filter(between, lambda r: r["s"] <= r["e"])


def _kept(lines: Column, keep: Column) -> Column:
    return F.array_join(F.flatten(F.transform(keep, lambda r: F.slice(lines, r["s"] + 1, r["e"] - r["s"] + 1))), "\n")


def _with_bitmaps(rows: DataFrame, lost: DataFrame) -> DataFrame:
    """``rows`` (__id, __th, ...) with ``__gone``, null for those that lose nothing."""
    lost = lost.withColumnsRenamed({"__id": "__i2", "__th": "__t2"})
    return rows.join(lost, rows["__id"].eqNullSafe(lost["__i2"]) & (rows["__th"] == lost["__t2"]), "left").drop("__i2", "__t2")


def line_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """(__id, __th, __text, __lines, __gone, __keep, __kept) for every row of ``docs``.

    ``__keep`` holds the runs of lines that stay, null where all do; ``__kept``
    is the text after it. Cases as in :func:`dropped_lines`; repeated rows come
    back repeated; columns beside the two don't matter.
    """
    both = _with_bitmaps(_row_key(docs, id_col, text_col), dropped_lines(docs, id_col, text_col, min_chars))
    both = both.withColumn("__lines", F.size(_lines(F.col("__text"))))
    both = both.withColumn("__keep", F.when(F.col("__gone").isNotNull(), keep_runs(F.col("__gone"), F.col("__lines"))))
    kept = _kept(_lines(F.col("__text")), F.col("__keep"))
    return both.withColumn("__kept", F.when(F.col("__keep").isNull(), F.col("__text")).otherwise(kept))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """``docs`` with the lines that the bitmaps drop gone from its text; same columns, same rows.

    ``n_chars``, where there is such a column, counts the new text's code
    points. Texts that lose nothing stay as they are (null stays null). Columns
    of any name pass unchanged. Other cases as in :func:`dropped_lines`.
    """
    rows = boxed(docs).select("__row", field(id_col).alias("__id"), F.xxhash64(F.coalesce(field(text_col), F.lit(""))).alias("__th"))
    both = _with_bitmaps(rows, dropped_lines(docs, id_col, text_col, min_chars))
    lines = _lines(field(text_col))
    kept = F.when(F.col("__gone").isNull(), field(text_col)).otherwise(_kept(lines, keep_runs(F.col("__gone"), F.size(lines))))
    both = both.withColumn("__kept", kept)
    out = {text_col: F.col("__kept")}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(F.col("__gone").isNull(), field("n_chars")).otherwise(F.char_length("__kept").cast(docs.schema["n_chars"].dataType))
    return unboxed(both, docs.columns, out)


def query(docs: DataFrame) -> DataFrame:
    return line_bitmaps(docs).select(
        F.col("__id").alias("doc_id"),
        F.col("__lines").cast("long").alias("n_lines"),
        F.coalesce(F.aggregate("__gone", F.lit(0), lambda n, r: n + r["e"] - r["s"] + 1), F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2(F.col("__kept").cast("binary"), 256).alias("kept_sha256"),
    )


SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
x AS (SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS pos FROM d),
k AS (SELECT doc_id, pos, line,
             translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM x),
f AS (SELECT key, min(doc_id) AS first_doc FROM k WHERE length(key) >= 10 GROUP BY key),
m AS (SELECT k.doc_id, k.pos, k.line, (f.first_doc IS NOT NULL AND f.first_doc <> k.doc_id) AS gone
      FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
