"""Fetched pages from archive files: records of a header, the response's own header, and its body.

Files are read by Spark's text reader with the records' border as its line
separator: it divides files by bytes, finds the next border after a division by
itself, and opens every store that Spark does. What is made of a record is
expressions, so columns that nobody asks for are not made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What opens a record, and the border that ends one.
VERSION, BORDER, GAP = "WARC/1.0", "\r\n\r\nWARC/1.0\r\n", "\r\n\r\n"
#: Charsets by other names; all but these are read as UTF-8.
LATIN = ["iso-8859-1", "latin1", "latin-1", "windows-1252", "us-ascii", "ascii"]


def _before(c: Column) -> Column:
    """Up to the first gap, all without one."""
    at = F.locate(GAP, c)
    return F.when(at > 0, F.substring(c, F.lit(1), at - 1)).otherwise(c)


def _after(c: Column) -> Column:
    """From the first gap on, null without one."""
    at = F.locate(GAP, c)
    return F.when(at > 0, F.substring(c, at + len(GAP), F.length(c)))


def _header(block: Column, name: str) -> Column:
    """A header's value, null if it is not there; names are of any case."""
    found = F.regexp_extract(block, rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1)
    return F.when(found != "", F.trim(found))


def records(spark: SparkSession, path: str) -> DataFrame:
    """(kind, url, date, length, block) of every record; block holds the bytes after its header, up to the border."""
    rows = spark.read.option("lineSep", BORDER).text(path).withColumnRenamed("value", "v")
    opens = F.startswith("v", F.lit(VERSION + "\r\n"))  # only the first of a file still has it
    # a character of Latin-1 a byte, so that positions are those of bytes
    rows = rows.select(F.decode(F.when(opens, F.substring(F.col("v").cast("binary"), len(VERSION) + 3, 1 << 30)).otherwise(F.col("v").cast("binary")), "ISO-8859-1").alias("v"))
    rows = rows.where(F.trim(F.translate("v", "\r\n", "")) != "")
    head = _before(F.col("v"))
    block = F.encode(F.coalesce(_after(F.col("v")), F.lit("")), "ISO-8859-1")
    return rows.select(_header(head, "WARC-Type").alias("kind"), _header(head, "WARC-Target-URI").alias("url"), _header(head, "WARC-Date").alias("date"), _header(head, "Content-Length").cast("string").alias("length"), block.alias("block"))


def archived_pages(spark: SparkSession, path: str) -> DataFrame:
    """(url, status, html, fetched_at, error) of the responses under ``path``, ready for :func:`corpusloom.plans.crawl.curated` once they have ids.

    Records of other kinds are passed over. One without a URL, of another
    length than it says, or whose response has no status line comes back with
    ``error`` and no body; the others keep their status, 400 and more too. The
    body is read by the charset that the response names, UTF-8 if it is not
    known; bytes that are none become replacement characters.
    """
    rows = records(spark, path).where(F.coalesce(F.lower("kind"), F.lit("response")) == "response")
    length = F.expr("try_cast(length AS bigint)")
    # the last record of a file ends with a gap of its own
    size = F.octet_length("block")
    whole = (size == length) | ((size == length + len(GAP)) & F.endswith("block", F.lit(GAP).cast("binary")))
    rows = rows.withColumn("text", F.decode(F.substring(F.col("block"), F.lit(1), length.cast("int")), "ISO-8859-1"))
    head = _before(F.col("text"))
    status = F.expr("try_cast(regexp_extract(text, '^HTTP/[0-9.]+ ([0-9]{3})', 1) AS int)")
    charset = F.lower(F.regexp_extract(F.coalesce(_header(head, "Content-Type"), F.lit("")), r"(?i)charset=[\"']?([\w-]+)", 1))
    body = F.encode(F.coalesce(_after(F.col("text")), F.lit("")), "ISO-8859-1")
    html = F.when(charset.isin(*LATIN), F.decode(body, "ISO-8859-1")).otherwise(F.make_valid_utf8(body.cast("string")))
    error = F.when(F.col("url").isNull(), "record without URL").when(~F.coalesce(whole, F.lit(False)), "record of another length").when(status.isNull(), "no status line")
    return rows.select("url", F.when(error.isNull(), status).alias("status"), F.when(error.isNull(), html).alias("html"), F.expr("try_to_timestamp(date)").alias("fetched_at"), error.alias("error"))


def record(url: Column, status: Column, html: Column, date: str = "2024-01-15T00:00:00Z", lost: Column | None = None) -> Column:
    """A response as a record's text, without the border after it; ``lost``: bytes that it says to have and has not."""
    response = F.concat(F.lit("HTTP/1.1 "), status.cast("string"), F.lit(" X\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"), html)
    size = F.octet_length(response) + (F.lit(0) if lost is None else lost)
    head = F.concat(F.lit(f"{VERSION}\r\nWARC-Type: response\r\nWARC-Target-URI: "), url, F.lit(f"\r\nWARC-Date: {date}\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), size.cast("string"))
    return F.concat(head, F.lit(GAP), response)


def write_archive(records: DataFrame, path: str) -> None:
    """``records``, one column of :func:`record` texts, as files of a task each."""
    records.write.option("lineSep", GAP).text(path)
