"""Sitemaps as a table of (sitemap_url, body): parsed in Arrow batches, walked breadth first."""

from __future__ import annotations

import gzip
import xml.etree.ElementTree as ET
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import urls as U
from corpusloom.operators.dedupe import ordered_distinct
from corpusloom.settings import Settings
from corpusloom.storage import stored

PARSED = "children array<string>, pages array<string>"


def gunzip(data: bytes | None) -> bytes:
    """Decompressed if it has gzip's first bytes and is whole, else as it is."""
    data = bytes(data or b"")
    if data[:2] != b"\x1f\x8b":
        return data
    try:
        return gzip.decompress(data)
    except (OSError, EOFError, zlib.error):
        return data


def parse_sitemap(data: bytes | None) -> tuple[list[str], list[str]]:
    """(child sitemaps, pages) in order, once each; both empty if the XML is malformed."""
    try:
        root = ET.fromstring(gunzip(data))
    except (ET.ParseError, ValueError):
        return [], []
    found = [(e.text or "").strip() for e in root.iter() if isinstance(e.tag, str) and e.tag.rpartition("}")[2] == "loc" and e is not root]
    locs = list(dict.fromkeys(x for x in found if x))
    return (locs, []) if root.tag.lower().endswith("sitemapindex") else ([], locs)


def parsed(sitemaps: DataFrame) -> DataFrame:
    """(sitemap_url, children, pages)."""

    @F.udf(PARSED, useArrow=True)
    def run(body):
        return dict(zip(("children", "pages"), parse_sitemap(body), strict=True))

    return sitemaps.select("sitemap_url", run("body").alias("p")).select("sitemap_url", "p.children", "p.pages")


def walk(sitemaps: DataFrame, roots: DataFrame, allow: list[str] = (), s: Settings = Settings()) -> tuple[DataFrame, int]:
    """(pages (pos, url), sitemaps seen): breadth first from ``roots`` (pos, url).

    One join a level; a sitemap is read once, ``max_sitemaps`` at most in
    order of discovery (those that are missing count too), and pages end at
    ``max_pages`` before they are made distinct.
    """
    spark = sitemaps.sparkSession
    table = stored(parsed(sitemaps).dropDuplicates(["sitemap_url"]))
    level = ordered_distinct(roots.select(F.trim("url").alias("url"), F.array(F.col("pos").cast("long")).alias("at")).where("url <> ''"), ["url"], "at")
    seen, found = spark.createDataFrame([], "url string"), None
    n_seen, n_pages, depth = 0, 0, 0
    while n_seen < s.max_sitemaps and n_pages < s.max_pages:
        level = stored(level.join(seen, "url", "left_anti").orderBy("at").limit(s.max_sitemaps - n_seen))
        n = level.count()
        if not n:
            break
        n_seen += n
        seen = stored(seen.union(level.select("url")))
        read = level.join(table, level["url"] == table["sitemap_url"])
        pages = read.select("at", F.posexplode("pages").alias("i", "url")).select("url", F.struct(F.lit(depth).alias("d"), F.col("at").alias("a"), F.col("i").alias("i")).alias("pos"))
        pages = pages.where(U.contains_any(F.col("url"), list(allow)) if allow else F.lit(True))
        pages = stored(pages.orderBy("pos").limit(s.max_pages - n_pages))
        n_pages += pages.count()
        found = pages if found is None else found.unionByName(pages)
        level = read.select("at", F.posexplode("children").alias("i", "url")).select("url", F.concat("at", F.array(F.col("i").cast("long"))).alias("at"))
        level = ordered_distinct(level, ["url"], "at")
        depth += 1
    if found is None:
        found = spark.createDataFrame([], "url string, pos struct<d:int,a:array<bigint>,i:int>")
    return ordered_distinct(found, ["url"], "pos").select("pos", "url"), n_seen
