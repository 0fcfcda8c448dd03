"""Links of pages and search results, and pagination."""

from __future__ import annotations

from urllib.parse import urljoin

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import urls as U
from corpusloom.operators.dedupe import keep_first, ordered_distinct
from corpusloom.settings import Settings
from corpusloom.storage import stored


def hrefs(html: Column) -> Column:
    """The values of double-quoted href attributes, as they stand."""
    return F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit('(?i)href="([^"]*)"'), F.lit(1))


@F.udf(T.StringType(), useArrow=True)
def absolute(base, href):
    try:
        return urljoin(base or "", href or "")
    except ValueError:
        return None


def _each(pages: DataFrame, found: Column, page_col: str) -> DataFrame:
    return pages.select(F.col(page_col).alias("page"), F.posexplode(found).alias("pos", "url"))


def _valid(links: DataFrame) -> DataFrame:
    return ordered_distinct(links.where(F.col("url").isNotNull() & U.is_valid_crawl_url(F.col("url"))), ["page", "url"], "pos")


def page_links(pages: DataFrame, page_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page, pos, url): valid absolute links, once a page, at their first place.

    Only relative links pass the UDF that resolves them.
    """
    links = _each(pages, hrefs(F.col(html_col)), page_col)
    links = links.where(~F.col("url").rlike("^(?:#|javascript:|mailto:|tel:)"))
    whole = F.col("url").rlike(r"^(?i:https?)://[^/?#]+(?:/(?!\.)[^?#]*)?(?:[?#].*)?$") & ~F.contains("url", F.lit("/."))
    done = links.where(whole)
    rest = links.where(~whole).withColumn("url", absolute("page", "url"))
    return _valid(done.unionByName(rest)).select("page", "pos", "url")


def duckduckgo_links(results: DataFrame, page_col: str = "search_url", html_col: str = "html") -> DataFrame:
    links = _each(results, hrefs(F.col(html_col)), page_col)
    inner = F.regexp_extract("url", "(?i)uddg=([^&\"]+)", 1)
    own = F.when(F.startswith("url", F.lit("http")) & ~F.contains("url", F.lit("duckduckgo.com")), F.col("url"))
    return _valid(links.withColumn("url", F.when(inner != "", F.coalesce(F.try_url_decode(F.replace(inner, F.lit("+"), F.lit("%2B"))), inner)).otherwise(own))).select("page", "pos", "url")


def bing_links(results: DataFrame, page_col: str = "search_url", html_col: str = "html") -> DataFrame:
    found = F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit('(?i)<a\\s+href="(https?://[^"]+)"'), F.lit(1))
    links = _each(results, found, page_col)
    return _valid(links.withColumn("url", F.coalesce(U.bing_target(F.col("url")), F.col("url")))).select("page", "pos", "url")


def tag_page_links(pages: DataFrame, page_col: str = "search_url", html_col: str = "html") -> DataFrame:
    """Article links of tag pages, education sections first, else in their order."""
    links = page_links(pages, page_col, html_col).where(U.is_article_url(F.col("url"), "kompas"))
    section = F.when(F.contains("url", F.lit("/edu/")) | F.contains("url", F.lit("/skola/")), 0).otherwise(1)
    return links.select("page", F.struct(section.alias("section"), "pos").alias("pos"), "url")


def search_links(results: DataFrame) -> DataFrame:
    """(page, pos, url) of (engine, search_url, html); unknown engines give nothing."""
    flat = lambda df: df.select("page", F.col("pos").cast("struct<section:int,pos:int>") if dict(df.dtypes)["pos"].startswith("struct") else F.struct(F.lit(0).alias("section"), F.col("pos").alias("pos")).alias("pos"), "url")
    of = lambda e: results.where(F.col("engine") == e)
    return flat(duckduckgo_links(of("duckduckgo"))).union(flat(bing_links(of("bing")))).union(flat(tag_page_links(of("kompas_tag"))))


def paginated(first: DataFrame, pages: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(url, content, n_pages): contents of a page and those it leads to, joined by blank lines.

    ``first`` and ``pages``: url, content, next_url. One join a hop,
    ``max_pagination`` pages at most; a page that came before, is missing or
    has no content ends its chain.
    """
    chain = first.select("url", F.array("content").alias("parts"), F.array("url").alias("seen"), F.col("next_url").alias("at"))
    table = pages.select(F.col("url").alias("__u"), F.col("content").alias("__c"), F.col("next_url").alias("__to"))
    table = keep_first(table, ["__u"], [F.col("__c").isNull(), "__c", "__to"])
    for _ in range(max(0, s.max_pagination - 1)):
        go = F.col("at").isNotNull() & ~F.array_contains("seen", F.coalesce("at", F.lit(""))) & (F.coalesce("__c", F.lit("")) != "")
        both = chain.join(table, chain["at"] == table["__u"], "left").withColumn("go", F.coalesce(go, F.lit(False)))
        chain = stored(both.select("url", F.when(F.col("go"), F.concat("parts", F.array("__c"))).otherwise(F.col("parts")).alias("parts"), F.when(F.col("go"), F.concat("seen", F.array("at"))).otherwise(F.col("seen")).alias("seen"), F.when(F.col("go"), F.col("__to")).alias("at")))
    return chain.select("url", F.array_join("parts", "\n\n").alias("content"), F.size("parts").alias("n_pages"))
