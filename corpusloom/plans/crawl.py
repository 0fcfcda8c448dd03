"""The crawl as one plan: fetched pages to extracted, gated, capped and labelled records, and what they do to the frontier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import urls as U
from corpusloom.operators import frontier
from corpusloom.operators.claims import Settled, in_claim_order
from corpusloom.operators.dedupe import cap_per_key, keep_first
from corpusloom.operators.extract import extract
from corpusloom.operators.gates import gated, judged
from corpusloom.operators.links import absolute, paginated
from corpusloom.operators.sites import match_sites, with_selector
from corpusloom.settings import Settings
from corpusloom.storage import stored


def fetch_error(pages: DataFrame) -> Column:
    """Why a page has no body: its ``error``, or a ``status`` of 400 or more; null for what was fetched, or without such columns."""
    out = F.lit(None).cast("string")
    if "status" in pages.columns:
        out = F.when(F.col("status") >= 400, F.concat(F.lit("HTTP "), F.col("status").cast("string")))
    if "error" in pages.columns:
        out = F.coalesce(F.concat(F.lit("fetch:"), F.substring("error", 1, 200)), out)
    return out


def extracted_pages(pages: DataFrame, sites: DataFrame | None = None, selectors: DataFrame | None = None, s: Settings = Settings()) -> DataFrame:
    """(id, url, title, content, extraction_source, selector_used, fetch_error, rendered_html) of pages (id, url, html).

    Further columns of ``pages`` count if they are there: ``status`` and
    ``error`` (such pages are not read), ``rendered_html``. ``sites`` is the
    manifest, ``selectors`` the cache (domain, selector) of what worked on a
    host before. Where the manifest names a link to the next page, an article
    goes on with the pages it leads to, as far as ``pages`` holds them.
    """
    rows = pages.withColumn("fetch_error", fetch_error(pages))
    rows = rows.withColumn("html", F.when(F.col("fetch_error").isNull(), F.col("html")))
    if "rendered_html" not in rows.columns:
        rows = rows.withColumn("rendered_html", F.lit(None).cast("string"))
    if sites is not None:
        rows = match_sites(rows, sites)
    if selectors is not None:
        rows = with_selector(rows, selectors).withColumnRenamed("selector", "cached")
    rows = extract(rows, persisted_col="cached" if selectors is not None else None)
    out = rows.select("id", "url", "extracted.title", "extracted.content", F.col("extracted.source").alias("extraction_source"), F.col("extracted.selector").alias("selector_used"), "fetch_error", "rendered_html", "extracted.next_page")
    if sites is None or "selectors" not in sites.columns or sites.where(F.coalesce(F.col("selectors")["next_page"], F.lit("")) != "").isEmpty():
        return out.drop("next_page")
    out = stored(out.withColumn("next_url", F.when(F.col("next_page").isNotNull(), absolute("url", "next_page"))).drop("next_page"))
    begin = out.where(F.col("next_url").isNotNull()).select("url", "content", "next_url")
    begin = keep_first(begin, ["url"], [F.col("content").isNull(), "content", "next_url"])
    chains = paginated(begin, out.select("url", "content", "next_url"), s).where("n_pages > 1").select(F.col("url").alias("__u"), F.col("content").alias("__c"), "n_pages")
    both = out.drop("next_url").join(chains, out["url"] == chains["__u"], "left")
    source = F.concat("extraction_source", F.coalesce(F.concat(F.lit("+pagination:"), F.col("n_pages").cast("string")), F.lit("")))
    return both.withColumns({"content": F.coalesce("__c", "content"), "extraction_source": source}).drop("__u", "__c", "n_pages")


def curated(pages: DataFrame, sites: DataFrame | None = None, s: Settings = Settings(), whitelist: list[str] = (), selectors: DataFrame | None = None, seen: DataFrame | None = None, text: bool = True, **lists) -> DataFrame:
    """All pages with ``reject_reason``: fetch errors, gates, first copy wins, then the cap of each host.

    The cap counts what passes the gates, host by host in order of id. A page
    beyond it has registered its fingerprint, as batch order demands. Without
    ``text`` the result has no ``main``, and no text is shuffled or stored.
    """
    rows = gated(extracted_pages(pages, sites, selectors, s), ["id"], s, seen, text, "rendered_html", "fetch_error", **lists).withColumn("host", U.host(F.col("url")))
    passed = rows.where(F.col("reject_reason").isNull())
    kept = cap_per_key(passed.select("host", "id"), ["host"], ["id"], s.cap(bool(whitelist))).select(F.col("id").alias("__id"), F.lit(True).alias("__kept"))
    both = rows.join(kept, rows["id"].eqNullSafe(kept["__id"]), "left")
    over = F.col("reject_reason").isNull() & F.col("__kept").isNull()
    return both.withColumn("reject_reason", F.when(over, F.concat(F.lit("domain_cap:"), "host")).otherwise(F.col("reject_reason"))).drop("__kept", "__id")


def curated_in_order(pages: DataFrame, sites: DataFrame | None = None, s: Settings = Settings(), whitelist: list[str] = (), selectors: DataFrame | None = None, seen: DataFrame | None = None, accepted: DataFrame | None = None, text: bool = True, **lists) -> Settled:
    """As :func:`curated`, but as one worker does it page by page, in order of id: a page beyond its host's cap is not looked at and leaves no fingerprint.

    ``accepted`` (host, n) counts what hosts had before.
    """
    rows = judged(extracted_pages(pages, sites, selectors, s), s, text, "rendered_html", "fetch_error", **lists).withColumn("host", U.host(F.col("url")))
    return in_claim_order(rows, ["id"], s.cap(bool(whitelist)), seen=seen, accepted=accepted)


def selectors_seen(rows: DataFrame, at: Column, s: Settings = Settings()) -> DataFrame:
    """(domain, selector, last_seen, quality) for the cache: selectors that were found, not given, and gave good text."""
    found = F.col("extraction_source").rlike("^(?:rendered:)?css:") & (F.col("quality") >= s.min_quality) & F.col("selector_used").isNotNull()
    return rows.where(found).select(U.host(F.col("url")).alias("domain"), F.col("selector_used").alias("selector"), at.cast("long").alias("last_seen"), "quality")


def settled(jobs: DataFrame, rows: DataFrame, now: Column, unit: Column | None = None, s: Settings = Settings()) -> DataFrame:
    """The frontier after ``rows`` (of :func:`curated`, with main): fetch errors are to be tried again, rejected pages ignored, the others completed."""
    reason = F.col("reject_reason")
    error = reason.rlike("^(?:HTTP [0-9]+$|fetch:)")
    jobs = frontier.fail(jobs, rows.where(error).select("id", reason.alias("error")), now, unit, s)
    jobs = frontier.ignore(jobs, rows.where(reason.isNotNull() & ~error).select("id", reason.alias("reason")), now)
    meta = F.create_map(F.lit("extraction_source"), F.col("extraction_source"), F.lit("extraction_quality"), F.col("quality").cast("string"))
    return frontier.complete(jobs, rows.where(reason.isNull()).select("id", "title", F.col("main").alias("content_markdown"), meta.alias("metadata")), now)
