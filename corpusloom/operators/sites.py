"""Joins of URLs with site tables, by host suffix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import urls as U


def host_suffixes(host):
    """The host and everything after each of its dots, longest first."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def match_sites(urls: DataFrame, sites: DataFrame, url_col: str = "url", site_col: str = "site") -> DataFrame:
    """``urls`` with the site of the longest suffix of their host; null columns if none.

    Suffixes make it an equi-join; the longest one comes from an aggregate over
    distinct hosts, so neither a nested loop nor a window over all rows.
    """
    hosts = urls.select(U.host(F.col(url_col)).alias("__host")).distinct()
    each = hosts.select("__host", F.explode(host_suffixes(F.col("__host"))).alias(site_col))
    hit = each.join(sites.select(site_col), site_col, "left_semi").groupBy("__host").agg(F.max_by(site_col, F.struct(F.char_length(site_col), site_col)).alias("__site"))
    found = hit.join(sites, hit["__site"] == sites[site_col]).drop("__site")
    return urls.withColumn("__host", U.host(F.col(url_col))).join(found, "__host", "left").drop("__host")


def without_blocked(urls: DataFrame, domains: DataFrame, url_col: str = "url", domain_col: str = "domain") -> DataFrame:
    """URLs whose host is not a domain of the table, nor below one."""
    return _suffix(urls, domains, url_col, domain_col, "left_anti")


def whitelisted(urls: DataFrame, domains: DataFrame, url_col: str = "url", domain_col: str = "domain") -> DataFrame:
    return _suffix(urls, domains, url_col, domain_col, "left_semi")


def _suffix(urls: DataFrame, domains: DataFrame, url_col: str, domain_col: str, how: str) -> DataFrame:
    hosts = urls.select(U.host(F.col(url_col)).alias("__host")).distinct()
    each = hosts.select("__host", F.explode(host_suffixes(F.col("__host"))).alias(domain_col))
    hit = each.join(domains.select(domain_col).distinct(), domain_col, "left_semi").select("__host").distinct()
    return urls.withColumn("__host", U.host(F.col(url_col))).join(hit, "__host", how).drop("__host")


def with_selector(urls: DataFrame, cache: DataFrame, url_col: str = "url") -> DataFrame:
    """``urls`` with the cached selector of their host (domain, selector), null if none; of several the latest by ``last_seen``, if there is one."""
    order = F.struct("last_seen", "selector") if "last_seen" in cache.columns else F.col("selector")
    cache = cache.groupBy("domain").agg(F.max_by("selector", order).alias("selector"))
    return urls.withColumn("domain", U.host(F.col(url_col))).join(cache.select("domain", "selector"), "domain", "left")
