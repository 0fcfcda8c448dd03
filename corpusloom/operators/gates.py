"""The ordered gates of the crawl, as one reason column."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.functions import urls as U
from corpusloom.functions import vocabulary as V
from corpusloom.operators.dedupe import first_of_key
from corpusloom.operators.extract import rendered_page
from corpusloom.settings import Settings
from corpusloom.storage import stored


def with_stages(df: DataFrame, content: str = "content", title: str = "title") -> DataFrame:
    """Adds cleaned, main, __flat, quality and fingerprint, each computed once, from the one before."""
    df = X.computed(df, "cleaned", X.clean_markdown(F.col(content)))
    df = X.computed(df, "main", X.main_paragraphs(F.col("cleaned")))
    df = X.computed(df, "__flat", X.flat(F.col("main")))
    both = F.struct(X.extraction_quality(F.col("main"), F.col(title), F.col("__flat")).alias("quality"), X.fingerprint(F.col("main"), F.col("__flat")).alias("fingerprint"))
    return X.computed(df, "__s", both).select("*", "__s.quality", "__s.fingerprint").drop("__s")


def early_reason(content: str = "content", s: Settings = Settings()):
    """Gates before the fingerprint: nothing found, too short in three stages, poor."""
    under = lambda c, n: X.shorter(X.stripped(X.given(F.col(c))), n)
    raw = F.when(under(content, 1), "no_content").when(under(content, s.min_raw_chars), "too_short_raw")
    return raw.when(under("cleaned", s.min_clean_chars), "too_short_clean").when(under("main", s.min_main_chars), "too_short_main").when(F.col("quality") < s.min_quality, "low_extraction_quality")


def late_reason(url: str = "url", title: str = "title", s: Settings = Settings(), keywords: Sequence[str] = V.TARGET_KEYWORDS, common: Sequence[str] = V.COMMON_WORDS, ads: Sequence[str] = V.AD_SIGNALS, flattened: str | None = None):
    """Gates after it: advertisement, language, relevance."""
    need = F.when(U.is_priority_section(F.col(url)), max(1, s.min_keywords - 1)).otherwise(max(1, s.min_keywords))
    both = F.concat(X.given(F.col(title)), F.lit(" "), F.col("main"))
    out = F.when(X.ad_signals(F.col("main"), ads) >= s.max_ad_signals, "advertisement")
    out = out.when(~U.is_english_subject(F.col(url)) & ~X.is_language(F.col("main"), common, s.language_threshold, flattened=F.col(flattened) if flattened else None), "non_indonesian")
    return out.when(X.relevance_score(both, keywords) < need, "low_relevance")


def _rendered(df: DataFrame, rendered: str, title: str, s: Settings) -> DataFrame:
    """Poor pages once more from their rendered HTML: what is found there stands as it is, with its quality and fingerprint."""
    poor = F.when(F.col("early") == "low_extraction_quality", F.col(rendered))
    df = df.withColumn("__r", rendered_page(poor)).withColumn("__text", X.strip(X.given(F.col("__r.content"))))
    both = F.struct(X.extraction_quality(F.col("__text"), F.col(title)).alias("quality"), X.fingerprint(F.col("__text")).alias("fingerprint"), X.flat(F.col("__text")).alias("__flat"))
    df = X.computed(df, "__s", F.when(F.col("__text") != "", both))
    new = F.col("__s").isNotNull()
    out = {n: F.when(new, F.col(f"__s.{n}")).otherwise(F.col(n)) for n in ("quality", "fingerprint", "__flat")} | {"main": F.when(new, F.col("__text")).otherwise(F.col("main"))}
    out["early"] = F.when(new & (F.col("__s.quality") >= s.min_quality), F.lit(None).cast("string")).otherwise(F.col("early"))
    for own, theirs in (("extraction_source", F.concat(F.lit("rendered:"), F.col("__r.source"))), ("selector_used", F.col("__r.selector"))):
        if own in df.columns:
            out[own] = F.when(new, theirs).otherwise(F.col(own))
    return df.select(*[out.get(c, F.col(c)).alias(c) for c in df.columns if c not in ("__r", "__s", "__text", rendered)])


def judged(df: DataFrame, s: Settings = Settings(), text: bool = True, rendered: str | None = None, failed: str | None = None, **lists) -> DataFrame:
    """``df`` (url, title, content) without content but with main, quality, fingerprint and what the gates before and after the fingerprint say, early and late.

    These depend on the page alone and are settled where it is; late is null
    where early is not. Without ``text`` no text is stored, nor main returned.
    ``rendered`` names a column of HTML for a second try of pages of poor
    quality; ``failed`` one that says why a page could not be fetched, which
    goes before all gates.
    """
    df = X.computed(with_stages(df), "early", early_reason(s=s))
    if rendered is not None:
        df = _rendered(df, rendered, "title", s)
    if failed is not None:
        df = df.withColumn("early", F.coalesce(failed, "early")).drop(failed)
    df = X.computed(df, "late", F.when(F.col("early").isNull(), late_reason(s=s, flattened="__flat", **lists)))
    return stored(df.drop("content", "cleaned", "__flat", *([] if text else ["main"])))


def gated(df: DataFrame, order: Sequence[str], s: Settings = Settings(), seen: DataFrame | None = None, text: bool = True, rendered: str | None = None, failed: str | None = None, **lists) -> DataFrame:
    """:func:`judged` pages with ``reject_reason``, null for what passes, instead of early and late.

    A fingerprint counts as seen from the first page that reaches it, in
    ``order``, even if a later gate rejects that page; and if ``seen``
    (fingerprint) holds it. Only ``order`` and fingerprints are shuffled to
    find first pages.
    """
    df = judged(df, s, text, rendered, failed, **lists)
    reached = df.where(F.col("early").isNull()).select(*order, "fingerprint")
    first = first_of_key(reached, ["fingerprint"], order, "first_seen")
    if seen is not None:
        first = first.join(seen.select("fingerprint", F.lit(True).alias("known")).distinct(), "fingerprint", "left")
        first = first.withColumn("first_seen", F.col("first_seen") & F.col("known").isNull())
    again = first.where(~F.col("first_seen")).select(*[F.col(c).alias(f"__{c}") for c in order], F.lit(True).alias("__again"))
    same = reduce(Column.__and__, [df[c].eqNullSafe(again[f"__{c}"]) for c in order])
    reason = F.coalesce("early", F.when(F.col("__again"), "duplicate_content"), "late")
    return df.join(again, same, "left").withColumn("reject_reason", reason).drop("early", "late", "__again", *[f"__{c}" for c in order])


def reason_counts(df: DataFrame) -> DataFrame:
    """Rows by outcome; what passes counts as ``accepted``."""
    return df.groupBy(F.coalesce("reject_reason", F.lit("accepted")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def training_records(df: DataFrame, s: Settings = Settings(), compat: bool = True) -> DataFrame:
    """(text, source, url, level, word_count) of accepted pages (url, title, main) that hold up as plain prose."""
    out = df.select("url", "title", "main", X.classify_level(F.col("main"), F.col("url")).alias("level"))
    out = X.computed(out, "plain", X.clean_for_training(X.plain_text(F.col("main")), compat=compat)).where(F.col("plain") != "")
    out = X.computed(out, "text", X.with_title(F.col("plain"), F.col("title")))
    out = out.where(X.is_quality_content(F.col("text"), s.min_record_words))
    return out.select("text", U.host(F.col("url")).alias("source"), "url", "level", X.word_count(F.col("text")).cast("int").alias("word_count"))


def raw_records(df: DataFrame, timestamp, keywords: Sequence[str] = V.TARGET_KEYWORDS) -> DataFrame:
    """The nested raw record of accepted pages (url, title, main, quality)."""
    both = F.concat(X.given(F.col("title")), F.lit(" "), F.col("main"))
    found = X.keywords_found(both, keywords)
    meta = F.struct(
        X.classify_level(F.col("main"), F.col("url")).alias("level"),
        found.alias("keywords_found"),
        U.host(F.col("url")).alias("source_domain"),
        X.word_count(F.col("main")).cast("int").alias("word_count"),
        F.size(found).alias("relevance_score"),
        F.lit(0).alias("fuzzy_science_score"),
        F.array().cast("array<struct<term:string,score:int>>").alias("fuzzy_science_hits"),
        F.col("quality").alias("extraction_quality"),
    )
    return df.select("url", "title", F.col("main").alias("markdown_content"), X.utc_iso(timestamp).alias("timestamp"), meta.alias("metadata"))
