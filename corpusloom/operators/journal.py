"""Journal pages and their PDFs' texts; the standalone cleaner; the extraction experiment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.functions import urls as U
from corpusloom.functions import vocabulary as V
from corpusloom.functions.fuzzy import fuzzy_relevance
from corpusloom.functions.slices import by_slices
from corpusloom.operators import extract as E
from corpusloom.operators.links import absolute
from corpusloom.settings import Settings


def journal_pages(pages: DataFrame, domains: Sequence[str] = V.JOURNAL_DOMAINS, terms: Sequence[str] = V.JOURNAL_WORDS) -> DataFrame:
    """(url, title, authors, abstract, links) of relevant pages (url, html) of the listed domains."""
    read = by_slices(lambda html: E.citation_metadata(html) | {"links": E.pdf_links(html)}, "title string, authors array<string>, abstract string, links array<string>")
    rows = X.computed(pages.where(U.is_journal_url(F.col("url"), domains)).select("url", "html"), "m", read("html")).select("url", "m.*")
    return rows.where(X.is_education_related(F.col("abstract"), F.col("title"), terms))


def journal_records(pages: DataFrame, pdfs: DataFrame, s: Settings = Settings(), domains: Sequence[str] = V.JOURNAL_DOMAINS, terms: Sequence[str] = V.JOURNAL_WORDS) -> DataFrame:
    """A record for each of a page's first ``max_pdfs`` PDFs whose text (pdf_url, text) has 500 characters when cleaned.

    PDFs are taken in the order of their addresses.
    """
    found = journal_pages(pages, domains, terms)
    each = found.select("url", "title", "authors", "abstract", F.posexplode("links").alias("pos", "href")).where(F.col("pos") < s.max_pdfs)
    each = each.withColumn("pdf_url", absolute("url", "href"))
    rows = each.join(pdfs.select("pdf_url", X.clean_pdf_text(F.col("text")).alias("content")), "pdf_url").where(F.char_length("content") >= 500)
    return rows.select(
        F.col("pdf_url").alias("url"), F.col("url").alias("source_page"), "title", "authors", "abstract", "content",
        X.word_count(F.col("content")).cast("int").alias("word_count"), F.lit("jurnal_ilmiah").alias("type"), F.lit("umum").alias("level"),
    )


def cleaner_records(pages: DataFrame, terms: Sequence[str] = V.CLEANER_WORDS, min_words: int = 30, least: int = 1) -> DataFrame:
    """(text, source, url, word_count, level) of pages (url, html) with enough words and terms."""
    main = by_slices(lambda html: E.cleaner_html(html, min_words=min_words), "string")
    rows = X.computed(pages.select("url", main("html").alias("m")), "text", F.array_join(X.cleaner_lines(F.col("m")), "\n"))
    rows = rows.where(X.cleaner_valid(F.col("text"), terms, min_words, least))
    return rows.select("text", U.source_of(F.col("url")).alias("source"), "url", X.word_count(F.col("text")).cast("int").alias("word_count"), F.lit(V.OTHER_LEVEL).alias("level"))


def experiment_records(pages: DataFrame, s: Settings = Settings(), keywords: Sequence[str] = V.TARGET_KEYWORDS, science: Sequence[str] = V.SCIENCE_TERMS, common: Sequence[str] = V.COMMON_WORDS) -> DataFrame:
    """Records of pages (url, html) by the page's stretches of text: long, good, in the language, relevant exactly or nearly."""

    def read(html):
        root = E.dom.parse(html or "")
        return {"title": E.title_of(root), "content": E.readable(root)}

    # each page is parsed once: a condition on a UDF's result would be pushed below it with the UDF
    rows = X.computed(pages.select("url", "html"), "m", by_slices(read, "title string, content string")("html"))
    rows = X.computed(rows.select("url", "m.title", "m.content").withColumnRenamed("content", "raw"), "content", X.normalize_text(F.col("raw"))).drop("raw")
    rows = rows.where(F.char_length("content") >= 100).withColumn("quality", X.extraction_quality(F.col("content"), F.col("title")))
    rows = rows.where((F.col("quality") >= s.min_quality) & X.is_language(F.col("content"), common, s.language_threshold))
    rows = X.computed(rows.withColumn("exact", X.relevance_score(F.col("content"), keywords)), "fuzzy", fuzzy_relevance(science)("content"))
    rows = rows.where((F.col("exact") >= s.min_keywords) | (F.col("fuzzy.score") > 0))
    meta = F.struct(F.col("exact").alias("relevance_score"), F.col("fuzzy.score").alias("fuzzy_science_score"), F.col("fuzzy.hits").alias("fuzzy_science_hits"), F.col("quality").alias("extraction_quality"))
    return rows.select("url", "title", "content", X.word_count(F.col("content")).cast("int").alias("word_count"), meta.alias("metadata"))
