"""Manifest, phrase, URL and page sources."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.functions import urls as U
from corpusloom.functions import vocabulary as V
from corpusloom.operators.dedupe import ordered_distinct

MANIFEST_TYPE = "site string, method string, selectors map<string,string>, strip array<string>, sitemaps array<string>, allow array<string>"


def manifest_rows(text: str) -> list[tuple]:
    """The rows of a YAML manifest: keys trimmed and lower-cased, blanks dropped; none if it cannot be read."""
    import yaml

    try:
        found = yaml.safe_load(text) or {}
    except yaml.YAMLError:
        return []
    listed = lambda c, k: [str(x).strip() for x in c.get(k) or [] if x is not None and str(x).strip()] if isinstance(c.get(k) or [], list) else []
    rows = {}
    for site, c in found.items() if isinstance(found, dict) else ():
        if isinstance(site, str) and isinstance(c, dict):
            chosen = c.get("selectors") if isinstance(c.get("selectors"), dict) else {}
            selectors = {str(k).strip().lower(): str(v).strip() for k, v in chosen.items() if v is not None and str(k).strip() and str(v).strip()}
            rows[site.strip().lower()] = (str(c.get("method") or "").strip().lower(), selectors, listed(c, "strip"), listed(c, "sitemaps"), listed(c, "allow"))
    return [(site, *r) for site, r in rows.items()]


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Site manifest as a table; empty if the file is missing or broken. The file is small by nature."""
    try:
        text = "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())
    except Exception as e:  # only a missing path; anything else is an error
        if "PATH_NOT_FOUND" not in str(e):
            raise
        text = ""
    return spark.createDataFrame(manifest_rows(text), MANIFEST_TYPE)


def _numbered(spark: SparkSession, path: str) -> DataFrame:
    """Lines of one text file with their order."""
    return spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r\n|\n|\r", -1)).alias("pos", "line"))


def phrases(lines: DataFrame) -> DataFrame:
    """(pos, phrase, site) of lines (pos, line): comments and site suffixes gone, once each at its first place."""
    s = X.strip(F.col("line"))
    rows = lines.select("pos", s.alias("s")).where((F.col("s") != "") & ~F.startswith("s", F.lit("#")))
    bare = X.strip(F.regexp_replace("s", r"(?i)\(\s*site:[^)]+\)\s*$", ""))
    bare = F.when(F.contains(F.lower(bare), F.lit("site:")), F.regexp_replace(bare, r"(?is)\bsite:\S+.*$", "")).otherwise(bare)
    site = F.nullif(F.regexp_extract("s", r"(?i)site:([^)\s]+)", 1), F.lit(""))
    rows = rows.select("pos", X.squeezed(bare).alias("phrase"), site.alias("site")).where("phrase <> ''")
    first = ordered_distinct(rows, ["phrase"], "pos")
    return rows.join(first, ["phrase", "pos"]).select("pos", "phrase", "site")


def phrase_file(spark: SparkSession, path: str) -> DataFrame:
    return phrases(_numbered(spark, path))


def url_list(lines: DataFrame) -> DataFrame:
    """(pos, url) of lines that are neither blank nor comments."""
    s = X.strip(F.col("line"))
    return lines.select("pos", s.alias("url")).where((F.col("url") != "") & ~F.startswith("url", F.lit("#")))


def seeds(lines: DataFrame) -> DataFrame:
    return url_list(lines).where(U.is_valid_crawl_url(F.col("url"))).withColumn("source", F.lit("seed:urls.txt"))


def focused_seeds(spark: SparkSession, only_domain: str | None, seed_url: str | None = None) -> DataFrame:
    """(pos, url): the given seed, or the listing pages of a focused run's domain."""
    low = (only_domain or "").lower()
    urls = [seed_url] if seed_url else [u for end, us in V.SEEDS.items() if low.endswith(end) for u in us]
    return spark.createDataFrame(list(enumerate(urls)), "pos int, url string")


def line_count(spark: SparkSession, path: str) -> int:
    return spark.read.text(path).count()


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def binary_pages(spark: SparkSession, path: str, glob: str = "*.pdf") -> DataFrame:
    """(pdf_url, content) of files under a path; contents are read only where they are asked for."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return files.select(F.col("path").alias("pdf_url"), "content")


def markdown_of_pdf(data: bytes) -> str:
    """A PDF as markdown, where the libraries for it are installed."""
    import pymupdf
    import pymupdf4llm

    return pymupdf4llm.to_markdown(pymupdf.open(stream=data, filetype="pdf"))


def decoded(files: DataFrame, decode: Callable[[bytes], str] = markdown_of_pdf) -> DataFrame:
    """(pdf_url, text) of (pdf_url, content); null where a file can't be decoded. A missing library is an error."""

    def text(data: bytes | None) -> str | None:
        if data is None:
            return None
        try:
            return decode(bytes(data))
        except ImportError:
            raise
        except Exception:  # noqa: BLE001 - a damaged file is no reason to stop
            return None

    return files.select("pdf_url", F.udf(text, "string", useArrow=True)("content").alias("text"))
