"""Search tasks: queries from phrases, engines and pages, sharded and taken in batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.functions import urls as U
from corpusloom.functions import vocabulary as V
from corpusloom.operators.dedupe import ordered_distinct
from corpusloom.settings import Settings
from corpusloom.storage import stored


def site_queries(keywords: DataFrame, site: str, s: Settings = Settings()) -> DataFrame:
    """(pos, query): phrases of two words or more (pos, phrase) in every wording, once each, the first ``max_site_queries``.

    Positions follow from arithmetic, so the limit is the only global step.
    """
    low = site.strip().lower().replace("https://", "").replace("http://", "").split("/")[0] or site
    n = len(V.QUERY_TEMPLATES)
    wordings = F.array(*[F.lit(t.replace("{site}", low)) for t in V.QUERY_TEMPLATES])
    rows = keywords.select("pos", X.strip(F.col("phrase")).alias("kw")).where(X.word_count(F.col("kw")) >= 2)
    rows = rows.select("pos", "kw", F.posexplode(wordings).alias("i", "t"))
    rows = rows.select((F.col("pos") * n + F.col("i")).alias("pos"), F.replace("t", F.lit("{kw}"), F.col("kw")).alias("query"))
    return ordered_distinct(rows, ["query"], "pos").orderBy("pos").limit(s.max_site_queries).select("pos", "query")


def tag_urls(phrases: DataFrame) -> DataFrame:
    """(pos, search_url, engine): tag pages of phrases (pos, phrase), once each."""
    rows = phrases.select("pos", U.tag_slug(F.col("phrase")).alias("slug")).where("slug <> ''")
    rows = ordered_distinct(rows, ["slug"], "pos")
    return rows.select("pos", F.concat(F.lit("https://www.kompas.com/tag/"), F.col("slug")).alias("search_url"), F.lit("kompas_tag").alias("engine"))


def engine_urls(queries: DataFrame, pages: int) -> DataFrame:
    """(pos, search_url, engine): each query's pages on both engines, in order."""
    each = F.array(F.lit("duckduckgo"), F.lit("bing"))
    rows = queries.select("pos", "query", F.explode(F.sequence(F.lit(0), F.lit(pages - 1))).alias("page"))
    rows = rows.select("*", F.posexplode(each).alias("e", "engine"))
    url = F.when(F.col("e") == 0, U.duckduckgo_url(F.col("query"), F.col("page"))).otherwise(U.bing_url(F.col("query"), F.col("page")))
    return rows.select(((F.col("pos") * pages + F.col("page")) * 2 + F.col("e")).alias("pos"), url.alias("search_url"), "engine")


def static_queries(spark: SparkSession, queries: list[str] = V.SEARCH_QUERIES) -> DataFrame:
    return spark.createDataFrame(list(enumerate(queries)), "pos int, query string")


def search_tasks(spark: SparkSession, only_domain: str | None = None, phrases: DataFrame | None = None, keywords: DataFrame | None = None, shard: int = 0, shards: int = 1, s: Settings = Settings()) -> DataFrame:
    """(idx, search_url, engine): tag pages of a kompas run, else engine pages of site or static queries; one shard of them.

    ``idx`` numbers the whole list from 0; a shard is what it leaves modulo ``shards``.
    """
    pages = s.pages_per_focused_query if only_domain else s.pages_per_query
    if only_domain and only_domain.endswith("kompas.com"):
        tasks = tag_urls(phrases) if phrases is not None else spark.createDataFrame([], "pos int, search_url string, engine string")
    else:
        if only_domain and keywords is None:
            keywords = spark.createDataFrame(list(enumerate(V.TARGET_KEYWORDS)), "pos int, phrase string")
        tasks = engine_urls(site_queries(keywords, only_domain, s) if only_domain else static_queries(spark), pages)
    ranked = _numbered(tasks)
    return ranked.where(F.pmod("idx", F.lit(shards)) == shard) if shards > 1 else ranked


def _numbered(tasks: DataFrame) -> DataFrame:
    """Places 0, 1, … by ``pos``, of lists of any length: places inside ranges of ``pos``, and a sum over the ranges' sizes."""
    from pyspark.sql import Window as W

    rows = stored(tasks.repartitionByRange(F.col("pos")).withColumn("part", F.spark_partition_id()))
    sizes = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rows = rows.join(sizes.select("part", before.alias("before")), "part")
    place = F.row_number().over(W.partitionBy("part").orderBy("pos")) - 1 + F.col("before")
    return rows.select(place.cast("int").alias("idx"), "search_url", "engine")


def batch(tasks: DataFrame, at: int, size: int = 6) -> tuple[DataFrame, int]:
    """The tasks from ``at`` on and the next place; past the end an empty batch, and 0 again."""
    last = tasks.agg(F.max("idx")).first()[0]
    if last is None or at > last:
        return tasks.limit(0), 0
    return tasks.where((F.col("idx") >= at) & (F.col("idx") < at + size)), at + size
