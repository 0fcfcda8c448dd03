"""Names for use in SQL: ``register(spark)`` makes the functions below temporary ones of the session."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urljoin

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.functions import urls as U
from corpusloom.functions import vocabulary as V
from corpusloom.functions.fuzzy import partial_ratio
from corpusloom.sources.sitemap import gunzip

#: SQL functions whose bodies are Catalyst expressions: arguments, result, body. Bodies hold no lambdas, which have no SQL text.
EXPRESSIONS = {
    "url_priority": ("u STRING", "INT", lambda: U.url_priority(F.col("u"))),
    "is_valid_crawl_url": ("u STRING", "BOOLEAN", lambda: U.is_valid_crawl_url(F.col("u"))),
    "word_count": ("t STRING", "INT", lambda: F.regexp_count(X.given(F.col("t")), F.lit(f"{X.NO_SPACE}+"))),
    "content_fingerprint": ("t STRING", "STRING", lambda: F.sha2(X.strip(F.regexp_replace(F.lower(X.given(F.col("t"))), f"{X.SPACE}+", " ")).cast("binary"), 256)),
}


class LinkTable:
    """A table function: (pos, url) of a page's links, resolved against its address."""

    def eval(self, base: str, html: str) -> Iterator[tuple[int, str]]:
        import re

        for i, m in enumerate(re.finditer(r'href="([^"]*)"', html or "", re.IGNORECASE)):
            if not m[1].startswith(("#", "javascript:", "mailto:", "tel:")):
                yield i, urljoin(base or "", m[1])


def register(spark: SparkSession, terms: list[str] = V.SCIENCE_TERMS) -> None:
    spark.udf.register("partial_ratio", F.udf(lambda a, b: float(partial_ratio(a or "", b or "")), "double", useArrow=True))
    spark.udf.register("normalize_url", F.udf(lambda u: U.normalized(u), "string", useArrow=True))
    spark.udf.register("maybe_gunzip", F.udf(lambda b: gunzip(b), "binary", useArrow=True))
    spark.udf.register("absolute_url", F.udf(lambda b, h: urljoin(b or "", h or ""), "string", useArrow=True))
    spark.udtf.register("page_links", F.udtf(LinkTable, returnType="pos int, url string"))
    for name, (args, kind, body) in EXPRESSIONS.items():
        column = args.split()[0]
        view = spark.createDataFrame([], f"{column} string").select(body().alias("x"))
        sql = view._jdf.queryExecution().analyzed().expressions().head().child().sql()
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {kind} RETURN {sql}")
