"""Queries over the supplied tables, one or more for each operator, with their SQL.

Vocabularies are those of the tables' languages, as operators take any.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.functions import tokens
from corpusloom.functions import urls as U
from corpusloom.functions.automaton import matcher
from corpusloom.functions.fuzzy import fuzzy_relevance
from corpusloom.operators import frontier, gates, journal, links, sinks, sites
from corpusloom.operators.claims import accepted_per_host, in_claim_order
from corpusloom.operators.dedupe import cap_per_key, first_of_key, keep_first, not_seen
from corpusloom.operators.extract import titles
from corpusloom.plans import crawl, discovery
from corpusloom.settings import Settings
from corpusloom.sources import archive, readers, sitemap
from corpusloom.storage import shared_dir, spread
from corpusloom.streaming import crawl_stream

KEYWORDS = ["the", "les", "und", "que", "ing"]
COMMON = ["the", "of", "and", "de", "la", "der", "die", "le", "les", "el"]
SIGNALS = ["tion", "ment", "keit", "ando", "heit", "oure", "ough"]
LEVELS = [("EN", r"\b(the|and)\b"), ("FR", r"\b(les|une)\b"), ("DE", r"\b(der|das)\b")]
SITES = [("example.org", "css"), ("example.com", "css"), ("www.example.com", "density"), ("blog.example.net", ""), ("example.net", "density")]
BLOCKED = ["example.com", "m.example.org"]
SHARDS = 3
#: Accepted pages a host of documents as pages, few enough that hosts fill up.
CLAIM_CAP = 20
#: Site, method, and what stands before and after an article's paragraphs there.
SITE_MARKUP = [
    ("detik.com", "custom_detik", '<div class="detail__body-text itp_bodycontent">', '<table class="linksisip"><tr><td><p>lain</p></td></tr></table><p>Baca juga: lain</p><div><p>dalam</p></div></div>'),
    ("ruangguru.com", "custom_ruangguru", '<div class="content-body"><p><img src="a.png"></p>', "<p>&nbsp;</p><p>(Sumber: lain)</p><ol><li>satu</li><li></li><li>tiga</li></ol></div>"),
    ("liputan6.com", "custom_liputan6", '<div class="article-content-body__item-content">', '<div id="div-gpt-ad-1"><p>iklan</p></div><p>Advertisement</p><p>BACA JUGA: lain</p></div>'),
    ("republika.co.id", "custom_republika", '<div class="article-content"><script>var x;</script>', '<div class="terkait"><p>lain</p></div></div>'),
    ("quipper.com", "custom_quipper", '<div id="penci-post-entry-inner"><div class="lwptoc"><p>isi</p></div><h2>Awal</h2>', '<div class="post-tags"><p>lain</p></div></div>'),
    ("zenius.net", "custom_zenius", '<section class="gh-content">', '<p><img alt="a+b">x</p><p>Baca Juga: lain</p><div class="kg-callout-card">kotak</div><div>lain</div></section>'),
    ("kompas.com", "css", '<div class="read__content">', "<nav>lain</nav></div>"),
]
OLD_URLS = ["https://www.kompas.com/edu/a", "https://www.kompas.com/skola/b", "https://edukasi.kompas.com/c", "https://tekno.kompas.com/d", "https://other.com/?u=kompas.com", "https://www.kompas.com.evil.org/e", "https://notkompas.com/f"]
RULE_HOSTS = ["www.kompas.com", "edukasi.kompas.com", "tekno.kompas.com", "www.detik.com", "www.ruangguru.com", "m.liputan6.com", "news.republika.co.id", "www.quipper.com", "www.zenius.net", "example.org", "kompas.com.evil.org"]
RULE_SECTIONS = ["/edu/", "/skola/", "/blog/", "/read/", "/berita/", "/", "/edu/bahasa-inggris/", "/English/"]
NOW = "timestamp'2024-01-15 00:00:00'"


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return spread(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text", "lang", "source"))


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return spread(spark.read.parquet(f"{d}/pages.parquet").select("page_id", "url", "html"))


def _jobs(spark: SparkSession, d: str) -> DataFrame:
    """Events as a frontier: statuses, attempts and priorities by arithmetic on their ids."""
    e = spark.read.parquet(f"{d}/events.parquet")
    status = F.element_at(F.array(*map(F.lit, ["pending", "processing", "completed", "failed", "ignored"])), (F.col("event_id") % 5 + 1).cast("int"))
    url = F.concat(F.lit("https://h"), F.col("user_id") % 50, F.lit(".example.org/p/"), F.col("event_id"))
    retry = F.when(F.col("event_id") % 3 == 0, F.timestamp_micros(F.unix_micros(F.expr(NOW)) + (F.col("event_id") % 7 - 3) * 3_600_000_000))
    return e.select(
        F.col("event_id").alias("id"), U.url_hash(url).alias("url_hash"), url.alias("url"), U.host(url).alias("domain"), status.alias("status"),
        F.lit(None).cast("string").alias("title"), F.lit(None).cast("string").alias("content_markdown"), F.create_map(F.lit("type"), F.col("event_type")).alias("metadata"),
        F.col("ts").alias("created_at"), F.col("ts").alias("updated_at"), (F.col("event_id") % 4).cast("int").alias("attempts"), retry.alias("next_retry_at"),
        F.lit(None).cast("string").alias("last_error"), (F.col("event_id") % 11).cast("int").alias("priority"),
    )


def _page_text(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select(F.col("doc_id").alias("id"), F.concat(F.lit("https://"), F.col("source"), F.lit(".example.org/read/"), F.col("doc_id")).alias("url"), F.substring("text", 1, 12).alias("title"), F.col("text").alias("content"))


LISTS = {"keywords": KEYWORDS, "common": COMMON, "ads": SIGNALS}
LOOSE = Settings(min_keywords=2, max_ad_signals=4)


def _gated(spark: SparkSession, d: str, text: bool = True) -> DataFrame:
    return gates.gated(_page_text(spark, d), ["id"], LOOSE, text=text, **LISTS)


def _gates(s: SparkSession, d: str) -> DataFrame:
    return _gated(s, d, text=False).select(F.col("id").alias("doc_id"), "reject_reason")


def ranks_path() -> str:
    """A public byte-pair vocabulary, if its package is there."""
    try:
        import public_tokenizers
    except ImportError:
        return ""
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def _vocabulary(s: SparkSession, d: str) -> DataFrame:
    """Every document with how many of the benchmark's words of five letters or more it contains, and which come first and last."""
    b = s.read.parquet(f"{d}/benchmark.parquet")
    words = b.select(F.explode(F.split(F.lower("text"), " ")).alias("w")).where(F.col("w").rlike("^[a-z]{5,}$")).distinct().orderBy("w")
    rows = _docs(s, d).select("doc_id", matcher([r["w"] for r in words.collect()])(F.col("text")).alias("found"))
    return rows.select("doc_id", F.size("found").alias("n"), F.get("found", F.lit(0)).alias("first"), F.get("found", F.size("found") - 1).alias("last"))


def _in_order(s: SparkSession, d: str) -> DataFrame:
    """Documents as pages of their sources' hosts, worked off by id."""
    rows = gates.judged(_page_text(s, d), LOOSE, text=False, **LISTS).withColumn("host", U.host(F.col("url")))
    return in_claim_order(rows, ["id"], CLAIM_CAP).rows


def _claim(s: SparkSession, d: str) -> DataFrame:
    return frontier.claim(_jobs(s, d), F.expr(NOW), 25).select("id", "url", "priority")


def _retry(s: SparkSession, d: str) -> DataFrame:
    jobs = _jobs(s, d)
    failed = jobs.where("status = 'processing'").select("id", F.concat(F.lit("HTTP "), F.col("id").cast("string")).alias("error"))
    out = frontier.fail(jobs, failed, F.expr(NOW), F.lit(0.5))
    wait = (F.unix_micros("next_retry_at") - F.unix_micros(F.expr(NOW))).alias("wait_us")
    return out.join(failed.select("id"), "id", "left_semi").select("id", "status", "attempts", "last_error", wait)


def _complete(s: SparkSession, d: str) -> DataFrame:
    jobs = _jobs(s, d)
    done = jobs.where("status = 'processing'").select("id", F.lit("t").alias("title"), F.lit("c").alias("content_markdown"), F.create_map(F.lit("level"), F.lit("SMA"), F.lit("type"), F.lit("new")).alias("metadata"))
    out = frontier.complete(jobs, done, F.expr(NOW))
    return out.select("id", "status", "title", F.array_join(F.array_sort(F.transform(F.map_entries("metadata"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ",").alias("meta"))


def _enqueue(s: SparkSession, d: str) -> DataFrame:
    known = _pages(s, d).where("page_id % 4 = 0").select(U.url_hash(U.normalize_url(F.col("url"))).alias("url_hash")).distinct()
    return frontier.enqueue(known, _pages(s, d), F.expr(NOW)).select("url", "url_hash", "domain", "status", "priority")


def _selectors(s: SparkSession, d: str) -> DataFrame:
    p = _pages(s, d).select(U.host(F.col("url")).alias("domain"), F.concat(F.lit(".c"), F.col("page_id") % 3).alias("selector"), F.col("page_id").alias("last_seen"), (F.col("page_id") / 10.0).alias("quality"))
    return frontier.upsert_selectors(p.where("last_seen % 2 = 0"), p.where("last_seen % 2 = 1"))


def _sites(s: SparkSession) -> DataFrame:
    return s.createDataFrame(SITES, "site string, method string")


def _phrases(s: SparkSession, d: str) -> DataFrame:
    """The first three words of the benchmark's items, by id."""
    b = s.read.parquet(f"{d}/benchmark.parquet")
    return b.select(F.col("item_id").alias("pos"), F.array_join(F.slice(X.words(F.lower("text")), 1, 3), " ").alias("phrase"))


def _search(s: SparkSession, d: str) -> DataFrame:
    """All search tasks of a focused run, shard by shard, with the shard that does each."""
    each = [discovery.search_tasks(s, "example.org", keywords=_phrases(s, d), shard=i, shards=SHARDS).withColumn("shard", F.lit(i)) for i in range(SHARDS)]
    return reduce(DataFrame.unionByName, each)


def _backfill(s: SparkSession, d: str) -> DataFrame:
    """Jobs whose URLs meet every rule, and hosts and parameters that only look like it; some without priority."""
    kind = (F.col("id") % (len(OLD_URLS) + 1)).cast("int")
    url = F.coalesce(F.get(F.array(*map(F.lit, OLD_URLS)), kind), F.col("url"))
    jobs = _jobs(s, d).withColumn("url", url).withColumn("domain", U.host(F.col("url"))).withColumn("priority", F.when(F.col("id") % 13 != 0, F.col("priority")))
    return frontier.backfill_priority(jobs).groupBy("domain", "priority").agg(F.count(F.lit(1)).alias("n"))


def _ignore(s: SparkSession, d: str) -> DataFrame:
    jobs = _jobs(s, d)
    poor = jobs.where("status = 'processing'").select("id", F.concat(F.lit("too_short_"), F.repeat(F.lit("x"), 600)).alias("reason"))
    return frontier.ignore(jobs, poor, F.expr(NOW)).select("id", "status", "last_error", "attempts")


def _rule_urls(s: SparkSession, d: str) -> DataFrame:
    """Hosts and sections that the default rules name, and others, with the pages' numbers."""
    at = lambda xs: F.get(F.array(*map(F.lit, xs)), (F.col("page_id") % len(xs)).cast("int"))
    url = F.concat(F.lit("https://"), at(RULE_HOSTS), at(RULE_SECTIONS), F.col("page_id").cast("string"))
    return _pages(s, d).select("page_id", url.alias("url"))


def _url_rules(s: SparkSession, d: str) -> DataFrame:
    u = F.col("url")
    return _rule_urls(s, d).select(
        "page_id", U.url_priority(u).alias("priority"), U.is_english_subject(u).alias("english"), U.is_priority_section(u).alias("section"), U.normalize_domain(F.concat(F.lit(" "), F.upper(u))).alias("domain"),
        U.in_whitelist(u, ["kompas.com", "detik.com"]).alias("listed"), U.is_valid_crawl_url(u).alias("valid"), U.is_education_url(u).alias("education"),
    )


def _not_seen(s: SparkSession, d: str) -> DataFrame:
    """Documents whose content no English document has."""
    rows = _docs(s, d).select("doc_id", "lang", X.fingerprint(F.col("text")).alias("fingerprint"))
    return not_seen(rows, rows.where("lang = 'en'"), ["fingerprint"]).select("doc_id", "fingerprint")


def _cached(s: SparkSession, d: str) -> DataFrame:
    """Pages with the selector that their host's latest page has in the cache, hosts by the length of their names being unknown."""
    cache = _selectors(s, d).where(F.char_length("domain") % 3 != 0)
    return sites.with_selector(_pages(s, d), cache).select("page_id", "domain", "selector")


def _site_pages(s: SparkSession, d: str) -> DataFrame:
    """Every document as an article of one of seven sites, in its markup, between menus, boxes and links to other articles."""
    lines = F.filter(F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), X.strip), lambda x: x != "")
    safe = lambda x: F.replace(F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    body = F.array_join(F.transform(lines, lambda x: F.concat(F.lit("<p>"), safe(x), F.lit("</p>"))), "")
    kind = (F.col("doc_id") % len(SITE_MARKUP)).cast("int")
    of = lambda i: F.get(F.array(*[F.lit(m[i]) for m in SITE_MARKUP]), kind)
    html = F.concat(F.lit("<title> Judul "), F.col("doc_id"), F.lit("</title><nav>menu</nav>"), of(2), body, of(3), F.lit("<footer>kaki</footer>"))
    return _docs(s, d).select(F.col("doc_id").alias("id"), F.concat(F.lit("https://"), of(0), F.lit("/a/"), F.col("doc_id")).alias("url"), html.alias("html"))


def _site_rules(s: SparkSession, d: str) -> DataFrame:
    manifest = s.createDataFrame([(m[0], m[1], {"body": "div.read__content"} if m[1] == "css" else {}, ["nav"]) for m in SITE_MARKUP], "site string, method string, selectors map<string,string>, strip array<string>")
    out = crawl.extracted_pages(_site_pages(s, d), manifest)
    return out.select(F.col("id").alias("doc_id"), "title", "extraction_source", F.sha2(F.col("content").cast("binary"), 256).alias("content_sha"))


def _cleaned(f: Callable, name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda s, d: _docs(s, d).select("doc_id", F.sha2(f(F.col("text")).cast("binary"), 256).alias(name))


def _doc(**columns: Callable) -> Callable[[SparkSession, str], DataFrame]:
    return lambda s, d: _docs(s, d).select("doc_id", *[f(F.col("text")).alias(n) for n, f in columns.items()])


def _url(**columns: Callable) -> Callable[[SparkSession, str], DataFrame]:
    return lambda s, d: _pages(s, d).select("page_id", *[f(F.col("url")).alias(n) for n, f in columns.items()])


def _crawl(s: SparkSession, d: str) -> DataFrame:
    rows = crawl.curated(_pages(s, d).withColumnRenamed("page_id", "id"), _sites(s).withColumn("selectors", F.create_map().cast("map<string,string>")).withColumn("strip", F.array().cast("array<string>")), Settings(domain_cap=5), text=False, **LISTS)
    return rows.select("id", "host", "extraction_source", "reject_reason", "fingerprint")


def _archived(s: SparkSession, d: str) -> DataFrame:
    """The pages from an archive that they were written to: some not found, some records cut off; ids stand in the URLs."""
    folder = f"{shared_dir(s).rstrip('/')}/archive-{uuid.uuid4().hex}"
    status = F.when(F.col("page_id") % 7 == 3, 404).otherwise(200)
    lost = F.when(F.col("page_id") % 11 == 5, 1000).otherwise(0)
    url = F.concat("url", F.lit("#"), F.col("page_id").cast("string"))
    archive.write_archive(_pages(s, d).select(archive.record(url, status, F.col("html"), lost=lost).alias("value")), folder)
    return archive.archived_pages(s, folder).withColumn("id", F.substring_index("url", "#", -1).cast("long"))


def _archive_crawl(s: SparkSession, d: str) -> DataFrame:
    """The crawl of the archived pages, with what every fourth page would be known by seen before."""
    pages = _archived(s, d)
    known = gates.judged(crawl.extracted_pages(pages.where("id % 4 = 0")), text=False, failed="fetch_error", **LISTS).where("early IS NULL").select("fingerprint")
    rows = crawl.curated(pages, s=Settings(domain_cap=5), text=False, seen=known, **LISTS)
    return rows.select("id", "host", "reject_reason")


def _cleaner(s: SparkSession, d: str) -> DataFrame:
    return journal.cleaner_records(_pages(s, d), KEYWORDS).select("url", "source", "word_count", "level", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha"))


def _records(s: SparkSession, d: str) -> DataFrame:
    ok = _gated(s, d).where("reject_reason IS NULL")
    return gates.training_records(ok, compat=False).select("url", "source", "level", "word_count", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha"))


def _first_words(s: SparkSession, d: str) -> DataFrame:
    """Lines of a phrase file made of the benchmark: comments, site suffixes in two forms, repeats."""
    b = s.read.parquet(f"{d}/benchmark.parquet")
    words = F.array_join(F.slice(X.words(F.lower("text")), 1, 2), "  ")
    line = F.when(F.col("item_id") % 5 == 0, F.concat(F.lit("# "), words)).when(F.col("item_id") % 5 == 1, F.concat(words, F.lit(" (site:www.example.org) ")))
    return b.select(F.col("item_id").alias("pos"), line.when(F.col("item_id") % 5 == 2, F.concat(words, F.lit(" site:example.com more"))).otherwise(words).alias("line"))


def _sitemaps(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """An index of one sitemap a host, each with its pages' URLs."""
    p = _pages(s, d).select("page_id", "url", U.host(F.col("url")).alias("host"))
    loc = lambda c: F.concat(F.lit("<url><loc> "), F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit(" </loc></url>"))
    child = p.groupBy("host").agg(F.array_join(F.transform(F.array_sort(F.collect_list("url")), loc), "").alias("b"))
    child = child.select(F.concat(F.lit("map:"), "host").alias("sitemap_url"), F.concat(F.lit("<urlset xmlns='http://www.sitemaps.org/schemas/sitemap/0.9'>"), "b", F.lit("</urlset>")).cast("binary").alias("body"))
    refs = F.transform(F.array_sort(F.collect_set(F.concat(F.lit("map:"), "host"))), lambda x: F.concat(F.lit("<sitemap><loc>"), x, F.lit("</loc></sitemap>")))
    index = p.agg(F.array_join(refs, "").alias("b")).select(F.lit("map").alias("sitemap_url"), F.concat(F.lit("<sitemapindex>"), "b", F.lit("</sitemapindex>")).cast("binary").alias("body"))
    return child.unionByName(index), s.createDataFrame([(0, "map"), (1, "map:missing")], "pos int, url string")


def _sitemap_walk(s: SparkSession, d: str) -> DataFrame:
    maps, roots = _sitemaps(s, d)
    return sitemap.walk(maps, roots, ["/es/", "page="], Settings(max_sitemaps=10_000, max_pages=10_000_000))[0].select("url")


def _sitemap_parse(s: SparkSession, d: str) -> DataFrame:
    return sitemap.parsed(_sitemaps(s, d)[0]).select("sitemap_url", F.size("children").alias("n_children"), F.size("pages").alias("n_pages"))


def _results(s: SparkSession, d: str, engine: str) -> DataFrame:
    """Result pages of a search engine, one for each host, that link to its pages."""
    p = _pages(s, d).select("url", U.host(F.col("url")).alias("host"))
    redirect = {"duckduckgo": lambda u: F.concat(F.lit("//duckduckgo.com/l/?uddg="), F.url_encode(u), F.lit("&rut=1")), "bing": lambda u: F.concat(F.lit("https://www.bing.com/ck/a?u=a1"), F.rtrim(F.translate(F.base64(u.cast("binary")), "+/\n\r", "-_"), F.lit("=")), F.lit("&ntb=1"))}[engine]
    tag = F.concat(F.lit('<a href="'), redirect(F.col("url")), F.lit('">x</a>'))
    return p.groupBy("host").agg(F.array_join(F.array_sort(F.collect_list(tag)), "").alias("html")).select(F.lit(engine).alias("engine"), F.concat(F.lit("https://search/"), "host").alias("search_url"), "html")


def _search_results(s: SparkSession, d: str) -> DataFrame:
    found = links.search_links(_results(s, d, "duckduckgo").unionByName(_results(s, d, "bing")))
    return found.groupBy("page", "url").agg(F.count(F.lit(1)).alias("n"))


def _tag_pages(s: SparkSession, d: str) -> DataFrame:
    """A tag page for each host, whose links are articles of two sections, other pages and other sites, and the place of each article there."""
    p = _pages(s, d).select("page_id", U.host(F.col("url")).alias("host"))
    base = F.get(F.array(*map(F.lit, ["https://www.kompas.com/read/", "https://www.kompas.com/edu/read/", "https://www.kompas.com/tag/", "https://www.kompas.com/skola/read/", "https://example.org/read/"])), (F.col("page_id") % 5).cast("int"))
    tag = F.concat(F.lit('<a href="'), base, F.col("page_id").cast("string"), F.lit('">x</a>'))
    html = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("page_id", tag.alias("tag")))), lambda x: x["tag"]), "")
    pages = p.groupBy("host").agg(html.alias("html")).select(F.lit("kompas_tag").alias("engine"), F.concat(F.lit("https://www.kompas.com/tag/"), "host").alias("search_url"), "html")
    found = links.search_links(pages)
    return found.select("page", "url", F.row_number().over(W.partitionBy("page").orderBy("pos")).cast("int").alias("place"))


def _pagination(s: SparkSession, d: str) -> DataFrame:
    """Conversations as articles: each turn is a page that leads to the next turn's."""
    c = s.read.parquet(f"{d}/conversations.parquet")
    url = lambda turn: F.concat(F.lit("c/"), F.col("conv_id").cast("string"), F.lit("/"), turn.cast("string"))
    pages = c.select("turn", url(F.col("turn")).alias("url"), F.col("text").alias("content"), url(F.col("turn") + 1).alias("next_url"))
    out = links.paginated(pages.where("turn = 0").drop("turn"), pages.drop("turn"))
    return out.select("url", "n_pages", F.sha2(F.col("content").cast("binary"), 256).alias("content_sha"))


def _spider(s: SparkSession, d: str) -> DataFrame:
    rows = _pages(s, d).select(U.host(F.col("url")).alias("page"), F.col("page_id").cast("int").alias("pos"), F.concat("url", F.lit("#belajar")).alias("url"))
    return frontier.spider_links(rows, Settings(spider_links=4), allow=["example."], focused=True).select("page", "pos")


def _journal(s: SparkSession, d: str) -> DataFrame:
    """Every document as a journal page, with a PDF of the document that shares its number."""
    page = F.concat(F.lit("https://neliti.com/j/"), F.col("doc_id"))
    html = F.concat(F.lit("<h1>siswa dan guru "), F.col("doc_id"), F.lit('</h1><meta name="citation_author" content="A"><meta name="citation_author" content="B"><a href="/p/'), F.col("doc_id"), F.lit('.pdf">x</a><a href="/p/none.PDF">y</a>'))
    docs = _docs(s, d)
    pdfs = _docs(s, d).select(F.concat(F.lit("https://neliti.com/p/"), F.col("doc_id"), F.lit(".pdf")).alias("pdf_url"), "text")
    out = journal.journal_records(docs.select(page.alias("url"), html.alias("html")), pdfs)
    return out.select("url", "source_page", "title", F.array_join("authors", ";").alias("authors"), "word_count", "type", "level")


def _raw(s: SparkSession, d: str) -> DataFrame:
    rows = _page_text(s, d).select("url", "title", F.col("content").alias("main"), F.lit(0.9).alias("quality"))
    out = gates.raw_records(rows, F.expr(NOW), KEYWORDS)
    return out.select("url", "timestamp", F.col("metadata.word_count").alias("word_count"), F.array_join("metadata.keywords_found", ",").alias("keywords"), F.col("metadata.source_domain").alias("domain"))


def _stream(s: SparkSession, d: str) -> DataFrame:
    """All documents through a stream that drops contents seen before, up to what is there now."""
    folder = f"{shared_dir(s).rstrip('/')}/stream-{uuid.uuid4().hex}"
    schema = s.read.parquet(f"{d}/documents.parquet").schema
    rows = s.readStream.schema(schema).parquet(f"{d}/documents.parquet*").select("doc_id", F.col("text").alias("content"))
    out = crawl_stream.first_contents(rows).select("fingerprint")
    out.writeStream.format("parquet").option("checkpointLocation", f"{folder}/state").option("path", f"{folder}/out").trigger(availableNow=True).start().awaitTermination()
    return s.read.schema("fingerprint string").parquet(f"{folder}/out")


ARTICLE = {"kompas": "https://www.kompas.com/read", "detik": "https://www.detik.com/edu/d-", "liputan6": "https://www.liputan6.com/read", "ruangguru": "https://www.ruangguru.com/blog", "republika": "https://news.republika.co.id/berita", "quipper": "https://www.quipper.com/id/blog", "zenius": "https://www.zenius.net/blog"}


def _articles(s: SparkSession, d: str) -> DataFrame:
    """Article tests of seven sites on the pages' paths put under their hosts, or left out for odd pages."""
    tail = F.when(F.col("page_id") % 2 == 0, U.path(F.col("url"))).otherwise("")
    cols = [U.is_article_url(F.concat(F.lit(base), tail), site).alias(site) for site, base in ARTICLE.items()]
    return _pages(s, d).select("page_id", *cols, U.is_journal_url(F.col("url"), ["example.org"]).alias("journal"), U.sanitize_instance(F.col("url")).alias("instance"), U.source_of(F.col("url")).alias("source"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    page_row = ["page_id", "url"]
    return {
        "url_normalize": _url(normalized=U.normalize_url, url_hash=lambda u: U.url_hash(U.normalize_url(u)), host=U.host),
        "url_predicates": _url(valid=lambda u: U.is_valid_crawl_url(u, BLOCKED, [".html"], ["page=2"]), education=lambda u: U.is_education_url(u, ["blog."], ["example.net/"]), priority=lambda u: U.url_priority(u, [(1, "startswith(h, 'www.')"), (3, "endswith(h, '.org') AND contains(p, '/es/')"), (4, "endswith(h, '.org') OR endswith(h, '.net')")])),
        "url_dedupe_first": lambda s, d: keep_first(_pages(s, d).withColumn("normalized", U.normalize_url(F.col("url"))), ["normalized"], ["page_id"]).select("page_id", "normalized"),
        "site_longest_suffix": lambda s, d: sites.match_sites(_pages(s, d), _sites(s)).select("page_id", "site", "method"),
        "blocked_domain_anti": lambda s, d: sites.without_blocked(_pages(s, d), s.createDataFrame([(b,) for b in BLOCKED], "domain string")).select(*page_row),
        "whitelist_semi": lambda s, d: sites.whitelisted(_pages(s, d), s.createDataFrame([("example.org",)], "domain string")).select(*page_row),
        "page_links": lambda s, d: links.page_links(_pages(s, d)).groupBy("page").agg(F.count(F.lit(1)).alias("n_links")),
        "page_hrefs": lambda s, d: _pages(s, d).select("page_id", F.size(links.hrefs(F.col("html"))).alias("n_hrefs"), F.array_join(links.hrefs(F.col("html")), " ").alias("hrefs")),
        "page_title": lambda s, d: titles(_pages(s, d)).select("page_id", "title"),
        "page_extract": lambda s, d: crawl.extracted_pages(_pages(s, d).withColumnRenamed("page_id", "id")).select("id", "title", "extraction_source", X.word_count(F.col("content")).alias("words")),
        "crawl_pipeline": _crawl,
        "tag_tasks": lambda s, d: discovery.search_tasks(s, "www.kompas.com", _phrases(s, d)).select("idx", "search_url", "engine"),
        "tag_page_links": _tag_pages,
        "archive_pages": lambda s, d: _archived(s, d).groupBy("status", "error").agg(F.count(F.lit(1)).alias("n"), F.sum(F.char_length("html")).alias("chars")),
        "archive_crawl": _archive_crawl,
        "cleaner_process": _cleaner,
        "experiment_records": lambda s, d: journal.experiment_records(_pages(s, d), keywords=KEYWORDS, science=["the tion"], common=COMMON).select("url", "title", "word_count", "metadata.relevance_score"),
        "tag_urls": lambda s, d: discovery.tag_urls(_phrases(s, d)),
        "site_queries": lambda s, d: discovery.site_queries(_phrases(s, d), "https://Example.org/x"),
        "search_urls_sharded": _search,
        "word_count": _doc(words=X.word_count, tokens=X.token_count),
        "lang_ratio_gate": _doc(is_language=lambda t: X.is_language(t, COMMON, 0.1)),
        "keyword_hits": _doc(hits=lambda t: X.relevance_score(t, KEYWORDS), found=lambda t: F.array_join(X.keywords_found(t, KEYWORDS), ","), signals=lambda t: X.ad_signals(t, SIGNALS)),
        "classify_level": _doc(level=lambda t: X.classify_level(t, None, LEVELS)),
        "extraction_quality": lambda s, d: _docs(s, d).select("doc_id", F.round(X.extraction_quality(F.col("text"), F.substring("text", 1, 12)), 6).alias("quality")),
        "content_fingerprint": _doc(fingerprint=X.fingerprint),
        "dedupe_first_wins": lambda s, d: first_of_key(_docs(s, d).select("doc_id", X.fingerprint(F.col("text")).alias("fp")), ["fp"], ["doc_id"]).where("first").select("doc_id", "fp"),
        "domain_cap": lambda s, d: cap_per_key(_pages(s, d).withColumn("host", U.host(F.col("url"))), ["host"], ["page_id"], 5).select("page_id", "host"),
        "quality_gate": _doc(ok=lambda t: X.is_quality_content(t, 75)),
        "main_paragraphs": _cleaned(X.main_paragraphs, "main_sha"),
        "pdf_text_clean": _cleaned(X.clean_pdf_text, "clean_sha"),
        "cleaner_lines": _cleaned(lambda t: F.array_join(X.cleaner_lines(t), "\n"), "lines_sha"),
        "normalize_text": _cleaned(X.normalize_text, "text_sha"),
        "clean_markdown": _cleaned(X.clean_markdown, "markdown_sha"),
        "plain_text": _cleaned(X.plain_text, "plain_sha"),
        "cpt_clean": _cleaned(lambda t: X.clean_for_training(t, compat=False), "cpt_sha"),
        "cpt_clean_compat": _cleaned(X.clean_for_training, "cpt_sha"),
        "fuzzy_relevance": lambda s, d: _docs(s, d).select("doc_id", fuzzy_relevance(["the tionn", "und der"], 80, first=8_000)("text").alias("f")).select("doc_id", "f.score", F.size("f.hits").alias("n")),
        "gate_reasons": _gates,
        "reject_histogram": lambda s, d: gates.reason_counts(_gated(s, d, text=False)),
        "cpt_records": _records,
        "phrase_scan": lambda s, d: readers.phrases(_first_words(s, d)),
        "sitemap_walk": _sitemap_walk,
        "sitemap_parse": _sitemap_parse,
        "search_results": _search_results,
        "pagination_chain": _pagination,
        "spider_links": _spider,
        "journal_records": _journal,
        "raw_records": _raw,
        "article_urls": _articles,
        "education_related": _doc(related=lambda t: X.is_education_related(t, None, KEYWORDS, 4), valid=lambda t: X.cleaner_valid(t, KEYWORDS, 100, 2)),
        "run_counters": lambda s, d: sinks.run_counters(_gated(s, d)),
        "vocabulary_matches": _vocabulary,
        "token_counts": lambda s, d: _docs(s, d).select("doc_id", tokens.counter(ranks_path())(F.col("text")).alias("tokens")),
        "run_tokens": lambda s, d: sinks.run_counters(_gated(s, d), tokens.counter(ranks_path())),
        "claim_order_gates": lambda s, d: _in_order(s, d).select(F.col("id").alias("doc_id"), "reject_reason"),
        "host_successes": lambda s, d: accepted_per_host(_in_order(s, d)),
        "host_counts": lambda s, d: _pages(s, d).groupBy(U.host(F.col("url")).alias("host")).agg(F.count(F.lit(1)).alias("n")),
        "uptime_format": lambda s, d: _jobs(s, d).select("id", X.uptime(F.col("id") * 7).alias("uptime"), X.utc_iso(F.col("created_at")).alias("iso")),
        "stream_dedupe": _stream,
        "job_counts": lambda s, d: frontier.counts(_jobs(s, d), F.expr(NOW)),
        "claim_order": _claim,
        "retry_schedule": _retry,
        "job_complete": _complete,
        "job_recover": lambda s, d: frontier.recover(_jobs(s, d)).groupBy("status").agg(F.count(F.lit(1)).alias("n")),
        "enqueue_new": _enqueue,
        "priority_backfill": _backfill,
        "selector_upsert": _selectors,
        "selector_cache_join": _cached,
        "job_ignore": _ignore,
        "url_rules": _url_rules,
        "contents_not_seen": _not_seen,
        "site_rules": _site_rules,
    }
