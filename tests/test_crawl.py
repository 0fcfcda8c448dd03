import datetime as dt
import gzip

from pyspark.sql import functions as F

from corpusloom.functions import register
from corpusloom.operators import frontier, gates, journal, links, sinks, sites
from corpusloom.operators.dedupe import cap_per_key, first_of_key, keep_first, not_seen, ordered_distinct
from corpusloom.plans import crawl, discovery
from corpusloom.settings import Settings
from corpusloom.sources import readers, sitemap

def now():
    return F.expr("timestamp'2024-01-01 00:00:00'")


def prose(tag, n=150):
    return " ".join(f"{tag}{i % 7} guru dan" for i in range(n // 3)) + "."


def test_gate_order_and_side_effect(spark):
    long = prose("kata")
    rows = [
        (1, "https://a.com/1", "", ""), (2, "https://a.com/2", "", "pendek"), (3, "https://a.com/3", "", "Masuk\n" * 30), (4, "https://a.com/4", "", prose("x", 90)),
        (5, "https://a.com/5", "", long + " daftar sekarang, cashback, testimoni"), (6, "https://a.com/6", "", long + "  DAFTAR sekarang, cashback, testimoni"),
        (7, "https://a.com/7", "", "foo bar baz " * 60 + "."), (8, "https://a.com/english/8", "", "foo bar guru " * 60 + "."), (9, "https://a.com/9", "", prose("lain")), (10, "https://a.com/10", "", "dan zzz qqq " * 60 + "."),
    ]
    df = spark.createDataFrame(rows, "id int, url string, title string, content string")
    got = {r["id"]: r["reject_reason"] for r in gates.gated(df, ["id"], keywords=["guru"]).collect()}
    assert got == {1: "no_content", 2: "too_short_raw", 3: "too_short_clean", 4: "low_extraction_quality", 5: "advertisement", 6: "duplicate_content", 7: "non_indonesian", 8: None, 9: None, 10: "low_relevance"}
    seen = gates.gated(df.where("id = 9"), ["id"], keywords=["guru"]).select("fingerprint")
    again = {r["id"]: r["reject_reason"] for r in gates.gated(df, ["id"], seen=seen, keywords=["guru"]).collect()}
    assert again[9] == "duplicate_content" and again[8] is None
    counts = {r["outcome"]: r["n"] for r in gates.reason_counts(gates.gated(df, ["id"], keywords=["guru"])).collect()}
    assert counts["accepted"] == 2 and sum(counts.values()) == 10


def test_records(spark):
    text = "\n\n".join(f"di kelas {i} ini guru dan murid belajar bersama tentang materi nomor {i} dengan tekun sekali." for i in range(12))
    df = spark.createDataFrame([("https://a.sch.id/x", "Judul yang panjang", text, 0.82)], "url string, title string, main string, quality double")
    [r] = gates.training_records(df).collect()
    assert r["text"].startswith("Judul yang panjang\n\ndi kelas 0") and r["source"] == "a.sch.id" and r["word_count"] == len(r["text"].split()) and r["level"] == "SD"
    [raw] = gates.raw_records(df, now(), ["guru", "zzz"]).collect()
    assert raw["metadata"]["keywords_found"] == ["guru"] and raw["timestamp"] == "2024-01-01T00:00:00.000000+00:00" and raw["metadata"]["fuzzy_science_hits"] == []


def test_first_cap_and_distinct(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (5, "b")], "id int, k string")
    assert {r["id"] for r in first_of_key(df, ["k"], ["id"]).where("first").collect()} == {1, 3, 5}
    assert {r["id"] for r in keep_first(df, ["k"], ["id"]).collect()} == {1, 3, 5}
    assert {r["id"] for r in cap_per_key(df.where("k is not null"), ["k"], ["id"], 1).collect()} == {1, 5}
    assert {(r["k"], r["id"]) for r in ordered_distinct(df, ["k"], "id").collect()} == {("a", 1), (None, 3), ("b", 5)}
    assert {r["id"] for r in not_seen(df, df.where("id = 5"), ["k"]).collect()} == {1, 2, 3, 4}


def test_site_joins(spark):
    urls = spark.createDataFrame([(1, "https://edukasi.kompas.com/x"), (2, "https://notkompas.com/"), (3, "https://kompas.com/"), (4, "bad")], "id int, url string")
    table = spark.createDataFrame([("kompas.com", "css"), ("edukasi.kompas.com", "x")], "site string, method string")
    assert {r["id"]: r["site"] for r in sites.match_sites(urls, table).collect()} == {1: "edukasi.kompas.com", 2: None, 3: "kompas.com", 4: None}
    one = spark.createDataFrame([("kompas.com",)], "domain string")
    assert {r["id"] for r in sites.without_blocked(urls, one).collect()} == {2, 4}
    assert {r["id"] for r in sites.whitelisted(urls, one).collect()} == {1, 3}
    cache = spark.createDataFrame([("kompas.com", ".x")], "domain string, selector string")
    assert {r["id"]: r["selector"] for r in sites.with_selector(urls, cache).collect()}[3] == ".x"


def jobs(spark):
    t = dt.datetime(2023, 12, 31)
    rows = [(1, "pending", 2, 0, None), (2, "pending", 1, 1, None), (3, "pending", 0, 2, dt.datetime(2024, 1, 2)), (4, "processing", 5, 2, None), (5, "processing", 5, 0, None), (6, "failed", 0, 3, None)]
    base = spark.createDataFrame([(i, s, p, a, n, t) for i, s, p, a, n in rows], "id long, status string, priority int, attempts int, next_retry_at timestamp, created_at timestamp")
    fields = {f.split()[0]: f.split()[1] for f in frontier.SCHEMA.replace(" string>", "string>").split(", ")}
    return base.select(*[F.col(c) if c in base.columns else (F.concat(F.lit("https://a"), "id", F.lit(".com/x")) if c == "url" else F.concat(F.lit("a"), "id", F.lit(".com")) if c == "domain" else F.sha2(F.concat(F.lit("https://a"), F.col("id").cast("string"), F.lit(".com/x")), 256) if c == "url_hash" else F.lit(None)).cast(k).alias(c) for c, k in fields.items()])


def test_frontier(spark):
    df = jobs(spark)
    assert [r["id"] for r in frontier.claim(df, now(), 5).collect()] == [2, 1]
    assert [r["id"] for r in frontier.claim(df, now(), 5, ["a1.com"]).collect()] == [1]
    taken = frontier.mark_processing(df, frontier.claim(df, now(), 1), now())
    assert {r["id"] for r in taken.where("status = 'processing'").collect()} == {2, 4, 5}
    assert frontier.recover(taken).where("status = 'processing'").count() == 0
    bad = spark.createDataFrame([(4, "e" * 600), (5, "x")], "id long, error string")
    out = {r["id"]: r for r in frontier.fail(df, bad, now(), F.lit(1.0)).collect()}
    assert (out[4]["status"], out[4]["attempts"], len(out[4]["last_error"]), out[4]["next_retry_at"]) == ("failed", 3, 500, None)
    assert out[5]["status"] == "pending" and out[5]["next_retry_at"] == dt.datetime(2024, 1, 1, 0, 0, 12, 500000)
    done = spark.createDataFrame([(4, "T", "C", {"a": "1"})], "id long, title string, content_markdown string, metadata map<string,string>")
    first = frontier.complete(df, done, now())
    again = spark.createDataFrame([(4, "T", "C", {"a": "2", "b": "3"})], "id long, title string, content_markdown string, metadata map<string,string>")
    assert frontier.complete(first, again, now()).where("id = 4").first()["metadata"] == {"a": "2", "b": "3"}
    skip = spark.createDataFrame([(1, "r" * 600)], "id long, reason string")
    assert len(frontier.ignore(df, skip, now()).where("id = 1").first()["last_error"]) == 500
    assert {r["status"]: r["n"] for r in frontier.counts(df, now()).collect()} == {"pending": 3, "processing": 2, "failed": 1, "total": 6, "pending_ready": 2}


def test_enqueue_is_insert_if_absent(spark):
    df = jobs(spark)
    urls = spark.createDataFrame([("https://a1.com/x/",), ("https://New.com/y?utm_source=z",), ("https://new.com/y",), ("ftp://no",), (None,)], "url string")
    new = frontier.enqueue(df, urls, now())
    assert [(r["url"], r["status"], r["attempts"], r["priority"]) for r in new.collect()] == [("https://new.com/y", "pending", 0, 10)]
    assert frontier.enqueue(df.unionByName(new), urls, now()).count() == 0
    assert frontier.enqueue(df, urls, now(), ["other.com"]).count() == 0


def test_spider_links(spark):
    rows = [("p", i, f"https://a.sch.id/read/{i}" if i % 2 else f"https://a.xyz/{i}") for i in range(10)]
    df = spark.createDataFrame(rows, "page string, pos int, url string")
    assert [r["pos"] for r in frontier.spider_links(df, Settings(spider_links=3)).orderBy("pos").collect()] == [1, 3, 5]
    assert frontier.spider_links(df, allow=["/9"], focused=True).count() == 1


def test_links(spark):
    html = '<a href="/a">x</a><a href="#t"><a HREF="https://b.com/p.pdf"><a href="https://c.com/x/../y"><a href="/a"><a href=\'/no\'><a href="mailto:x@y">'
    df = spark.createDataFrame([("https://s.com/d/e", html)], "url string, html string")
    assert [(r["pos"], r["url"]) for r in links.page_links(df).orderBy("pos").collect()] == [(0, "https://s.com/a"), (3, "https://c.com/x/../y")]
    ddg = '<a href="//duckduckgo.com/l/?uddg=https%3A%2F%2Fa.com%2Fx&rut=1"><a href="https://duckduckgo.com/y"><a href="https://b.com/z">'
    bing = '<a href="https://www.bing.com/ck/a?u=a1aHR0cHM6Ly9hLmNvbS9i&p=1"><a  href="https://c.com/q"><a class=x href="https://d.com">'
    tag = '<a href="https://www.kompas.com/tren/read/2"><a href="https://www.kompas.com/edu/read/3"><a href="https://www.kompas.com/tag/x">'
    res = spark.createDataFrame([("duckduckgo", "s1", ddg), ("bing", "s2", bing), ("kompas_tag", "https://www.kompas.com/tag/q", tag), ("other", "s4", ddg)], "engine string, search_url string, html string")
    got = [(r["page"], r["url"]) for r in links.search_links(res).orderBy("page", "pos").collect()]
    assert got == [("https://www.kompas.com/tag/q", "https://www.kompas.com/edu/read/3"), ("https://www.kompas.com/tag/q", "https://www.kompas.com/tren/read/2"), ("s1", "https://a.com/x"), ("s1", "https://b.com/z"), ("s2", "https://a.com/b"), ("s2", "https://c.com/q")]


def test_pagination_ends_at_cycles_and_limits(spark):
    pages = spark.createDataFrame([("u1", "a", "u2"), ("u2", "b", "u3"), ("u3", "c", "u1"), ("u4", "d", "u9")], "url string, content string, next_url string")
    out = {r["url"]: (r["content"], r["n_pages"]) for r in links.paginated(pages, pages).collect()}
    assert out["u1"] == ("a\n\nb\n\nc", 3) and out["u4"] == ("d", 1)
    short = {r["url"]: r["n_pages"] for r in links.paginated(pages, pages, Settings(max_pagination=2)).collect()}
    assert short["u1"] == 2


def test_sitemaps(spark):
    index = b"<sitemapindex xmlns='http://s'><sitemap><loc> m1 </loc></sitemap><sitemap><loc>m2</loc></sitemap><sitemap><loc>root</loc></sitemap></sitemapindex>"
    urls = lambda *u: b"<urlset xmlns='http://s'>" + b"".join(f"<url><loc>{x}</loc></url>".encode() for x in u) + b"</urlset>"
    df = spark.createDataFrame([("root", bytearray(index)), ("m1", bytearray(gzip.compress(urls("https://a/read/1", "https://a/x/2")))), ("m2", bytearray(urls("https://a/read/3", "https://a/read/1"))), ("bad", bytearray(b"<x"))], "sitemap_url string, body binary")
    roots = spark.createDataFrame([(0, "root"), (1, "bad"), (2, "gone"), (3, " ")], "pos int, url string")
    pages, seen = sitemap.walk(df, roots, ["/read/"])
    assert [r["url"] for r in pages.orderBy("pos").collect()] == ["https://a/read/1", "https://a/read/3"] and seen == 5
    assert sitemap.walk(df, roots, s=Settings(max_sitemaps=1))[1] == 1
    assert [r["url"] for r in sitemap.walk(df, roots, s=Settings(max_pages=1))[0].collect()] == ["https://a/read/1"]
    assert sitemap.parse_sitemap(None) == ([], []) and sitemap.gunzip(b"\x1f\x8bxx") == b"\x1f\x8bxx"


def test_discovery(spark):
    kw = spark.createDataFrame([(0, "satu"), (1, "dua kata"), (2, "tiga kata ini"), (3, "dua kata")], "pos int, phrase string")
    q = [r["query"] for r in discovery.site_queries(kw, "https://Detik.com/x").collect()]
    assert len(q) == 16 and q[0] == "materi sma dua kata site:detik.com" and q[7] == "dua kata site:detik.com"
    tasks = discovery.search_tasks(spark, "detik.com", keywords=kw)
    assert tasks.count() == 32 and discovery.search_tasks(spark, "detik.com", keywords=kw, shard=1, shards=3).count() == 11
    assert discovery.search_tasks(spark).count() == 124 * 3 * 2
    tags = discovery.search_tasks(spark, "kompas.com", phrases=kw)
    assert [r["search_url"] for r in tags.orderBy("idx").collect()] == ["https://www.kompas.com/tag/satu", "https://www.kompas.com/tag/dua-kata", "https://www.kompas.com/tag/tiga-kata-ini"]
    got, at = discovery.batch(tags, 0, 2)
    assert got.count() == 2 and at == 2
    assert discovery.batch(tags, 4, 2)[1] == 0


def test_sources(spark, tmp_path):
    f = tmp_path / "k.txt"
    f.write_text("# c\nKurikulum  Merdeka(site:www.kompas.com)\n\nfoo site:bar.com rest\nKurikulum Merdeka\n")
    assert [(r["phrase"], r["site"]) for r in readers.phrase_file(spark, str(f)).orderBy("pos").collect()] == [("Kurikulum Merdeka", "www.kompas.com"), ("foo", "bar.com")]
    u = tmp_path / "u.txt"
    u.write_text("https://a.com/x\n# no\nnope\n\n")
    lines = readers._numbered(spark, str(u))
    assert readers.url_list(lines).count() == 2 and [r["source"] for r in readers.seeds(lines).collect()] == ["seed:urls.txt"]
    m = tmp_path / "s.yaml"
    m.write_text("' A.com ':\n  method: CSS\n  selectors: {Title: h1, body: ''}\n  strip: [nav, ' ', null]\n  allow: /x\nbad: 1\n")
    [r] = readers.manifest(spark, str(m)).collect()
    assert (r["site"], r["method"], r["selectors"], r["strip"], r["allow"]) == ("a.com", "css", {"title": "h1"}, ["nav"], [])
    assert readers.manifest(spark, str(tmp_path / "none.yaml")).count() == 0 and readers.manifest_rows("{") == []
    assert readers.focused_seeds(spark, "www.detik.com").count() == 5 and readers.focused_seeds(spark, None).count() == 0
    assert readers.line_count(spark, str(f)) == 5
    assert Settings.of({"DOMAIN_CAP": "7", "x": "y"}).domain_cap == 7


def test_journal_and_cleaner(spark):
    html = '<title>Kurikulum sekolah</title><meta name="description" content="pendidikan siswa"><a href="/b.pdf">1</a><a href="a.pdf">2</a>'
    pages = spark.createDataFrame([("https://neliti.com/j", html), ("https://other.com/j", html)], "url string, html string")
    pdfs = spark.createDataFrame([("https://neliti.com/a.pdf", "isi jurnal " * 60), ("https://neliti.com/b.pdf", "pendek")], "pdf_url string, text string")
    [r] = journal.journal_records(pages, pdfs).collect()
    assert r["url"] == "https://neliti.com/a.pdf" and r["level"] == "umum" and r["word_count"] == 120
    body = "<article><p>Foto 1. x</p><p>" + "siswa belajar di sekolah " * 10 + "</p></article>"
    got = journal.cleaner_records(spark.createDataFrame([("https://a.com/x", body), ("https://b.com/y", "<p>pendek</p>")], "url string, html string")).collect()
    assert [(r["source"], r["word_count"], r["level"]) for r in got] == [("a.com", 40, "Umum")]


def test_experiment(spark):
    body = "<p>" + "guru dan murid belajar fotosintesis di sekolah, " * 20 + "</p>"
    rows = journal.experiment_records(spark.createDataFrame([("u", body)], "url string, html string"), science=["fotosintesys"], keywords=["zzz"]).collect()
    assert rows[0]["metadata"]["fuzzy_science_score"] == 91 and rows[0]["metadata"]["relevance_score"] == 0


def test_crawl_plan(spark):
    html = lambda t: f"<article><p>{t}</p></article>"
    rows = [(i, f"https://a.com/{i}", html(prose(f"k{i}"))) for i in range(4)] + [(9, "https://b.com/9", html(prose("k0"))), (10, "https://b.com/10", None)]
    df = spark.createDataFrame(rows, "id int, url string, html string")
    out = {r["id"]: r["reject_reason"] for r in crawl.curated(df, s=Settings(domain_cap=2), keywords=["guru"]).collect()}
    assert out == {0: None, 1: None, 2: "domain_cap:a.com", 3: "domain_cap:a.com", 9: "duplicate_content", 10: "no_content"}


def test_crawl_plan_with_errors_rendering_pages_and_cache(spark):
    page = lambda t: f"<div class='x'><div id='own'>{t}</div></div>"
    part = lambda t, n: f"<div class='b'>{t}</div><a class='n' href='{n}'>next</a>"
    rows = [
        (1, "https://a.com/1", f"<article><p>{prose('satu')}</p></article>", 200, None, None),
        (2, "https://a.com/2", f"<article><p>{prose('dua')}</p></article>", 503, None, None),
        (3, "https://a.com/3", None, None, "timeout", None),
        (4, "https://a.com/4", "<article><p>" + "guru dan murid belajar di sekolah yang baik. " * 9 + "</p></article>", 200, None, f"<article><p>{prose('empat')}</p></article>"),
        (5, "https://c.com/5", page(prose("lima")), 200, None, None),
        (6, "https://p.com/6", part(prose("enam"), "/7"), 200, None, None),
        (7, "https://p.com/7", part(prose("tujuh"), "8"), 200, None, None),
        (8, "https://p.com/8", part(prose("delapan"), "/6"), 200, None, None),
    ]
    df = spark.createDataFrame(rows, "id int, url string, html string, status int, error string, rendered_html string")
    sites = spark.createDataFrame([("p.com", "css", {"body": "div.b", "next_page": "a.n"}, [])], "site string, method string, selectors map<string,string>, strip array<string>")
    cache = spark.createDataFrame([("c.com", "#own")], "domain string, selector string")
    out = crawl.curated(df, sites, selectors=cache, keywords=["guru"])
    by = {r["id"]: r for r in out.collect()}
    assert {i: r["reject_reason"] for i, r in by.items()} == {1: None, 2: "HTTP 503", 3: "fetch:timeout", 4: None, 5: None, 6: None, 7: None, 8: None}
    assert by[4]["extraction_source"] == "rendered:css:article" and "empat" in by[4]["main"] and by[4]["quality"] >= 0.7
    assert by[5]["selector_used"] == "#own"
    assert by[6]["extraction_source"] == "manual_css:div.b+pagination:3" and all(w in by[6]["main"] for w in ("enam", "tujuh", "delapan"))
    kept = {(r["domain"], r["selector"]) for r in crawl.selectors_seen(out, F.lit(5)).collect()}
    assert kept == {("a.com", "article"), ("c.com", "#own")}
    jobs = spark.createDataFrame([(i, "processing", 0, {}) for i in range(1, 10)], "id long, status string, attempts int, metadata map<string,string>")
    for c, k in (("title", "string"), ("content_markdown", "string"), ("last_error", "string"), ("updated_at", "timestamp"), ("next_retry_at", "timestamp")):
        jobs = jobs.withColumn(c, F.lit(None).cast(k))
    after = {r["id"]: r for r in crawl.settled(jobs, out, F.expr("timestamp'2024-01-01 00:00:00'")).collect()}
    assert {i: r["status"] for i, r in after.items()} == {1: "completed", 2: "pending", 3: "pending", 4: "completed", 5: "completed", 6: "completed", 7: "completed", 8: "completed", 9: "processing"}
    assert after[2]["last_error"] == "HTTP 503" and after[2]["attempts"] == 1 and "satu" in after[1]["content_markdown"]
    assert "main" not in crawl.curated(df, sites, text=False, keywords=["guru"]).columns


def test_backfill_goes_by_the_domain(spark):
    rows = [("https://www.kompas.com/EDU/a", "www.kompas.com", 2), ("https://other.com/?u=kompas.com", "other.com", None), ("https://x/", "www.kompas.com.evil.org", 10), ("https://x/", "tekno.KOMPAS.com", 10), ("https://edukasi.kompas.com/q", "edukasi.kompas.com", None), ("https://edukasi.kompas.com/q", "edukasi.kompas.com", 7)]
    got = frontier.backfill_priority(spark.createDataFrame(rows, "url string, domain string, priority int")).collect()
    assert [r["priority"] for r in got] == [0, 10, 10, 2, 1, 7]


def test_no_text_is_shuffled_without_text(spark):
    df = spark.createDataFrame([(i, f"https://a.com/{i}", "t", prose(f"k{i}")) for i in range(4)], "id int, url string, title string, content string")
    out = gates.gated(df, ["id"], text=False, keywords=["guru"])
    assert not {"main", "content", "cleaned"} & set(out.columns)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "main#" not in plan and "content#" not in plan


def test_small_inputs_alone_are_spread(spark, monkeypatch, data):
    from corpusloom import storage

    df = spark.read.parquet(f"{data}/documents.parquet")
    assert storage.spread(df).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(storage, "SMALL", 10)
    assert storage.spread(df).rdd.getNumPartitions() == df.rdd.getNumPartitions()


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "é")], "a int, b string")
    sinks.append_jsonl(df, str(tmp_path / "o"))
    sinks.append_jsonl(df, str(tmp_path / "o"))
    assert spark.read.text(str(tmp_path / "o")).count() == 4
    sinks.overwrite_jsonl(df, str(tmp_path / "p"))
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "p")).collect()) == ['{"a":1,"b":null}', '{"a":2,"b":"é"}']
    sinks.write_tiers(df, df, str(tmp_path / "t"), "i1")
    assert (tmp_path / "t" / "dataset_raw_processed_1_i1.jsonl").exists()
    n = sinks.run_counters(spark.createDataFrame([(None, "a b"), ("x", "c")], "reject_reason string, main string")).first()
    assert (n["pages"], n["accepted"], n["rejected"], n["tokens"]) == (2, 1, 1, 2)


def test_rows_count_themselves_and_notices_may_fail(spark, tmp_path):
    df, seen = sinks.observed(spark.createDataFrame([(None,), ("HTTP 500",), ("no_content",), (None,)], "reject_reason string"))
    df.write.parquet(str(tmp_path / "w"))
    said = []
    sinks.notify(seen, said.append)
    assert said == ["pages=4 | accepted=2 | failed=1 | skipped=1"]
    sinks.notify(seen, lambda line: 1 / 0)


def test_binary_pages(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.pdf").write_bytes(b"%PDF isi")
    (tmp_path / "y.pdf").write_bytes(b"\xff")
    (tmp_path / "z.txt").write_bytes(b"no")
    out = readers.decoded(readers.binary_pages(spark, str(tmp_path)), lambda data: data.decode("ascii"))
    assert {r["pdf_url"].rsplit("/", 1)[1]: r["text"] for r in out.collect()} == {"x.pdf": "%PDF isi", "y.pdf": None}


def test_sql_names(spark):
    register.register(spark)
    r = spark.sql("SELECT normalize_url('HTTP://A.com/x/?utm_a=1') AS u, word_count('a  b') AS n, url_priority('https://edukasi.kompas.com/') AS p, partial_ratio('abc', 'xxabcxx') AS f").first()
    assert tuple(r) == ("http://a.com/x", 2, 1, 100.0)
    rows = spark.sql("""SELECT * FROM page_links('https://a.com/b/', '<a href="c"><a href="#x"><a href="/d">')""").collect()
    assert [(r["pos"], r["url"]) for r in rows] == [(0, "https://a.com/b/c"), (2, "https://a.com/d")]


def test_clear_removes_what_queries_left(spark):
    from pathlib import Path
    from urllib.parse import urlparse
    from uuid import uuid4

    from corpusloom import storage

    base = Path(urlparse(storage.shared_dir(spark)).path)
    own = f"own-{uuid4().hex}"  # the folder may be one that other runs have used
    for name in ("pipeline-t1", "media-t2", "stream-t3", own):
        (base / name / "a").mkdir(parents=True, exist_ok=True)
    gone = storage.clear(spark)
    assert {"pipeline-t1", "media-t2", "stream-t3"} <= set(gone) and (base / own).exists() and not (base / "media-t2").exists()
