import base64
from urllib.parse import parse_qsl, urlencode, urlsplit, urlunsplit

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import urls as U


def run(spark, f, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, u string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("u")).alias("x")).collect()]


def model(url):
    p = urlsplit(url.strip().split("#")[0])
    items = sorted((k, v) for k, v in parse_qsl(p.query) if not k.lower().startswith("utm_") and k.lower() not in {"fbclid", "gclid", "yclid", "igshid", "mc_cid", "mc_eid", "ref", "ref_src"})
    path = p.path.rstrip("/") if p.path != "/" else p.path
    return urlunsplit((p.scheme.lower(), p.netloc.lower(), path, urlencode(items), ""))


URLS = [
    "HTTPS://Www.Kompas.com/Edu//?b=2&a=1&utm_x=1&UTM_y=2&ref=q&c=#frag", "http://a.com/", "http://a.com", "http://a.com/x///", "https://a.com/p?q=a%20b+c&z=%C3%A9&q=*~",
    "  https://a.com/x?fbclid=1  ", "https://a.com/?a=1&a=0", "notaurl", "https://a.com/x?k=v=w",
]


def test_normalize_like_the_model(spark):
    once = run(spark, U.normalize_url, URLS)
    assert [U.normalized(u) for u in URLS] == once
    assert once == [model(u) for u in URLS]
    assert run(spark, U.normalize_url, once) == once
    assert run(spark, U.normalize_url, [None, "", "#x"]) == ["", "", ""]


@pytest.mark.parametrize(
    ("url", "priority"),
    [
        ("https://www.kompas.com/edu/read/1", 0), ("https://edukasi.kompas.com/x", 1), ("https://notkompas.com/x", 2), ("https://www.detik.com/edu/d-1", 3), ("https://www.ruangguru.com/blog/x", 4),
        ("https://www.liputan6.com/read/1", 5), ("https://news.detik.com/x", 6), ("https://republika.co.id/berita/x", 7), ("https://www.quipper.com/id/blog/x", 8), ("https://www.zenius.net/blog/x", 9), ("https://a.org", 10), ("", 10),
    ],
)
def test_priority(spark, url, priority):
    assert run(spark, U.url_priority, [url]) == [priority]


def test_validity(spark):
    bad = ["ftp://a.com", "https://", "https://m.facebook.com/x", "https://a.com/x.PDF", "https://a.com/?utm_source=1", "a.com", None]
    assert run(spark, U.is_valid_crawl_url, ["https://sekolah.sch.id/materi", *bad]) == [True] + [False] * len(bad)


def test_article_rules(spark):
    yes = {"kompas": "https://www.kompas.com/x/read/1", "detik": "https://www.detik.com/edu/s/d-1", "liputan6": "https://liputan6.com/read/1", "ruangguru": "https://ruangguru.com/blog/x", "republika": "https://news.republika.co.id/berita/1", "quipper": "https://quipper.com/id/blog/x", "zenius": "https://zenius.net/blog/x"}
    for site, url in yes.items():
        assert run(spark, lambda u, s=site: U.is_article_url(u, s), [url, "https://x.org/read/"]) == [True, False]
    assert run(spark, lambda u: U.is_article_url(u, "ruangguru"), ["https://ruangguru.com/blog/"]) == [False]


def test_bing_target(spark):
    code = "a1" + base64.urlsafe_b64encode(b"https://a.sch.id/x?y=1").decode().rstrip("=")
    urls = [f"https://www.bing.com/ck/a?!&&p=1&u={code}&ntb=1", "https://www.bing.com/x?url=https%3A%2F%2Fb.com%2F", "https://a.com/?u=" + code, "https://www.bing.com/x"]
    assert run(spark, U.bing_target, urls) == ["https://a.sch.id/x?y=1", "https://b.com/", None, None]


def test_small_functions(spark):
    assert run(spark, U.tag_slug, ["  Kurikulum Merdeka! ", "é", None]) == ["kurikulum-merdeka", "", ""]
    assert run(spark, U.normalize_domain, ["https://A.com/x", " ", None]) == ["a.com", None, None]
    assert run(spark, U.sanitize_instance, [" a b/c..", "x" * 99]) == ["a_b_c", "x" * 64]
    assert run(spark, lambda u: U.in_whitelist(u, ["kompas.com"]), ["https://edu.kompas.com/", "https://notkompas.com/"]) == [True, False]
    assert run(spark, U.is_journal_url, ["https://neliti.com/x", "https://xneliti.com"]) == [True, False]
    assert run(spark, U.source_of, ["https://a.com/x"]) == ["a.com"]
