"""URL functions as Catalyst expressions. Null URLs count as empty ones."""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import parse_qsl, urlencode, urlsplit, urlunsplit

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions import vocabulary as V
from corpusloom.functions.text import let, strip

#: scheme, authority, path, query of RFC 3986; a fragment is cut before.
PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"


def _given(url: Column) -> Column:
    return F.coalesce(url, F.lit(""))


def _part(url: Column, n: int) -> Column:
    return F.regexp_extract(url, PARTS, n)


def host(url: Column) -> Column:
    """The authority in lower case, port included; empty if there is none."""
    return F.lower(_part(_given(url), 2))


def path(url: Column) -> Column:
    return _part(_given(url), 3)


def normalize_url(url: Column, tracking: Sequence[str] = V.TRACKING_PARAMS) -> Column:
    """Stable form: no fragment, no tracking or blank parameters, sorted query, no trailing slashes.

    Scheme and authority go to lower case; a path of one slash stays.
    """
    u = F.split_part(strip(_given(url)), F.lit("#"), F.lit(1))
    scheme, netloc, p = F.lower(_part(u, 1)), F.lower(_part(u, 2)), _part(u, 3)
    decode = lambda x: F.coalesce(F.try_url_decode(x), x)
    encode = lambda x: F.replace(F.replace(F.url_encode(x), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))
    pairs = F.filter(F.split(_part(u, 4), "&"), lambda x: x.rlike(r"(?s)^[^=]*=."))
    pairs = F.transform(pairs, lambda x: F.struct(decode(F.substring_index(x, "=", 1)).alias("k"), decode(F.regexp_replace(x, "^[^=]*=", "")).alias("v")))
    kept = F.filter(pairs, lambda x: ~(F.startswith(F.lower(x["k"]), F.lit("utm_")) | F.lower(x["k"]).isin(*tracking)) & (x["v"] != ""))
    query = F.array_join(F.transform(F.array_sort(kept), lambda x: F.concat(encode(x["k"]), F.lit("="), encode(x["v"]))), "&")
    p = F.when(p == "/", p).otherwise(F.regexp_replace(p, "/+$", ""))
    absolute = F.when((netloc != "") & (p != "") & ~F.startswith(p, F.lit("/")), F.concat(F.lit("/"), p)).otherwise(p)
    whole = F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""),
        F.when(netloc != "", F.concat(F.lit("//"), netloc)).otherwise(""),
        absolute,
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""),
    )
    return F.when(u == "", F.lit("")).otherwise(whole)


def normalized(url: str | None, tracking: Sequence[str] = V.TRACKING_PARAMS) -> str:
    """The same for one URL in Python, with the standard library's percent encoding: the body of a SQL function."""
    text = (url or "").strip().split("#")[0]
    try:
        p = urlsplit(text)
    except ValueError:
        return ""
    kept = sorted((k, v) for k, v in parse_qsl(p.query) if not k.lower().startswith("utm_") and k.lower() not in tracking)
    trimmed = p.path if p.path == "/" else p.path.rstrip("/")
    return urlunsplit((p.scheme.lower(), p.netloc.lower(), trimmed, urlencode(kept), ""))


def url_hash(url: Column) -> Column:
    return F.sha2(_given(url).cast("binary"), 256)


#: (priority, condition on host h and path p), the first that holds; hosts end with a name, without a dot before it.
PRIORITY_RULES = [
    (0, "h = 'www.kompas.com' AND (startswith(p, '/edu/') OR startswith(p, '/skola/'))"),
    (1, "h = 'edukasi.kompas.com'"),
    (2, "endswith(h, 'kompas.com')"),
    (3, "endswith(h, 'detik.com') AND contains(p, '/edu/')"),
    (4, "endswith(h, 'ruangguru.com') AND contains(p, '/blog/')"),
    (5, "endswith(h, 'liputan6.com') AND contains(p, '/read/')"),
    (6, "endswith(h, 'detik.com') OR endswith(h, 'ruangguru.com') OR endswith(h, 'liputan6.com')"),
    (7, "endswith(h, 'republika.co.id') AND contains(p, '/berita/')"),
    (8, "endswith(h, 'quipper.com') AND contains(p, '/blog/')"),
    (9, "endswith(h, 'republika.co.id') OR endswith(h, 'quipper.com') OR endswith(h, 'zenius.net')"),
]
LAST_PRIORITY = 10


def url_priority(url: Column, rules: Sequence[tuple[int, str]] = PRIORITY_RULES) -> Column:
    """Crawl priority, low first; rules are SQL conditions on ``h`` (host) and ``p`` (lower-case path)."""
    x = {"h": host(strip(_given(url))), "p": F.lower(path(strip(_given(url))))}
    out = F.when(F.lit(False), LAST_PRIORITY)
    for n, rule in rules:
        out = out.when(_condition(rule, x), n)
    return out.otherwise(LAST_PRIORITY).cast("int")


def _condition(rule: str, x: dict[str, Column]) -> Column:
    """A disjunction of conjunctions of ``h = '…'`` and ``function(h|p, '…')`` as a column."""
    text, stash = rule, []
    while m := re.search(r"\(([^()]*(?:\([^()]*\)[^()]*)*)\)(?<!\w)", text):
        if re.search(r"\w$", text[: m.start()]):
            break
        stash.append(_condition(m[1], x))
        text = f"{text[: m.start()]}#{len(stash) - 1}{text[m.end() :]}"
    ors = None
    for part in text.split(" OR "):
        ands = None
        for atom in part.split(" AND "):
            atom = atom.strip()
            if atom.startswith("#"):
                c = stash[int(atom[1:])]
            elif m := re.fullmatch(r"(\w) = '([^']*)'", atom):
                c = x[m[1]] == m[2]
            else:
                m = re.fullmatch(r"(startswith|endswith|contains)\((\w), '([^']*)'\)", atom)
                c = getattr(F, m[1])(x[m[2]], F.lit(m[3]))
            ands = c if ands is None else ands & c
        ors = ands if ors is None else ors | ands
    return ors


def under_any(name: Column, domains: Sequence[str]) -> Column:
    """``name`` is one of the domains or below one of them."""
    suffixes = "|".join(re.escape(d) for d in domains)
    return name.rlike(rf"^(?:.*\.)?(?:{suffixes})$") if domains else F.lit(False)


def contains_any(text: Column, parts: Sequence[str]) -> Column:
    return text.rlike("|".join(re.escape(p) for p in parts)) if parts else F.lit(False)


def is_valid_crawl_url(url: Column, blocked: Sequence[str] = V.BLOCKED_DOMAINS, extensions: Sequence[str] = V.SKIP_EXTENSIONS, parts: Sequence[str] = V.BLOCKED_URL_PARTS) -> Column:
    """http(s), with an authority, no blocked domain, file type or substring."""
    u = _given(url)
    ends = "|".join(re.escape(e) for e in extensions)
    ok = F.lower(_part(u, 1)).isin("http", "https") & (host(u) != "") & ~under_any(host(u), blocked)
    return ok & ~F.lower(path(u)).rlike(rf"(?:{ends})$") & ~contains_any(F.lower(u), [p.lower() for p in parts])


def is_education_url(url: Column, accepted: Sequence[str] = V.ACCEPTED_HOST_PARTS, indicators: Sequence[str] = V.EDU_URL_PARTS) -> Column:
    """Any of either list occurs anywhere in the lower-case URL."""
    return contains_any(F.lower(_given(url)), [*accepted, *indicators])


#: Article tests: (end of the host, pattern on the lower-case path).
ARTICLE_RULES = {
    "kompas": ("kompas.com", "/read/"),
    "detik": ("detik.com", "(?=.*/edu/).*/d-"),
    "liputan6": ("liputan6.com", "/read/"),
    "ruangguru": ("ruangguru.com", "^/blog/."),
    "republika": ("republika.co.id", "/berita/"),
    "quipper": ("quipper.com", "^(?=.{7,}).*/blog/"),
    "zenius": ("zenius.net", "^(?=.{7,}).*/blog/"),
}


def is_article_url(url: Column, site: str) -> Column:
    ends, pattern = ARTICLE_RULES[site]
    return F.endswith(host(url), F.lit(ends)) & F.lower(path(url)).rlike(pattern)


def tag_slug(phrase: Column, size: int = 80) -> Column:
    """Letters and digits joined by hyphens, ``size`` characters at most."""
    s = F.regexp_replace(F.lower(strip(_given(phrase))), "[^a-z0-9]+", "-")
    return F.substring(F.btrim(s, F.lit("-")), 1, size)


def normalize_domain(domain: Column) -> Column:
    d = F.replace(F.replace(F.lower(strip(_given(domain))), F.lit("https://"), F.lit("")), F.lit("http://"), F.lit(""))
    return F.nullif(F.split_part(d, F.lit("/"), F.lit(1)), F.lit(""))


def _form(x: Column) -> Column:
    return F.replace(F.replace(F.url_encode(x), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def duckduckgo_url(query: Column, page: Column) -> Column:
    more = F.concat(F.lit("&s="), (page * 30).cast("string"), F.lit("&dc="), (page * 30 + 1).cast("string"))
    return F.concat(F.lit("https://html.duckduckgo.com/html/?q="), _form(query), F.when(page > 0, more).otherwise(""))


def bing_url(query: Column, page: Column) -> Column:
    more = F.concat(F.lit("&first="), (page * 10 + 1).cast("string"))
    return F.concat(F.lit("https://www.bing.com/search?q="), _form(query), F.when(page > 0, more).otherwise(""))


def bing_target(href: Column) -> Column:
    """The URL behind a redirect of that engine, null if ``href`` is none."""
    value = lambda key: F.regexp_extract(_part(_given(href), 4), rf"(?:^|&){key}=([^&]+)", 1)
    decoded = lambda x: F.coalesce(F.try_url_decode(x), x)
    raw = let(F.coalesce(F.nullif(value("u"), F.lit("")), value("url")), lambda x: let(strip(decoded(x)), decoded))

    def target(x: Column) -> Column:
        b64 = F.translate(F.substring(x, 3, 100_000), "-_", "+/")
        padded = let(b64, lambda y: F.rpad(y, (F.char_length(y) + F.pmod(-F.char_length(y), F.lit(4))).cast("int"), "="))
        found = F.nullif(F.regexp_extract(F.try_to_binary(padded, F.lit("base64")).cast("string"), r"""https?://[^\s"'<>]+""", 0), F.lit(""))
        return F.when(x.rlike("^https?://"), x).when(F.startswith(x, F.lit("a1")) & (F.char_length(x) > 4), found)

    return F.when(F.contains(host(href), F.lit("bing.com")), let(raw, target))


def sanitize_instance(name: Column) -> Column:
    s = F.regexp_replace(strip(_given(name)), "[^A-Za-z0-9_.-]+", "_")
    return F.substring(F.btrim(s, F.lit("._-")), 1, 64)


def in_whitelist(url: Column, whitelist: Sequence[str]) -> Column:
    """Everything, if the whitelist is empty."""
    return under_any(host(url), whitelist) if whitelist else F.lit(True)


def is_journal_url(url: Column, domains: Sequence[str] = V.JOURNAL_DOMAINS) -> Column:
    return under_any(host(url), domains)


def is_english_subject(url: Column) -> Column:
    return contains_any(F.lower(_given(url)), ["bahasa-inggris", "english", "b-inggris"])


def is_priority_section(url: Column) -> Column:
    starts = ("https://www.kompas.com/edu/", "https://www.kompas.com/skola/", "https://edukasi.kompas.com/")
    return F.greatest(*[F.startswith(_given(url), F.lit(s)) for s in starts])


def source_of(url: Column) -> Column:
    """What stands between the second and the third slash."""
    return F.get(F.split(url, "/"), F.lit(2))


