"""The SQL of :mod:`corpusloom.queries`, for DuckDB over the same tables.

Written apart from the expressions: list functions and RE2 patterns. RE2's
classes are ASCII's, so Unicode classes are spelled out.
"""

from __future__ import annotations

import re

from corpusloom.functions import vocabulary as V
from corpusloom.queries import BLOCKED, CLAIM_CAP, COMMON, KEYWORDS, LEVELS, LOOSE, OLD_URLS, RULE_HOSTS, RULE_SECTIONS, SHARDS, SIGNALS, SITE_MARKUP, SITES, ranks_path
from corpusloom.settings import Settings

TS = "TIMESTAMP '2024-01-15 00:00:00'"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _re2(pattern: str) -> str:
    """A pattern of the fixed values with Unicode classes that RE2 knows."""
    out = re.sub(r"\[([^\]]*)\\s([^\]]*)\]", r"[\1\\s\2]", pattern)
    return out.replace(r"\w", r"[\p{L}\p{N}_]").replace(r"\d", r"\p{Nd}").replace(r"[\p{L}\p{N}_]{2,20}", r"(?:[\p{L}\p{N}_]{2,20})")


def _any(patterns: list[str]) -> str:
    return _q("(?i)^(?:" + "|".join(map(_re2, patterns)) + ")")


def _in(values: list[str]) -> str:
    return "(" + ", ".join(map(_q, values)) + ")"


def _list(values: list[str]) -> str:
    return "[" + ", ".join(map(_q, values)) + "]"


WORDS = r"regexp_extract_all({}, '\S+')"
COUNT = "len(" + WORDS + ")"
HOST = r"lower(regexp_extract({}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1))"
PATH = r"regexp_extract({}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
#: The text of markup as the tables have it: tags apart, four entities.
BARE = "regexp_replace(replace(replace(replace(regexp_replace({}, '<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;?', '&', 'g')"
NORMALIZED = rf"""
parts AS (SELECT page_id, url, html, split_part(trim(url), '#', 1) AS u FROM pages),
cut AS (SELECT *, lower(regexp_extract(u, '^([A-Za-z]+)://', 1)) AS scheme, {HOST.format("u")} AS host, {PATH.format("u")} AS path,
               array_to_string(list_sort(list_filter(string_split(regexp_extract(u, '\?(.*)$', 1), '&'), lambda x: regexp_matches(x, '^[^=]*=.')
                 AND NOT regexp_matches(lower(x), '^(utm_[^=]*|{"|".join(V.TRACKING_PARAMS)})='))), '&') AS q FROM parts),
norm AS (SELECT *, scheme || '://' || host || CASE WHEN path = '/' THEN path ELSE regexp_replace(path, '/+$', '') END || CASE WHEN q <> '' THEN '?' || q ELSE '' END AS normalized FROM cut)
"""
JOBS = f"""
jobs AS (SELECT event_id AS id, 'https://h' || (user_id % 50) || '.example.org/p/' || event_id AS url, 'h' || (user_id % 50) || '.example.org' AS domain,
  (['pending', 'processing', 'completed', 'failed', 'ignored'])[(event_id % 5 + 1)::INT] AS status, event_type, ts AS created_at, (event_id % 4)::INT AS attempts,
  CASE WHEN event_id % 3 = 0 THEN {TS} + (event_id % 7 - 3) * INTERVAL 1 HOUR END AS next_retry_at, (event_id % 11)::INT AS priority FROM events)
"""
READY = f"(status = 'pending' AND (next_retry_at IS NULL OR next_retry_at <= {TS}))"
PHRASES = f"phrases AS (SELECT item_id AS pos, array_to_string(({WORDS.format('lower(text)')})[1:3], ' ') AS phrase FROM benchmark)"
LINES = "string_split(coalesce(text, ''), chr(10))"
STRIP = r"regexp_replace(regexp_replace({}, '^\s+', ''), '\s+$', '')"
SQUEEZE = r"trim(regexp_replace({}, '\s+', ' ', 'g'))"


def _runs(lines: str, most: int) -> str:
    """``lines`` without blank ones that ``most`` blank ones come right before."""
    before = " AND ".join(f"trim({lines}[i - {b}]) = ''" for b in range(1, most + 1))
    return f"list_filter({lines}, lambda x, i: NOT (trim(x) = '' AND i > {most} AND {before}))"


S = "trim(x, ' ' || chr(9) || chr(13))"
PLAIN = f"trim(replace({S}, '*', ''))"
FURNITURE = f"""(({S} <> '' AND regexp_matches({S}, {_any(V.UI_NOISE)})) OR regexp_matches({PLAIN}, '^(?:{V.ICON_TEXT})$')
  OR ({S} <> '' AND {COUNT.format(S)} <= 3 AND NOT regexp_matches({S}, '[.!?:;,()]') AND NOT starts_with({S}, '#')
      AND (lower({PLAIN}) IN {_in(V.BUTTON_WORDS)} OR ({COUNT.format(S)} = 1 AND length({PLAIN}) < 15 AND regexp_matches(lower({PLAIN}), '^\\p{{L}}+$')))))"""
MARKDOWN = f"""
kept AS (SELECT *, list_filter({LINES}, lambda x: NOT {FURNITURE}) AS k FROM documents),
markdown AS (SELECT *, {STRIP.format(f"array_to_string({_runs('k', 2)}, chr(10))")} AS cleaned FROM kept)
"""


def _main(source: str, column: str) -> str:
    """(…, main) of ``source``: paragraphs once each without fragments."""
    key = r"regexp_replace(lower({}), '[^\p{{L}}\p{{N}}_]+', '', 'g')"
    return f"""
paras AS (SELECT *, list_filter(list_transform(regexp_split_to_array({STRIP.format(column)}, '\\n\\s*\\n+'), lambda x: {STRIP.format("x")}), lambda x: x <> '') AS p FROM {source}),
keyed AS (SELECT *, list_transform(p, lambda x: {key.format("x")}) AS ks FROM paras),
firsts AS (SELECT *, list_filter(p, lambda x, i: ks[i] <> '' AND list_position(ks, ks[i]) = i) AS f FROM keyed),
longs AS (SELECT *, list_filter(f, lambda x: starts_with(x, '#') OR {COUNT.format("x")} >= 6 OR length(x) >= 80) AS g FROM firsts),
mains AS (SELECT *, {STRIP.format("array_to_string(CASE WHEN len(g) > 0 THEN g ELSE p END, chr(10) || chr(10))")} AS m FROM longs),
main AS (SELECT *, CASE WHEN m <> '' THEN m || chr(10) ELSE '' END AS main FROM mains)
"""


def _quality(content: str, title: str) -> str:
    n, low = COUNT.format(content), f"lower({SQUEEZE.format(content)})"
    base = f"CASE WHEN {n} >= 400 THEN 0.95 WHEN {n} >= 250 THEN 0.90 WHEN {n} >= 150 THEN 0.82 WHEN {n} >= 110 THEN 0.78 ELSE 0.60 END::DOUBLE"
    links = f"CASE WHEN len(regexp_extract_all({low}, 'http')) > greatest(3, {n} // 80) THEN 0.05 ELSE 0.0 END::DOUBLE"
    t = f"lower({STRIP.format(title)})"
    bonus = f"CASE WHEN length({t}) >= 8 AND contains({low}, {t}) THEN 0.02 ELSE 0.0 END::DOUBLE"
    return f"CASE WHEN {content} = '' THEN 0.0 ELSE least(greatest({base} - {links} + {bonus}, 0.0), 1.0) END"


def _language(text: str, threshold: float) -> str:
    w = WORDS.format(f"lower({text})")
    return f"CASE WHEN len({w}) < 30 THEN true ELSE len(list_filter({w}, lambda w: w IN {_in(COMMON)})) / len({w}) >= {threshold} END"


def _hits(text: str, words: list[str]) -> str:
    return f"list_filter({_list(words)}, lambda k: contains(lower({text}), lower(k)))"


FINGERPRINT = "sha256(" + SQUEEZE.format("lower({})") + ")"


def _gated(title: str, s: Settings) -> str:
    """(…, main, quality, fp, reject_reason) of ``documents`` (doc_id, text, …), whose titles are ``title``."""
    return f"""
{MARKDOWN}, {_main("markdown", "cleaned")},
stage AS (SELECT *, {_quality("main", title)} AS quality, {FINGERPRINT.format("main")} AS fp, length({STRIP.format("text")}) AS n0, length(cleaned) AS n1, length(m) AS n2 FROM main),
early AS (SELECT *, CASE WHEN n0 = 0 THEN 'no_content' WHEN n0 < 100 THEN 'too_short_raw' WHEN n1 < 100 THEN 'too_short_clean' WHEN n2 < 250 THEN 'too_short_main'
  WHEN quality < 0.7 THEN 'low_extraction_quality' END AS e FROM stage),
ranked AS (SELECT *, row_number() OVER (PARTITION BY fp, e IS NULL ORDER BY doc_id) AS r FROM early),
judged AS (SELECT *, CASE WHEN len({_hits("main", SIGNALS)}) >= {s.max_ad_signals} THEN 'advertisement'
  WHEN NOT ({_language("main", s.language_threshold)}) THEN 'non_indonesian'
  WHEN len({_hits(title + " || ' ' || main", KEYWORDS)}) < {s.min_keywords} THEN 'low_relevance' END AS late FROM ranked),
gated AS (SELECT *, CASE WHEN e IS NOT NULL THEN e WHEN r > 1 THEN 'duplicate_content' ELSE late END AS reject_reason FROM judged)
"""


GATED = _gated("substring(text, 1, 12)", LOOSE)
#: How a byte-pair vocabulary splits texts, in RE2; U+E000 stands where white space parts before its last character.
PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}\x{E000}]+|\s+"
#: One page after another, with what is accepted of hosts and seen of fingerprints so far.
IN_ORDER = f"""{GATED}, queue AS MATERIALIZED (SELECT row_number() OVER (ORDER BY doc_id) AS n, doc_id, source || '.example.org' AS host, fp, e, late FROM judged),
fold AS (SELECT 0::BIGINT AS n, 0::BIGINT AS doc_id, ''::VARCHAR AS host, []::VARCHAR[] AS accepted, []::VARCHAR[] AS seen, ''::VARCHAR AS reject_reason
  UNION ALL SELECT n, doc_id, host, CASE WHEN reason IS NULL THEN list_append(accepted, host) ELSE accepted END, CASE WHEN beyond OR e IS NOT NULL THEN seen ELSE list_append(seen, fp) END, reason
  FROM (SELECT *, CASE WHEN beyond THEN 'domain_cap:' || host WHEN e IS NOT NULL THEN e WHEN list_contains(seen, fp) THEN 'duplicate_content' ELSE late END AS reason
    FROM (SELECT q.*, f.accepted, f.seen, len(list_filter(f.accepted, lambda x: x = q.host)) >= {CLAIM_CAP} AS beyond FROM fold f JOIN queue q ON q.n = f.n + 1)))"""


def _tokens(of: str, text: str, path: str) -> str:
    """CTEs that end in ``counts`` (doc_id, tokens) of ``text`` in ``of``: a pre-token's byte pairs are merged one at a time, lowest rank first."""
    return rf"""ranks AS (SELECT hex(from_base64(split_part(line, ' ', 1))) AS token, split_part(line, ' ', 2)::INT AS rank FROM read_csv({_q(path)}, columns={{'line': 'VARCHAR'}}, delim='\t', header=false, quote='')),
cut AS (SELECT doc_id, regexp_replace(substring(coalesce({text}, ''), 1, 200000), '(\s+)(\s\S)', '\1' || chr(57344) || '\2', 'g') AS t FROM {of}),
pre AS (SELECT doc_id, unnest(regexp_extract_all(t, {_q(PRETOKENS)})) AS w FROM cut),
merging AS (SELECT w, regexp_extract_all(hex(w), '..') AS parts, 0 AS step FROM (SELECT DISTINCT w FROM pre)
  UNION ALL SELECT w, parts[:k - 1] || [parts[k] || parts[k + 1]] || parts[k + 2:], step + 1
  FROM (SELECT w, any_value(parts) AS parts, any_value(step) AS step, arg_min(i, rank * 100000::BIGINT + i) AS k
    FROM (SELECT w, parts, step, unnest(range(1, len(parts))) AS i FROM merging) p JOIN ranks r ON r.token = parts[i] || parts[i + 1] GROUP BY w)),
sizes AS (SELECT w, arg_max(len(parts), step) AS n FROM merging GROUP BY w),
counts AS (SELECT doc_id, coalesce(sum(n), 0)::BIGINT AS tokens FROM cut LEFT JOIN pre USING (doc_id) LEFT JOIN sizes USING (w) GROUP BY doc_id)"""


def _plain(source: str, column: str) -> str:
    """(…, plain) of ``source`` without fences (the tables hold none)."""
    bare = STRIP.format("x")
    for pattern, by in (
        (r"!\[([^\]]*)\]\([^)]+\)", r"\1"), (r"\[([^\]]+)\]\([^)]+\)", r"\1"), (r"<[^>]+>", ""), (r"^#{1,6}\s+", ""), (r"\*{1,3}([^*]+)\*{1,3}", r"\1"),
        (r"`([^`]+)`", r"\1"), (r"^>+\s?", ""), (r"^\s*[-*+]\s+", ""), (r"^\s*\p{Nd}+\.\s+", ""), (r"\|", " "), (r"[ \t]{2,}", " "),
    ):
        bare = f"regexp_replace({bare}, {_q(pattern)}, {_q(by)}, 'g')"
    seps = r"regexp_matches(trim(x), '^\|?[-:|\s]+\|?$') OR regexp_matches(trim(x), '^[-*_]{3,}\s*$')"
    return f"""
bares AS (SELECT *, list_transform(list_filter(string_split(coalesce({column}, ''), chr(10)), lambda x: NOT ({seps})), lambda x: trim({bare})) AS b FROM {source}),
plains AS (SELECT *, {STRIP.format(f"array_to_string({_runs('b', 1)}, chr(10))")} AS plain FROM bares)
"""


def _cpt(source: str, column: str, compat: bool) -> str:
    """(…, cpt) of ``source``."""
    t = f"coalesce({column}, '')"
    for pattern in (f"(?i){V.URL_TEXT}", V.EMAIL_TEXT, _re2(V.PHONE_TEXT), V.ICON_TEXT):
        t = f"regexp_replace({t}, {_q(pattern)}, '', 'g')"
    t = f"regexp_replace({t}, {_q(rf'(?i)^(?:{V.DATELINE_CITIES})[\s,]*(?:{V.DATELINE_OUTLETS})\s*[-–—]\s*')}, '')"
    for pattern in (r"(?i)\s*(Read more|Baca selengkapnya)\s*[»›>…]+\s*", r"(?i)\s*Leave a Comment\s*", r"(?i)\s*Posting Komentar\s*"):
        t = f"regexp_replace({t}, {_q(pattern)}, ' ', 'g')"
    camel = r"^[A-Z][a-z]+[A-Z][a-z]+[A-Z]"
    nav = [p for p in V.NAV_LIKE if compat or p != camel]
    junk = f"regexp_matches(x, {_any(nav)}) OR regexp_matches(x, {_any(V.UI_NOISE)}) OR regexp_matches(x, {_q('^' + V.JOINED_CAMEL)}) OR regexp_matches(x, {_q('^' + _re2(V.LIST_LINE))})"
    junk += "" if compat else f" OR regexp_matches(x, {_q(camel)})"
    closed, long = "regexp_matches(x, " + _q("[.!?:;\"')]$") + ")", f"(length(x) >= 25 AND {COUNT.format('x')} >= 4)"
    errors = " OR ".join(f"contains(lower(r), {_q(e)})" for e in V.ERROR_SIGNALS)
    full = "list_filter(string_split(r, chr(10)), lambda x: trim(x) <> '')"
    return f"""
cpt1 AS (SELECT *, list_filter(list_transform(string_split({t}, chr(10)), lambda x: {STRIP.format("x")}), lambda x: x = '' OR (NOT ({junk}) AND ({closed} OR {long}))) AS l FROM {source}),
cpt2 AS (SELECT *, list_transform(l, lambda x: lower(x)) AS lk FROM cpt1),
cpt3 AS (SELECT *, list_transform(list_filter(l, lambda x, i: x = '' OR list_position(lk, lk[i]) = i), lambda x: trim(regexp_replace(x, '[ \\t]{{2,}}', ' ', 'g'))) AS l2 FROM cpt2),
cpt4 AS (SELECT *, {STRIP.format(f"array_to_string({_runs('l2', 1)}, chr(10))")} AS r FROM cpt3),
cpts AS (SELECT *, CASE WHEN len({full}) < 2 OR len(list_filter({full}, lambda x: {COUNT.format("x")} >= 6)) / len({full}) < 0.35 OR (({errors}) AND len({full}) < 10) THEN '' ELSE r END AS cpt FROM cpt4)
"""


def _good(text: str, least: int) -> str:
    sentences = f"list_filter(list_transform(string_split({text}, '.'), lambda x: {STRIP.format('x')}), lambda x: x <> '')"
    mean = f"(len({sentences}) = 0 OR list_sum(list_transform({sentences}, lambda x: {COUNT.format('x')})) / len({sentences}) >= 4)"
    return f"({COUNT.format(text)} >= {least} AND len(regexp_extract_all({text}, '[.!?,;:]')) >= 3 AND {mean})"


def _level(text: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({text}, {_q('(?i)' + p)}) THEN {_q(n)}" for n, p in LEVELS) + f" ELSE {_q(V.OTHER_LEVEL)} END"


def _fixed_level(text: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({text}, {_q('(?i)' + p)}) THEN {_q(n)}" for n, p in V.LEVELS) + f" ELSE {_q(V.OTHER_LEVEL)} END"


def _under(host: str, domains: list[str]) -> str:
    return "(" + " OR ".join(f"{host} = {_q(d)} OR ends_with({host}, {_q('.' + d)})" for d in domains) + ")"


#: Pages as articles: paragraphs after the heading; below 40 words by stretches of text, here where one has 25 characters.
ARTICLES = f"""parts AS (SELECT page_id, url, {BARE.format(r"regexp_extract(html, '(?is)<title>(.*?)</title>', 1)")} AS t, regexp_extract(html, '(?is)<article>(.*)</article>', 1) AS article FROM pages),
texts AS (SELECT page_id, url, trim(t) AS title, {COUNT.format(BARE.format("article"))} >= 40 AS long,
  list_filter(list_transform(string_split(regexp_replace(article, '(?is)^.*?</h1>', ''), '<p>'), lambda x: {STRIP.format(BARE.format("x"))}), lambda x: x <> '') AS ps FROM parts),
kinds AS (SELECT *, CASE WHEN long THEN 'css:article' WHEN len(list_filter(ps, lambda x: length(x) >= 25)) > 0 THEN 'density' ELSE 'none' END AS source FROM texts),
articles AS (SELECT *, CASE source WHEN 'css:article' THEN array_to_string(ps, chr(10) || chr(10)) WHEN 'density' THEN array_to_string(ps, chr(10)) ELSE '' END AS text FROM kinds)"""
SITE_ROWS = ", ".join(f"({_q(a)}, {_q(b)})" for a, b in SITES)
TEMPLATES = _list([t.replace("{site}", "example.org") for t in V.QUERY_TEMPLATES])
CLEANER = f"""list_filter(list_transform(list_filter(list_transform({LINES}, lambda x: {STRIP.format("x")}), lambda x: x <> '' AND NOT regexp_matches(x, {_any(V.CLEANER_NOISE)})),
  lambda x: regexp_replace(x, '_+', '', 'g')), lambda x: NOT (regexp_matches(x, '^\\(.*\\)$') AND length(x) < 50))"""


def oracle_sql() -> dict[str, str]:
    sha, path = "sha256({})".format, ranks_path()
    counted = {
        "token_counts": f"WITH RECURSIVE {_tokens('documents', 'text', path)} SELECT doc_id, tokens FROM counts",
        "run_tokens": f"""WITH RECURSIVE {GATED}, passing AS (SELECT doc_id, main FROM gated WHERE reject_reason IS NULL), {_tokens('passing', 'main', path)}
            SELECT count(*) AS pages, count(*) FILTER (reject_reason IS NULL) AS accepted, count(*) FILTER (reject_reason IS NOT NULL) AS rejected, (SELECT coalesce(sum(tokens), 0)::BIGINT FROM counts) AS tokens FROM gated""",
    }
    return (counted if path else {}) | {
        "experiment_records": f"""WITH {ARTICLES}, read AS (SELECT url, title, {SQUEEZE.format("array_to_string(ps, chr(10))")} AS c FROM articles), good AS (SELECT *, len({_hits("c", KEYWORDS)})::INTEGER AS relevance_score FROM read WHERE length(c) >= 100)
            SELECT url, title, {COUNT.format("c")}::INTEGER AS word_count, relevance_score FROM good WHERE {_quality("c", "title")} >= 0.7 AND {_language("c", 0.02)} AND relevance_score >= 1""",
        "cleaner_process": rf"""WITH whole AS (SELECT url, regexp_extract(html, '(?is)<article>(.*)</article>', 1) AS article, regexp_extract(html, '(?is)<body[^>]*>(.*)</body>', 1) AS body FROM pages),
            chosen AS (SELECT url, CASE WHEN {COUNT.format(BARE.format("article"))} > 30 THEN article ELSE replace(replace(regexp_replace(regexp_replace(body, '(?is)<(script|style)[^>]*>.*?</(script|style)>', '', 'g'), '(?is)<!--.*?-->', '', 'g'), '&copy;', '©'), '&middot;', '·') END AS h FROM whole),
            lines AS (SELECT url, {BARE.format("h").replace("'<[^>]*>', ' '", "'<[^>]*>', chr(10)")} AS text FROM chosen), done AS (SELECT url, array_to_string({CLEANER}, chr(10)) AS t FROM lines)
            SELECT url, split_part(url, '/', 3) AS source, {COUNT.format("t")}::INTEGER AS word_count, {_q(V.OTHER_LEVEL)} AS level, sha256(t) AS text_sha FROM done WHERE {COUNT.format("t")} >= 30 AND len({_hits("t", KEYWORDS)}) >= 1""",
        "tag_tasks": rf"""WITH {PHRASES}, s AS (SELECT pos, substring(trim(regexp_replace(lower(phrase), '[^a-z0-9]+', '-', 'g'), '-'), 1, 80) AS slug FROM phrases), t AS (SELECT min(pos) AS pos, slug FROM s WHERE slug <> '' GROUP BY slug)
            SELECT (row_number() OVER (ORDER BY pos) - 1)::INTEGER AS idx, 'https://www.kompas.com/tag/' || slug AS search_url, 'kompas_tag' AS engine FROM t""",
        "tag_page_links": f"""WITH p AS (SELECT page_id, {HOST.format("url")} AS host, page_id % 5 AS k FROM pages)
            SELECT 'https://www.kompas.com/tag/' || host AS page, CASE k WHEN 0 THEN 'https://www.kompas.com/read/' WHEN 1 THEN 'https://www.kompas.com/edu/read/' ELSE 'https://www.kompas.com/skola/read/' END || page_id AS url,
              row_number() OVER (PARTITION BY host ORDER BY k = 0, page_id)::INTEGER AS place FROM p WHERE k IN (0, 1, 3)""",
        "archive_pages": """SELECT CASE WHEN page_id % 11 = 5 THEN NULL WHEN page_id % 7 = 3 THEN 404 ELSE 200 END::INTEGER AS status, CASE WHEN page_id % 11 = 5 THEN 'record of another length' END AS error,
            count(*) AS n, sum(CASE WHEN page_id % 11 <> 5 THEN length(html) END)::BIGINT AS chars FROM pages GROUP BY 1, 2""",
        "archive_crawl": f"""WITH {ARTICLES}, fetched AS (SELECT * FROM articles WHERE page_id % 11 <> 5 AND page_id % 7 <> 3), documents AS (SELECT page_id AS doc_id, url, title, source, text FROM fetched), {_gated("title", Settings())},
            known AS (SELECT DISTINCT fp FROM gated WHERE e IS NULL AND doc_id % 4 = 0),
            settled AS (SELECT doc_id, url, CASE WHEN e IS NULL AND fp IN (SELECT fp FROM known) THEN 'duplicate_content' ELSE reject_reason END AS reject_reason FROM gated),
            hosts AS (SELECT *, {HOST.format("url")} AS host, row_number() OVER (PARTITION BY {HOST.format("url")}, reject_reason IS NULL ORDER BY doc_id) AS nth FROM settled)
            SELECT doc_id AS id, host, CASE WHEN reject_reason IS NULL AND nth > 5 THEN 'domain_cap:' || host ELSE reject_reason END AS reject_reason FROM hosts
            UNION ALL SELECT page_id, {HOST.format("url")}, CASE WHEN page_id % 11 = 5 THEN 'fetch:record of another length' ELSE 'HTTP 404' END FROM pages WHERE page_id % 11 = 5 OR page_id % 7 = 3""",
        "vocabulary_matches": """WITH words AS (SELECT DISTINCT w FROM (SELECT unnest(string_split(lower(text), ' ')) AS w FROM benchmark) WHERE regexp_full_match(w, '[a-z]{5,}')),
            found AS (SELECT doc_id, count(*) AS n, min(w) AS a, max(w) AS z FROM documents JOIN words ON contains(lower(text), w) GROUP BY doc_id)
            SELECT d.doc_id, coalesce(n, 0)::INTEGER AS n, a AS first, z AS last FROM documents d LEFT JOIN found USING (doc_id)""",
        "claim_order_gates": f"WITH RECURSIVE {IN_ORDER} SELECT doc_id, reject_reason FROM fold WHERE n > 0",
        "host_successes": f"WITH RECURSIVE {IN_ORDER} SELECT host, count(*) AS n FROM fold WHERE n > 0 AND reject_reason IS NULL GROUP BY host",
        "url_normalize": f"WITH {NORMALIZED} SELECT page_id, normalized, sha256(normalized) AS url_hash, {HOST.format('url')} AS host FROM norm",
        "url_predicates": f"""SELECT page_id, (regexp_matches(lower(url), '^https?://') AND NOT {_under(HOST.format("url"), BLOCKED)} AND NOT ends_with(lower({PATH.format("url")}), '.html') AND NOT contains(lower(url), 'page=2')) AS valid,
            (contains(lower(url), 'blog.') OR contains(lower(url), 'example.net/')) AS education,
            (CASE WHEN starts_with({HOST.format("url")}, 'www.') THEN 1 WHEN ends_with({HOST.format("url")}, '.org') AND contains(lower({PATH.format("url")}), '/es/') THEN 3
              WHEN ends_with({HOST.format("url")}, '.org') OR ends_with({HOST.format("url")}, '.net') THEN 4 ELSE 10 END)::INT AS priority FROM pages""",
        "url_dedupe_first": f"WITH {NORMALIZED} SELECT min(page_id) AS page_id, normalized FROM norm GROUP BY normalized",
        "site_longest_suffix": f"""WITH s(site, method) AS (VALUES {SITE_ROWS}), p AS (SELECT page_id, {HOST.format("url")} AS h FROM pages),
            m AS (SELECT page_id, site, method, row_number() OVER (PARTITION BY page_id ORDER BY length(site) DESC) AS r FROM p LEFT JOIN s ON h = site OR ends_with(h, '.' || site))
            SELECT page_id, site, method FROM m WHERE r = 1""",
        "blocked_domain_anti": f"SELECT page_id, url FROM pages WHERE NOT {_under(HOST.format('url'), BLOCKED)}",
        "whitelist_semi": f"SELECT page_id, url FROM pages WHERE {_under(HOST.format('url'), ['example.org'])}",
        "page_hrefs": """SELECT page_id, len(regexp_extract_all(html, '(?i)href="([^"]*)"', 1))::INT AS n_hrefs, array_to_string(regexp_extract_all(html, '(?i)href="([^"]*)"', 1), ' ') AS hrefs FROM pages""",
        "page_links": f"""WITH h AS (SELECT DISTINCT url AS page, unnest(regexp_extract_all(html, '(?i)href="([^"]*)"', 1)) AS href FROM pages),
            u AS (SELECT page, CASE WHEN starts_with(href, '/') THEN regexp_extract(page, '^[A-Za-z]+://[^/?#]*') || href ELSE href END AS url FROM h)
            SELECT page, count(DISTINCT url) AS n_links FROM u WHERE regexp_matches(url, '^https?://') AND NOT regexp_matches(lower({PATH.format("url")}), '({"|".join(re.escape(e) for e in V.SKIP_EXTENSIONS)})$')
              AND NOT ({" OR ".join(f"contains(lower(url), {_q(p.lower())})" for p in V.BLOCKED_URL_PARTS)}) AND NOT {_under(HOST.format("url"), V.BLOCKED_DOMAINS)} GROUP BY page""",
        "page_extract": f"""WITH {ARTICLES} SELECT page_id AS id, title, source AS extraction_source, {COUNT.format("text")}::INT AS words FROM articles""",
        "crawl_pipeline": f"""WITH {ARTICLES}, documents AS (SELECT page_id AS doc_id, url, title, source, text FROM articles), {_gated("title", Settings())},
            hosts AS (SELECT *, {HOST.format("url")} AS host, row_number() OVER (PARTITION BY {HOST.format("url")}, reject_reason IS NULL ORDER BY doc_id) AS nth FROM gated)
            SELECT doc_id AS id, host, source AS extraction_source, fp AS fingerprint,
              CASE WHEN reject_reason IS NULL AND nth > 5 THEN 'domain_cap:' || host ELSE reject_reason END AS reject_reason FROM hosts""",
        "page_title": f"""SELECT page_id, {STRIP.format("replace(replace(replace(regexp_extract(html, '(?is)<title>(.*?)</title>', 1), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')")} AS title FROM pages""",
        "tag_urls": rf"""WITH {PHRASES}, s AS (SELECT pos, substring(trim(regexp_replace(lower(phrase), '[^a-z0-9]+', '-', 'g'), '-'), 1, 80) AS slug FROM phrases)
            SELECT min(pos) AS pos, 'https://www.kompas.com/tag/' || slug AS search_url, 'kompas_tag' AS engine FROM s WHERE slug <> '' GROUP BY slug""",
        "site_queries": f"""WITH {PHRASES}, t AS (SELECT pos * 8 + i - 1 AS pos, replace(({TEMPLATES})[i], '{{kw}}', phrase) AS query FROM phrases, range(1, 9) r(i) WHERE {COUNT.format("phrase")} >= 2),
            d AS (SELECT min(pos) AS pos, query FROM t GROUP BY query) SELECT pos, query FROM d ORDER BY pos LIMIT 400""",
        "search_urls_sharded": rf"""WITH {PHRASES}, t AS (SELECT pos * 8 + i - 1 AS pos, replace(({TEMPLATES})[i], '{{kw}}', phrase) AS query FROM phrases, range(1, 9) r(i) WHERE {COUNT.format("phrase")} >= 2),
            d AS (SELECT min(pos) AS pos, query FROM t GROUP BY query ORDER BY pos LIMIT 400), e AS (SELECT pos * 2 + e AS pos, e, replace(replace(url_encode(query), '%20', '+'), chr(39), '%27') AS q FROM d, range(0, 2) b(e)),
            n AS (SELECT *, (row_number() OVER (ORDER BY pos) - 1)::INT AS idx FROM e)
            SELECT idx, CASE WHEN e = 0 THEN 'https://html.duckduckgo.com/html/?q=' ELSE 'https://www.bing.com/search?q=' END || q AS search_url, CASE WHEN e = 0 THEN 'duckduckgo' ELSE 'bing' END AS engine, idx % {SHARDS} AS shard FROM n""",
        "word_count": f"SELECT doc_id, {COUNT.format('text')}::INT AS words, {COUNT.format('substring(text, 1, 200000)')}::INT AS tokens FROM documents",
        "lang_ratio_gate": f"SELECT doc_id, {_language('text', 0.1)} AS is_language FROM documents",
        "keyword_hits": f"SELECT doc_id, len({_hits('text', KEYWORDS)})::INT AS hits, array_to_string({_hits('text', KEYWORDS)}, ',') AS found, len({_hits('text', SIGNALS)})::INT AS signals FROM documents",
        "classify_level": f"SELECT doc_id, {_level('text')} AS level FROM documents",
        "extraction_quality": f"SELECT doc_id, round({_quality('text', 'substring(text, 1, 12)')}, 6) AS quality FROM documents",
        "content_fingerprint": f"SELECT doc_id, {FINGERPRINT.format('text')} AS fingerprint FROM documents",
        "dedupe_first_wins": f"SELECT min(doc_id) AS doc_id, {FINGERPRINT.format('text')} AS fp FROM documents GROUP BY 2",
        "domain_cap": f"WITH p AS (SELECT page_id, {HOST.format('url')} AS host FROM pages) SELECT page_id, host FROM p QUALIFY row_number() OVER (PARTITION BY host ORDER BY page_id) <= 5",
        "quality_gate": f"SELECT doc_id, {_good('text', 75)} AS ok FROM documents",
        "main_paragraphs": f"WITH {_main('documents', 'text')} SELECT doc_id, sha256(main) AS main_sha FROM main",
        "pdf_text_clean": f"SELECT doc_id, {sha(SQUEEZE.format(f'''array_to_string(list_filter({LINES}, lambda x: length(trim(x)) >= 3 AND NOT regexp_matches(trim(x), '^[0-9]+$')), chr(10))'''))} AS clean_sha FROM documents",
        "cleaner_lines": f"SELECT doc_id, {sha(f'array_to_string({CLEANER}, chr(10))')} AS lines_sha FROM documents",
        "normalize_text": f"SELECT doc_id, {sha(SQUEEZE.format('text'))} AS text_sha FROM documents",
        "clean_markdown": f"WITH {MARKDOWN} SELECT doc_id, sha256(cleaned) AS markdown_sha FROM markdown",
        "plain_text": f"WITH {_plain('documents', 'text')} SELECT doc_id, sha256(plain) AS plain_sha FROM plains",
        "cpt_clean": f"WITH {_cpt('documents', 'text', False)} SELECT doc_id, sha256(cpt) AS cpt_sha FROM cpts",
        "cpt_clean_compat": f"WITH {_cpt('documents', 'text', True)} SELECT doc_id, sha256(cpt) AS cpt_sha FROM cpts",
        "gate_reasons": f"WITH {GATED} SELECT doc_id, reject_reason FROM gated",
        "reject_histogram": f"WITH {GATED} SELECT coalesce(reject_reason, 'accepted') AS outcome, count(*) AS n FROM gated GROUP BY 1",
        "cpt_records": f"""WITH {GATED}, ok AS (SELECT g.doc_id, d.source AS src, g.main, trim(substring(g.text, 1, 12)) AS title FROM gated g JOIN documents d USING (doc_id) WHERE reject_reason IS NULL), {_plain("ok", "main")}, {_cpt("plains", "plain", False)},
            titled AS (SELECT *, CASE WHEN length(title) > 10 AND NOT contains(lower(substring(cpt, 1, 200)), lower(title)) THEN title || chr(10) || chr(10) || cpt ELSE cpt END AS out FROM cpts WHERE cpt <> '')
            SELECT 'https://' || src || '.example.org/read/' || doc_id AS url, src || '.example.org' AS source, {_fixed_level("main || ' https://' || src || '.example.org/read/' || doc_id")} AS level, {COUNT.format("out")}::INT AS word_count, sha256(out) AS text_sha
            FROM titled WHERE {_good("out", 75)}""",
        "phrase_scan": rf"""WITH l AS (SELECT item_id AS pos, ({WORDS.format("lower(text)")})[1] || ' ' || ({WORDS.format("lower(text)")})[2] AS phrase FROM benchmark),
            k AS (SELECT *, CASE pos % 5 WHEN 1 THEN 'www.example.org' WHEN 2 THEN 'example.com' END AS site FROM l WHERE pos % 5 <> 0 AND phrase IS NOT NULL)
            SELECT pos, phrase, site FROM k QUALIFY row_number() OVER (PARTITION BY phrase ORDER BY pos) = 1""",
        "sitemap_walk": "SELECT DISTINCT trim(url) AS url FROM pages WHERE contains(url, '/es/') OR contains(url, 'page=')",
        "sitemap_parse": f"""SELECT 'map:' || {HOST.format("url")} AS sitemap_url, 0::INT AS n_children, count(DISTINCT url)::INT AS n_pages FROM pages GROUP BY 1
            UNION ALL SELECT 'map', count(DISTINCT {HOST.format("url")})::INT, 0 FROM pages""",
        "search_results": f"""SELECT 'https://search/' || {HOST.format("url")} AS page, url, 2::BIGINT AS n FROM (SELECT DISTINCT url FROM pages)
            WHERE NOT regexp_matches(lower({PATH.format("url")}), '({"|".join(re.escape(e) for e in V.SKIP_EXTENSIONS)})$') AND NOT ({" OR ".join(f"contains(lower(url), {_q(p.lower())})" for p in V.BLOCKED_URL_PARTS)})
              AND NOT {_under(HOST.format("url"), V.BLOCKED_DOMAINS)}""",
        "pagination_chain": r"""WITH c AS (SELECT conv_id, turn, text, min(CASE WHEN text = '' OR text IS NULL THEN turn END) OVER (PARTITION BY conv_id) AS stop,
              row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS r FROM conversations)
            SELECT 'c/' || conv_id || '/0' AS url, count(*)::INT AS n_pages, sha256(string_agg(text, chr(10) || chr(10) ORDER BY turn)) AS content_sha
            FROM c WHERE r = turn AND turn < 5 AND (stop IS NULL OR turn < stop) GROUP BY conv_id""",
        "spider_links": f"""WITH l AS (SELECT {HOST.format("url")} AS page, page_id::INT AS pos, url || '#belajar' AS u, lower({PATH.format("url")}) AS p FROM pages)
            SELECT page, pos FROM l WHERE contains(u, 'example.') QUALIFY row_number() OVER (PARTITION BY page ORDER BY pos) <= 4""",
        "journal_records": rf"""WITH c AS (SELECT doc_id, {SQUEEZE.format(f"""array_to_string(list_filter({LINES}, lambda x: length(trim(x)) >= 3 AND NOT regexp_matches(trim(x), '^[0-9]+$')), chr(10))""")} AS t FROM documents)
            SELECT 'https://neliti.com/p/' || doc_id || '.pdf' AS url, 'https://neliti.com/j/' || doc_id AS source_page, 'siswa dan guru ' || doc_id AS title, 'A;B' AS authors, {COUNT.format("t")}::INT AS word_count,
              'jurnal_ilmiah' AS type, 'umum' AS level FROM c WHERE length(t) >= 500""",
        "raw_records": f"""SELECT 'https://' || source || '.example.org/read/' || doc_id AS url, '2024-01-15T00:00:00.000000+00:00' AS timestamp, {COUNT.format("text")}::INT AS word_count,
            array_to_string({_hits("substring(text, 1, 12) || ' ' || text", KEYWORDS)}, ',') AS keywords, source || '.example.org' AS domain FROM documents""",
        "article_urls": rf"""WITH p AS (SELECT page_id, url, CASE WHEN page_id % 2 = 0 THEN {PATH.format("url")} ELSE '' END AS t FROM pages)
            SELECT page_id, contains('/read' || t, '/read/') AS kompas, true AS detik, contains('/read' || t, '/read/') AS liputan6, (starts_with('/blog' || lower(t), '/blog/') AND length(t) > 1) AS ruangguru,
              contains('/berita' || lower(t), '/berita/') AS republika, contains('/id/blog' || lower(t), '/blog/') AS quipper, (contains('/blog' || lower(t), '/blog/') AND length('/blog' || t) > 6) AS zenius,
              {_under(HOST.format("url"), ["example.org"])} AS journal, substring(trim(regexp_replace(trim(url), '[^A-Za-z0-9_.-]+', '_', 'g'), '._-'), 1, 64) AS instance, split_part(url, '/', 3) AS source FROM p""",
        "education_related": f"SELECT doc_id, len({_hits('text', KEYWORDS)}) >= 4 AS related, ({COUNT.format('text')} >= 100 AND len({_hits('text', KEYWORDS)}) >= 2) AS valid FROM documents",
        "run_counters": f"""WITH {GATED} SELECT count(*) AS pages, count(*) FILTER (reject_reason IS NULL) AS accepted, count(*) FILTER (reject_reason IS NOT NULL) AS rejected,
            coalesce(sum(CASE WHEN reject_reason IS NULL THEN {COUNT.format('substring(main, 1, 200000)')} END), 0)::BIGINT AS tokens FROM gated""",
        "host_counts": f"SELECT {HOST.format('url')} AS host, count(*) AS n FROM pages GROUP BY 1",
        "uptime_format": "SELECT event_id AS id, printf('%02d:%02d:%02d', event_id * 7 // 3600, event_id * 7 % 3600 // 60, event_id * 7 % 60) AS uptime, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS iso FROM events",
        "stream_dedupe": f"SELECT DISTINCT {FINGERPRINT.format('text')} AS fingerprint FROM documents",
        "job_counts": f"""WITH {JOBS} SELECT status, count(*)::BIGINT AS n FROM jobs GROUP BY status UNION ALL SELECT 'total', count(*) FROM jobs UNION ALL SELECT 'pending_ready', count(*) FILTER ({READY}) FROM jobs""",
        "claim_order": f"WITH {JOBS} SELECT id, url, priority FROM jobs WHERE {READY} ORDER BY priority, created_at, id LIMIT 25",
        "retry_schedule": f"""WITH {JOBS}, n AS (SELECT id, attempts + 1 AS a FROM jobs WHERE status = 'processing'), w AS (SELECT *, 10.0 * pow(2, greatest(a - 1, 0)) AS d FROM n)
            SELECT id, CASE WHEN a >= 3 THEN 'failed' ELSE 'pending' END AS status, a::INT AS attempts, 'HTTP ' || id AS last_error, CASE WHEN a < 3 THEN ((d + 0.5 * least(5.0, d * 0.25)) * 1000000)::BIGINT END AS wait_us FROM w""",
        "job_complete": f"""WITH {JOBS} SELECT id, CASE WHEN status = 'processing' THEN 'completed' ELSE status END AS status, CASE WHEN status = 'processing' THEN 't' END AS title,
            CASE WHEN status = 'processing' THEN 'level=SMA,type=new' ELSE 'type=' || event_type END AS meta FROM jobs""",
        "job_recover": f"WITH {JOBS} SELECT CASE WHEN status = 'processing' THEN 'pending' ELSE status END AS status, count(*) AS n FROM jobs GROUP BY 1",
        "enqueue_new": f"""WITH {NORMALIZED}, old AS (SELECT DISTINCT normalized FROM norm WHERE page_id % 4 = 0)
            SELECT DISTINCT normalized AS url, sha256(normalized) AS url_hash, host AS domain, 'pending' AS status, 10::INT AS priority FROM norm
            WHERE normalized NOT IN (SELECT normalized FROM old) AND NOT regexp_matches(lower({PATH.format("normalized")}), '({"|".join(re.escape(e) for e in V.SKIP_EXTENSIONS)})$')
              AND NOT ({" OR ".join(f"contains(lower(normalized), {_q(p.lower())})" for p in V.BLOCKED_URL_PARTS)}) AND NOT {_under("host", V.BLOCKED_DOMAINS)}""",
        "priority_backfill": f"""WITH {JOBS}, u AS (SELECT coalesce(({_list(OLD_URLS)})[(id % {len(OLD_URLS) + 1} + 1)::INT], url) AS url, CASE WHEN id % 13 <> 0 THEN priority END AS priority FROM jobs),
            h AS (SELECT *, {HOST.format("url")} AS domain FROM u)
            SELECT domain, CASE WHEN priority IS NOT NULL AND priority NOT IN (2, 10) THEN priority WHEN url ILIKE 'https://www.kompas.com/edu/%' OR url ILIKE 'https://www.kompas.com/skola/%' THEN 0
              WHEN url ILIKE 'https://edukasi.kompas.com/%' THEN 1 WHEN domain ILIKE '%kompas.com' THEN 2 ELSE 10 END::INT AS priority, count(*) AS n FROM h GROUP BY ALL""",
        "job_ignore": f"""WITH {JOBS} SELECT id, CASE WHEN status = 'processing' THEN 'ignored' ELSE status END AS status, CASE WHEN status = 'processing' THEN 'too_short_' || repeat('x', 490) END AS last_error, attempts FROM jobs""",
        "url_rules": rf"""WITH p AS (SELECT page_id, ({_list(RULE_HOSTS)})[(page_id % {len(RULE_HOSTS)} + 1)::INT] AS h, ({_list(RULE_SECTIONS)})[(page_id % {len(RULE_SECTIONS)} + 1)::INT] AS sec FROM pages),
            u AS (SELECT page_id, h, lower(sec) AS p, 'https://' || h || sec || page_id AS url FROM p)
            SELECT page_id, (CASE WHEN h = 'www.kompas.com' AND (starts_with(p, '/edu/') OR starts_with(p, '/skola/')) THEN 0 WHEN h = 'edukasi.kompas.com' THEN 1 WHEN ends_with(h, 'kompas.com') THEN 2
                WHEN ends_with(h, 'detik.com') AND contains(p, '/edu/') THEN 3 WHEN ends_with(h, 'ruangguru.com') AND contains(p, '/blog/') THEN 4 WHEN ends_with(h, 'liputan6.com') AND contains(p, '/read/') THEN 5
                WHEN ends_with(h, 'detik.com') OR ends_with(h, 'ruangguru.com') OR ends_with(h, 'liputan6.com') THEN 6 WHEN ends_with(h, 'republika.co.id') AND contains(p, '/berita/') THEN 7
                WHEN ends_with(h, 'quipper.com') AND contains(p, '/blog/') THEN 8 WHEN ends_with(h, 'republika.co.id') OR ends_with(h, 'quipper.com') OR ends_with(h, 'zenius.net') THEN 9 ELSE 10 END)::INT AS priority,
              (contains(p, 'bahasa-inggris') OR contains(p, 'english') OR contains(p, 'b-inggris')) AS english,
              (starts_with(url, 'https://www.kompas.com/edu/') OR starts_with(url, 'https://www.kompas.com/skola/') OR starts_with(url, 'https://edukasi.kompas.com/')) AS section, h AS domain,
              {_under("h", ["kompas.com", "detik.com"])} AS listed, (NOT {_under("h", V.BLOCKED_DOMAINS)} AND NOT ({" OR ".join(f"contains(lower(url), {_q(x.lower())})" for x in V.BLOCKED_URL_PARTS)})) AS valid,
              ({" OR ".join(f"contains(lower(url), {_q(x.lower())})" for x in [*V.EDU_URL_PARTS, *V.ACCEPTED_HOST_PARTS])}) AS education FROM u""",
        "contents_not_seen": f"WITH f AS (SELECT doc_id, lang, {FINGERPRINT.format('text')} AS fingerprint FROM documents) SELECT doc_id, fingerprint FROM f WHERE fingerprint NOT IN (SELECT fingerprint FROM f WHERE lang = 'en')",
        "site_rules": f"""WITH l AS (SELECT doc_id, (doc_id % {len(SITE_MARKUP)})::INT AS k, list_filter(list_transform({LINES}, lambda x: {STRIP.format("x")}), lambda x: x <> '') AS l FROM documents),
            a AS (SELECT doc_id, k, CASE WHEN k = 0 AND len(l) > 0 THEN list_filter(list_concat([ltrim(l[1], ' -—–')], l[2:]), lambda x: x <> '') ELSE l END AS l FROM l),
            c AS (SELECT doc_id, k, CASE k WHEN 1 THEN list_concat(l, ['1. satu', '3. tiga']) WHEN 4 THEN list_concat(['## Awal'], l) WHEN 5 THEN list_concat(l, ['[Formula: a+b] x', 'kotak']) ELSE l END AS l FROM a)
            SELECT doc_id, 'Judul ' || doc_id AS title, ({_list(["manual_css:div.read__content" if m[1] == "css" else m[1] for m in SITE_MARKUP])})[k + 1] AS extraction_source,
              sha256(CASE WHEN k = 6 THEN array_to_string(l, chr(10)) ELSE array_to_string(l, chr(10) || chr(10)) END) AS content_sha FROM c""",
        "selector_cache_join": f"""WITH p AS (SELECT page_id, {HOST.format("url")} AS domain FROM pages), c AS (SELECT domain, '.c' || (max(page_id) % 3) AS selector FROM p GROUP BY domain)
            SELECT page_id, domain, CASE WHEN length(domain) % 3 <> 0 THEN selector END AS selector FROM p JOIN c USING (domain)""",
        "selector_upsert": f"""WITH p AS (SELECT {HOST.format("url")} AS domain, '.c' || (page_id % 3) AS selector, page_id AS last_seen, page_id / 10.0::DOUBLE AS quality FROM pages)
            SELECT domain, selector, last_seen, quality FROM p QUALIFY row_number() OVER (PARTITION BY domain ORDER BY last_seen DESC, selector DESC) = 1""",
    }
