"""Text functions as Catalyst expressions. Null texts count as empty ones.

White space and character classes are Unicode's, as in the patterns' origin:
patterns run with (?U), and words are what stands between the characters of
``SPACE``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import vocabulary as V

#: The code points of white space.
SPACE_CODES = [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SPACES = "".join(map(chr, SPACE_CODES))
#: Those beyond Latin-1, behind one range that most characters are not in, which makes the classes fast.
FAR_SPACES = r"[\x{1680}-\x{3000}&&[\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]]"
#: Those beyond \\s of a pattern without (?U).
RARE_SPACES = rf"\x1c\x1d\x1e\x1f\x85\xa0{FAR_SPACES}"
RARE = f"[{RARE_SPACES}]"
SPACE = rf"[ \t\n\x0b\f\r{RARE_SPACES}]"
NO_SPACE = rf"[^ \t\n\x0b\f\r{RARE_SPACES}]"
#: One space that is neither " " nor a line feed.
UNUSUAL = rf"[\t\x0b\f\r{RARE_SPACES}]"


def given(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once, however often ``f`` reads it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def _strip(t: Column) -> Column:
    """Of a value at hand. Trimming walks through all of a text, so one whose first and last byte print in ASCII is left alone."""
    last = F.substring(t.cast("binary"), -1, 1)
    edges = (t >= "!") & (t < "\x7f") & (last >= F.lit(b"!")) & (last < F.lit(b"\x7f"))
    return F.when(edges, t).otherwise(F.btrim(t, F.lit(SPACES)))


def stripped(text: Column) -> Column:
    """:func:`strip`, faster on long texts; it has no SQL text."""
    return let(text, _strip)


def _blank(t: Column) -> Column:
    """Whether a value at hand is empty or white space."""
    return ~((t >= "!") & (t < "\x7f")) & (F.btrim(t, F.lit(SPACES)) == "")


def computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` and a column that the optimizer neither copies into filters nor computes twice."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _by_spaces(text: Column, f: Callable[[Column, str, str], Column]) -> Column:
    """``f`` of a text and the patterns of space and non-space: short ones, much faster, where rare spaces are out of the question."""
    return let(given(text), lambda t: F.when(t.rlike(RARE), f(t, SPACE, NO_SPACE)).otherwise(f(t, r"\s", r"\S")))


def _if_single(text: Column, f: Callable[[Column], Column], other: Callable[[Column], Column]) -> Column:
    """``f`` of the text's words joined by single spaces where line feeds or single spaces part them already, as mostly; else ``other`` of the text."""

    def choose(t: Column) -> Column:
        flat = F.replace(F.replace(t, F.lit("\n\n"), F.lit(" ")), F.lit("\n"), F.lit(" "))
        single = lambda u: ~(F.startswith(u, F.lit(" ")) | F.endswith(u, F.lit(" ")) | F.contains(u, F.lit("  ")) | u.rlike(UNUSUAL))
        return let(flat, lambda u: F.when(single(u), f(u)).otherwise(other(t)))

    return let(given(text), choose)


def _occurrences(t: Column, part: str) -> Column:
    """How often a value at hand holds ``part``, an ASCII string."""
    return F.floor((F.octet_length(t) - F.octet_length(F.replace(t, F.lit(part), F.lit("")))) / len(part)).cast("int")


def _single_count(u: Column) -> Column:
    """Words of a text that single spaces part."""
    return F.when(u == "", 0).otherwise(_occurrences(u, " ") + 1)


def shorter(text: Column, n: int) -> Column:
    """Whether a text has fewer than ``n`` characters, which are counted only if its bytes leave that open."""
    return let(text, lambda t: (F.octet_length(t) < 4 * n) & (F.char_length(t) < n))


def words(text: Column) -> Column:
    return _by_spaces(text, lambda t, space, _: F.filter(F.split(t, f"{space}+"), lambda x: x != ""))


def word_count(text: Column) -> Column:
    return _if_single(text, _single_count, lambda t: _by_spaces(t, lambda t, _, other: F.regexp_count(t, F.lit(f"{other}+"))))


def has_words(text: Column, n: int) -> Column:
    """Whether there are ``n`` words at least, without a look at the rest."""
    return given(text).rlike(rf"^{SPACE}*+{NO_SPACE}++(?:{SPACE}++{NO_SPACE}++){{{n - 1}}}")


def squeezed(text: Column) -> Column:
    """Words joined by single spaces."""
    return _if_single(text, lambda u: u, lambda t: _by_spaces(t, lambda t, space, _: stripped(F.regexp_replace(t, f"{space}+", " "))))


def flat(text: Column) -> Column:
    """Lower-case words joined by single spaces: what quality, fingerprint and language look at, and take if it is at hand."""
    return squeezed(F.lower(given(text)))


def any_of(patterns: Sequence[str]) -> str:
    """One pattern that matches, at the start and in any case, what one of ``patterns`` does."""
    return "(?iU)^(?:" + "|".join(patterns) + ")"


def _one_of(patterns: Sequence[str]) -> str:
    """One pattern that occurs, in any case, where one of ``patterns`` does; lists of words are looked for at their first letters."""
    lists = [re.fullmatch(r"\\b\(([^()]*)\)(?:\\b)?", p) for p in patterns]
    heads = [word[:1] for m in lists if m for word in m[1].split("|")]
    ahead = f"(?=[{''.join(sorted(set(heads)))}])" if all(lists) and all("a" <= h <= "z" for h in heads) else ""
    return f"(?iU){ahead}(?:" + "|".join(f"(?:{p})" for p in patterns) + ")"


def _at_start(patterns: Sequence[str]) -> str:
    """:func:`any_of`, to stand within a pattern after ``^``, for texts that begin with no white space."""
    return "(?iU:" + "|".join(p.removeprefix(r"^\s*") for p in patterns) + ")"


def is_language(text: Column, common: Sequence[str] = V.COMMON_WORDS, threshold: float = 0.02, least: int = 30, flattened: Column | None = None) -> Column:
    """The share of words that are ``common`` reaches the threshold; texts of fewer than ``least`` words pass."""
    listed = "|".join(re.escape(w) for w in common if w and not set(w) & set(SPACES)) or r"(?!)"
    hits = lambda u: F.regexp_count(u, F.lit(rf"(?:^| )(?:{listed})(?= |\z)"))
    share = lambda u, n: F.when(n < least, True).otherwise(hits(u) / n >= threshold)
    return let(flat(text) if flattened is None else flattened, lambda u: let(_single_count(u), lambda n: share(u, n)))


def keywords_found(text: Column, keywords: Sequence[str] = V.TARGET_KEYWORDS) -> Column:
    """The keywords that the text contains, any case, in the list's order."""
    terms = F.array(*map(F.lit, keywords))
    return let(F.lower(given(text)), lambda low: F.filter(terms, lambda k: F.contains(low, F.lower(k))))


def relevance_score(text: Column, keywords: Sequence[str] = V.TARGET_KEYWORDS) -> Column:
    return F.size(keywords_found(text, keywords))


def classify_level(text: Column, url: Column | None = None, rules: Sequence[tuple[str, str]] = V.LEVELS, other: str = V.OTHER_LEVEL) -> Column:
    """The first level whose pattern occurs in the text or the URL."""
    both = F.concat(given(text), F.lit(" "), given(url) if url is not None else F.lit(""))

    def first(t: Column) -> Column:
        out = F.when(~t.rlike(_one_of([p for _, p in rules])), other)  # most texts match none, which one search finds
        for name, pattern in rules:
            out = out.when(t.rlike(f"(?iU){pattern}"), name)
        return out.otherwise(other)

    return let(both, first) if rules else F.lit(other)


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _without_runs(lines: Column, most: int) -> Column:
    """Blank lines beyond ``most`` in a row go: those that have that many blanks right before them."""
    def stays(x: Column, i: Column) -> Column:
        run = _blank(x)
        for back in range(1, most + 1):
            run = run & F.coalesce(let(F.get(lines, i - back), _blank), F.lit(False))
        return ~run

    return F.filter(lines, stays)


def clean_markdown(text: Column, noise: Sequence[str] = V.UI_NOISE, buttons: Sequence[str] = V.BUTTON_WORDS) -> Column:
    """Lines that are buttons, menus, icons or other page furniture go; two blank lines in a row stay at most."""
    noisy, icon = "^" + _at_start(noise), f"^(?:{V.ICON_TEXT})$"
    longest = max([14, *map(len, buttons)])

    def furniture(s: Column) -> Column:
        def label(plain: Column) -> Column:
            short = ~has_words(s, 4) & ~s.rlike("[.!?:;,()]") & ~F.startswith(s, F.lit("#"))
            word = ~s.rlike(SPACE) & (F.char_length(plain) < 15) & plain.rlike(r"^\p{L}+$")
            return plain.rlike(icon) | (short & (F.lower(plain).isin(*buttons) | word))

        # buttons and single words are short; icons begin with a line
        labelled = (F.char_length(s) <= longest) | F.startswith(s, F.lit("_")) | F.contains(s, F.lit("*"))
        return (s != "") & (s.rlike(noisy) | (labelled & let(stripped(F.replace(s, F.lit("*"), F.lit(""))), label)))

    kept = F.filter(_lines(given(text)), lambda x: ~let(_strip(x), furniture))
    return let(kept, lambda k: stripped(F.array_join(_without_runs(k, 2), "\n")))


#: A fenced block: from a line of three backquotes to the next such line, or to the end.
FENCED = rf"(?smd)^(?:(?!\n){SPACE})*```[^\n]*\n?(?:.*?^(?:(?!\n){SPACE})*```[^\n]*\n?|.*\z)"
#: What is taken out of each line of markdown, in this order.
MARKDOWN = [
    (r"!\[([^\]]*)\]\([^)]+\)", "$1"),
    (r"\[([^\]]+)\]\([^)]+\)", "$1"),
    (r"<[^>]+>", ""),
    (r"(?U)^#{1,6}\s+", ""),
    (r"\*{1,3}([^*]+)\*{1,3}", "$1"),
    (r"`([^`]+)`", "$1"),
    (r"(?U)^>+\s?", ""),
    (r"(?U)^\s*[-*+]\s+", ""),
    (r"(?U)^\s*\d+\.\s+", ""),
    (r"\|", " "),
    (r"[ \t]{2,}", " "),
]
#: In every line that these change, unless it begins with a marker.
INNER = r"[\[<*`|\t]|  "


def plain_text(markdown: Column) -> Column:
    """Markdown as plain prose: no fences, rules, table lines or markers; one blank line in a row at most."""
    marked = lambda x: F.substring(x, 1, 1).rlike(r"(?U)[-:|*_#>+\d]")
    rule = lambda x: x.rlike(r"(?U)^\|?[-:|\s]+\|?$") | x.rlike(r"(?U)^[-*_]{3,}\s*$")

    def bare(line: Column) -> Column:
        for pattern, by in MARKDOWN:
            line = F.regexp_replace(line, pattern, by)
        return stripped(line)

    def plain(t: Column) -> Column:
        whole = F.when(F.contains(t, F.lit("```")), F.regexp_replace(t, FENCED, "")).otherwise(t)
        lines = F.filter(F.transform(_lines(whole), _strip), lambda x: ~(marked(x) & rule(x)))
        # without one of these in the text, only what stands first in a line can be a marker
        return let(t.rlike(INNER), lambda inner: F.transform(lines, lambda x: F.when((inner & x.rlike(INNER)) | marked(x), bare(x)).otherwise(x)))

    return let(let(given(markdown), plain), lambda k: stripped(F.array_join(_without_runs(k, 1), "\n")))


def _firsts(items: Column, keys: Column, stays: Callable[[Column, Column], Column]) -> Column:
    """Those of ``items`` for whose key ``stays(key, is_first)`` holds, in their order; by sorting, so in n log n steps."""
    ranked = F.sort_array(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
    chosen = let(ranked, lambda r: F.filter(r, lambda x, j: stays(x["k"], (j == 0) | (F.get(r, j - 1)["k"] != x["k"]))))
    return F.transform(F.sort_array(F.transform(chosen, lambda x: x["i"])), lambda i: F.get(items, i))


def _first_of_each(lines: Column) -> Column:
    """Non-blank lines, stripped ones, whose lower-case form stood before go."""

    def of(ls: Column, keys: Column) -> Column:
        full = F.filter(keys, lambda k: k != "")
        distinct = let(full, lambda f: F.size(F.array_distinct(f)) == F.size(f))
        return F.when(distinct, ls).otherwise(_firsts(ls, keys, lambda k, first: (k == "") | first))

    return let(lines, lambda ls: let(F.transform(ls, lambda x: F.lower(x)), lambda keys: of(ls, keys)))


def _replace_if(needed: Callable[[Column], Column], pattern: str, by: str) -> Callable[[Column], Column]:
    return lambda x: F.when(needed(x), F.regexp_replace(x, pattern, by)).otherwise(x)


def _inline_rules() -> list[tuple[Callable[[Column], Column], str, str]]:
    """(what must hold of a text, pattern, replacement), in order."""
    has = lambda *parts: lambda x: reduce(Column.__or__, [F.contains(x, F.lit(p)) for p in parts])
    low = lambda *parts: lambda x: let(F.lower(x), lambda s: has(*parts)(s))
    more = r"(?iU)\s*(Read more|Baca selengkapnya)\s*[»›>…]+\s*"
    return [
        (has("://"), f"(?i){V.URL_TEXT}".replace(r"\S", NO_SPACE), ""),
        (has("@"), f"(?<!{NO_SPACE})" + V.EMAIL_TEXT.replace(r"\S", NO_SPACE), ""),
        (has("0", "62"), f"(?U){V.PHONE_TEXT}", ""),
        (has("_"), V.ICON_TEXT, ""),
        (lambda x: F.lower(F.substring(x, 1, 12)).rlike("^(?:" + V.DATELINE_CITIES.lower() + ")"), rf"(?iU)^(?:{V.DATELINE_CITIES})[\s,]*(?:{V.DATELINE_OUTLETS})\s*[-–—]\s*", ""),
        (lambda x: has("»", "›", ">", "…")(x) & low("read more", "baca selengkapnya")(x), more, " "),
        (low("leave a comment"), r"(?iU)\s*Leave a Comment\s*", " "),
        (low("posting komentar"), r"(?iU)\s*Posting Komentar\s*", " "),
    ]


def clean_for_training(text: Column, noise: Sequence[str] = V.UI_NOISE, nav: Sequence[str] = V.NAV_LIKE, errors: Sequence[str] = V.ERROR_SIGNALS, compat: bool = True) -> Column:
    """Plain text without links, addresses, menus, short and repeated lines; empty if what is left is no prose.

    The menu pattern for words run together, ``[A-Z][a-z]+[A-Z][a-z]+[A-Z]``,
    is read in any case like the others if ``compat`` holds, and so drops every
    line that begins with five ASCII letters; otherwise it minds the case.
    """
    t = given(text)
    for needed, pattern, by in _inline_rules():
        # most texts hold nothing of the kind, which shows much faster than by the pattern
        t = let(t, _replace_if(needed, pattern, by))
    camel = [p for p in nav if p.startswith("^[A-Z]")]
    minded = [V.JOINED_CAMEL, *([] if compat else [p.lstrip("^") for p in camel])]
    junk = "^(?:" + "|".join([_at_start([p for p in nav if compat or p not in camel]), _at_start(noise), *minded, f"(?U:{V.LIST_LINE})"]) + ")"

    def stays(s: Column) -> Column:
        closed = F.right(s, F.lit(1)).isin(*".!?:;\"')]")
        long = (F.char_length(s) >= 25) & has_words(s, 4)
        return (s == "") | ((closed | long) & ~s.rlike(junk))

    lines = _first_of_each(F.filter(F.transform(_lines(t), _strip), stays))
    gaps = lambda x: F.contains(x, F.lit("  ")) | F.contains(x, F.lit("\t"))
    lines = F.transform(lines, lambda x: F.when(gaps(x), stripped(F.regexp_replace(x, r"[ \t]{2,}", " "))).otherwise(x))
    result = let(lines, lambda k: stripped(F.array_join(_without_runs(k, 1), "\n")))
    return let(result, lambda r: _if_prose(r, errors))


def _if_prose(text: Column, errors: Sequence[str]) -> Column:
    def judge(full: Column) -> Column:
        n = F.size(full)
        share = F.size(F.filter(full, lambda x: has_words(x, 6))) / n
        error = (n < 10) & let(F.lower(text), lambda low: F.exists(F.array(*map(F.lit, errors)), lambda e: F.contains(low, e)))
        return F.when((n < 2) | (share < 0.35) | error, "").otherwise(text)

    return let(F.filter(_lines(text), lambda x: ~_blank(x)), judge)


def is_quality_content(text: Column, min_words: int = 50) -> Column:
    """Enough words, three marks of punctuation, and four words a sentence on average."""

    def mean(t: Column) -> Column:
        sentences = F.filter(F.transform(F.split(t, r"\."), _strip), lambda x: x != "")
        total = lambda ss: F.aggregate(ss, F.lit(0), lambda a, x: a + word_count(x))
        return let(sentences, lambda ss: F.when(F.size(ss) > 0, total(ss) / F.size(ss) >= 4).otherwise(True))

    def judge(t: Column, n: Column, dots: Column) -> Column:
        # there are dots + 1 sentences at most, and at most as many words as dots hold nothing else
        enough = F.when(n - dots >= 4 * (dots + 1), True).otherwise(mean(t))
        marks = t.rlike("[.!?,;:](?:[^.!?,;:]*+[.!?,;:]){2}")
        return (n >= min_words) & (n > 0) & marks & enough

    return let(given(text), lambda t: let(word_count(t), lambda n: let(_occurrences(t, "."), lambda dots: judge(t, n, dots))))


def extraction_quality(content: Column, title: Column | None = None, flattened: Column | None = None) -> Column:
    """A score of 0 to 1 by length, less for pages of links, more if the title occurs."""
    t = F.lower(stripped(given(title))) if title is not None else F.lit("")

    def score(n: Column, low: Column) -> Column:
        base = F.when(n >= 400, 0.95).when(n >= 250, 0.90).when(n >= 150, 0.82).when(n >= 110, 0.78).otherwise(0.60)
        links = _occurrences(low, "http") > F.greatest(F.lit(3), F.floor(n / 80))
        titled = F.when((F.char_length(t) >= 8) & F.contains(low, t), 0.02).otherwise(0.0)
        return F.least(F.greatest(base - F.when(links, 0.05).otherwise(0.0) + titled, F.lit(0.0)), F.lit(1.0))

    both = let(flat(content) if flattened is None else flattened, lambda low: let(_single_count(low), lambda n: score(n, low)))
    return F.when(given(content) == "", 0.0).otherwise(both)


def main_paragraphs(content: Column) -> Column:
    """Paragraphs once each, without short fragments; all of them if none is long enough. Ends in a line feed."""
    t = stripped(F.replace(F.replace(given(content), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n")))
    paras = F.filter(F.transform(F.split(t, rf"\n{SPACE}*\n+"), _strip), lambda x: x != "")

    def pick(p: Column) -> Column:
        keys = F.transform(p, lambda x: F.regexp_replace(F.lower(x), r"(?U)\W+", ""))
        several = _firsts(p, keys, lambda k, first: (k != "") & first)
        first = F.when(F.size(p) > 1, several).otherwise(F.filter(p, lambda x: x.rlike(r"(?U)\w")))
        kept = F.filter(first, lambda x: F.startswith(x, F.lit("#")) | (F.char_length(x) >= 80) | has_words(x, 6))
        return let(kept, lambda k: stripped(F.array_join(F.when(F.size(k) > 0, k).otherwise(p), "\n\n")))

    return let(let(paras, pick), lambda out: F.when(out != "", F.concat(out, F.lit("\n"))).otherwise(""))


def fingerprint(content: Column, flattened: Column | None = None) -> Column:
    """SHA-256 of the lower-case words joined by single spaces."""
    return F.sha2((flat(content) if flattened is None else flattened).cast("binary"), 256)


def ad_signals(content: Column, signals: Sequence[str] = V.AD_SIGNALS) -> Column:
    return relevance_score(content, signals)


def token_count(text: Column, limit: int = 200_000) -> Column:
    """Words of the first ``limit`` characters: the count where no tokenizer is at hand."""
    return word_count(F.substring(given(text), 1, limit))


def with_title(text: Column, title: Column) -> Column:
    """The title as a first paragraph if it has over 10 characters and the text's first 200 lack it."""
    t = stripped(given(title))
    new = (F.char_length(t) > 10) & ~F.contains(F.lower(F.substring(text, 1, 200)), F.lower(t))
    return F.when(new, F.concat(t, F.lit("\n\n"), text)).otherwise(text)


def clean_pdf_text(text: Column) -> Column:
    """Lines of under three characters or of digits only go; all white space becomes single spaces."""
    stays = lambda x: (F.char_length(stripped(x)) >= 3) & ~stripped(x).rlike(r"(?U)^\d+$")
    return squeezed(F.array_join(F.filter(_lines(given(text)), stays), "\n"))


def is_education_related(text: Column, title: Column | None = None, terms: Sequence[str] = V.JOURNAL_WORDS, least: int = 2) -> Column:
    both = F.concat(given(title) if title is not None else F.lit(""), F.lit(" "), given(text))
    return relevance_score(both, terms) >= least


def cleaner_lines(text: Column, noise: Sequence[str] = V.CLEANER_NOISE) -> Column:
    """Non-blank lines without captions and credits, underscores taken out, short bracketed lines dropped."""
    lines = F.filter(F.transform(_lines(given(text)), strip), lambda x: (x != "") & ~x.rlike(any_of(noise)))
    lines = F.transform(lines, lambda x: F.regexp_replace(x, "_+", ""))
    return F.filter(lines, lambda x: ~(x.rlike(r"^\(.*\)$") & (F.char_length(x) < 50)))


def cleaner_valid(text: Column, terms: Sequence[str] = V.CLEANER_WORDS, min_words: int = 30, least: int = 1) -> Column:
    return (word_count(text) >= min_words) & (relevance_score(text, terms) >= least)


def normalize_text(text: Column) -> Column:
    """Single spaces, and no characters that don't print."""
    return F.regexp_replace(squeezed(text), r"[\p{C}\p{Zl}\p{Zp}]|(?! )\p{Zs}", "")


def uptime(seconds: Column) -> Column:
    return F.format_string("%02d:%02d:%02d", F.floor(seconds / 3600), F.floor(seconds % 3600 / 60), F.floor(seconds % 60))


def utc_iso(ts: Column) -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
