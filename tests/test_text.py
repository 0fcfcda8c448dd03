import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.functions import vocabulary as V
from corpusloom.functions.fuzzy import common_length, partial_ratio, science_hits


def run(spark, f, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("t")).alias("x")).collect()]


TEXTS = ["", None, "satu", "dua kata", "a\tb\nc  d", "x\xa0y　z", " tepi ", "é" * 5 + " ñ"]


def test_words_follow_unicode_white_space(spark):
    assert run(spark, X.word_count, TEXTS) == [len((t or "").split()) for t in TEXTS]
    assert run(spark, X.squeezed, TEXTS) == [" ".join((t or "").split()) for t in TEXTS]
    assert run(spark, X.strip, TEXTS[2:]) == [t.strip() for t in TEXTS[2:]]


def test_language_share(spark):
    few, yes, no = "x " * 29, "dan " + "x " * 49, "x " * 100
    assert run(spark, X.is_language, [few, yes, no, None]) == [True, True, False, True]


def test_level_order(spark):
    assert run(spark, X.classify_level, ["kelas 3 SMP", "kelas 8", "SMK", "kelas 12", "umum", None]) == ["SD", "SMP", "SMA", "SMA", "Umum", "Umum"]


@pytest.mark.parametrize(("words", "quality"), [(0, 0.0), (109, 0.60), (110, 0.78), (150, 0.82), (250, 0.90), (400, 0.95)])
def test_quality_tiers(spark, words, quality):
    assert run(spark, X.extraction_quality, [" ".join(["w"] * words)]) == [quality]


def test_quality_of_links_and_titles(spark):
    text = "http " * 4 + "w " * 146 + "Judul Panjang"
    df = spark.createDataFrame([(text, "judul panjang")], "t string, h string")
    assert round(df.select(X.extraction_quality(F.col("t"), F.col("h"))).first()[0], 6) == round(0.82 - 0.05 + 0.02, 6)


def test_markdown_cleaning(spark):
    text = "Beranda > Edu > X\n# Judul\n\n\n\n\nIsi penting di sini.\nMasuk\nHalo\n_search_\nDua kata saja sini ya"
    assert run(spark, X.clean_markdown, [text]) == ["# Judul\n\n\nIsi penting di sini.\nDua kata saja sini ya"]


def test_plain_text(spark):
    text = "# Judul\n\n\n**tebal** dan [tautan](http://x) ![alt](y) `kode`\n```py\nhilang\n```\n|---|---|\n| a | b |\n> kutip\n1. satu\n- dua\n---"
    assert run(spark, X.plain_text, [text, "a\n```\nsisa"]) == ["Judul\n\ntebal dan tautan alt kode\na b\nkutip\nsatu\ndua", "a"]


PROSE = "guru dan murid belajar bersama di sekolah setiap hari."


def test_training_text(spark):
    line2 = "di sini ada kalimat kedua yang cukup panjang untuk lolos."
    text = f"12 {PROSE}\n12 {PROSE.upper()}\n\n\n12 {line2} surel a@b.co lihat http://x.y/z\nKelas 4\nberita | artikel | blog | galeri\n12 _icon_name_ ada kata lain yang panjang di baris ini."
    got = run(spark, X.clean_for_training, [text, PROSE, None, "   "])
    assert got[0].split("\n") == [f"12 {PROSE}", "", f"12 {line2} surel lihat", "12 ada kata lain yang panjang di baris ini."]
    assert got[1:] == ["", "", ""]


def test_compat_drops_lines_of_five_letters(spark):
    text = "Pendidikan adalah hak semua warga negara kita.\nMurid belajar bersama guru di sekolah setiap hari."
    assert run(spark, X.clean_for_training, [text]) == [""]
    assert run(spark, lambda t: X.clean_for_training(t, compat=False), [text]) == [text]


def test_error_page(spark):
    text = "kami mohon maaf karena page not found di sini.\nsilakan kembali ke halaman yang lain saja ya."
    assert run(spark, lambda t: X.clean_for_training(t, compat=False), [text]) == [""]


def test_main_paragraphs(spark):
    text = "Satu dua tiga empat lima enam.\n\nSatu, dua tiga empat LIMA enam!\n\n# T\n\npendek\r\n\r\nKalimat lain yang cukup panjang di sini juga."
    assert run(spark, X.main_paragraphs, [text, "pendek", None]) == ["Satu dua tiga empat lima enam.\n\n# T\n\nKalimat lain yang cukup panjang di sini juga.\n", "pendek\n", ""]


def test_quality_content(spark):
    good = "ini adalah kalimat yang baik, bukan? " * 20
    assert run(spark, X.is_quality_content, [good, "kata " * 60, "a. " * 60, None]) == [True, False, False, False]


def test_small_cleaners(spark):
    assert run(spark, X.clean_pdf_text, ["ab\n12345\nisi  jurnal\n 7 \nlanjut"]) == ["isi jurnal lanjut"]
    assert run(spark, lambda t: F.array_join(X.cleaner_lines(t), "|"), ["Foto 1. x\n_isi_ teks\n(kecil)\n\n" + "(" + "x" * 60 + ")"])[0].startswith("isi teks")
    assert run(spark, X.normalize_text, ["a​b \x00c  d"]) == ["ab c d"]
    assert run(spark, lambda t: X.is_education_related(t), ["guru dan siswa", "guru"]) == [True, False]


@settings(max_examples=60, deadline=None)
@given(st.text("abcd ", min_size=1, max_size=8), st.text("abcd ", max_size=14))
def test_common_length_is_the_longest_common_subsequence(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert common_length(a, b) == table[-1][-1]


@settings(max_examples=60, deadline=None)
@given(st.text("abc ", min_size=1, max_size=6), st.text("abc ", min_size=6, max_size=20))
def test_bound_loses_no_window(term, text):
    windows = [text[max(0, i) : i + len(term)] for i in range(1 - len(term), len(text))]
    best = max(200.0 * common_length(term, w) / (len(term) + len(w)) for w in windows)
    assert abs(partial_ratio(term, text) - best) < 1e-9


def test_science_hits():
    assert science_hits("Belajar  FOTOSINTESIS tumbuhan", ["fotosintesis", "fotosintesys", "gravitasi"]) == (100, [("fotosintesis", 100), ("fotosintesys", 91)])
    assert science_hits(None, V.SCIENCE_TERMS) == (0, [])


def test_fixed_patterns_compile():
    for p in [*V.UI_NOISE, *V.NAV_LIKE, *V.CLEANER_NOISE, *(p for _, p in V.LEVELS)]:
        re.compile(p)


def test_markdown_cleaning_is_idempotent_on_prose(spark):
    text = f"# Judul\n\n{PROSE}\n\n\n\n{PROSE}"
    once = run(spark, X.clean_markdown, [text])
    assert run(spark, X.clean_markdown, once) == once


def test_a_hundred_thousand_lines_in_time_of_their_number(spark):
    import time

    def taken(n):
        line = lambda i: f"kalimat nomor {i % (6 * n // 10)} yang cukup panjang di sini."
        df = spark.createDataFrame([("\n\n".join(map(line, range(n))),)], "t string")
        began = time.time()
        clean = X.clean_for_training(F.col("t"), compat=False)
        got = df.select(F.size(F.split(X.main_paragraphs(F.col("t")), "\n\n")), F.size(F.filter(F.split(clean, "\n"), lambda x: x != ""))).first()
        assert tuple(got) == (6 * n // 10, 6 * n // 10)
        return time.time() - began

    taken(100)
    assert taken(100_000) < 60 * max(1.0, taken(10_000))


ODD = [None, "", " ", "\n", "a", "a b", " a", "a ", "a  b", "a\n\nb", "a\n\n\nb", "\n\na", "a\n\n", "a b", "a b 　", "\x1ca\x85b", "a​b", "“a” – b…", "a\tb\r\nc", "İ Σ ς ſ", "é", "é ", "a . . b", "...", "a.b c..", "ab ", "1 2 3 4", "1 2 3 4 5"]


def test_short_ways_equal_plain_python(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "i int, t string")
    t = F.col("t")
    rows = df.select("t", X.stripped(X.given(t)).alias("s"), X.word_count(t).alias("n"), X.squeezed(t).alias("q"), X.words(t).alias("w"), X.has_words(t, 4).alias("h"), X.shorter(X.given(t), 3).alias("u"), X.flat(t).alias("f")).collect()
    for r in rows:
        x = r["t"] or ""
        assert (r["s"], r["n"], r["q"], r["w"]) == (x.strip(), len(x.split()), " ".join(x.split()), x.split()), repr(x)
        assert (r["h"], r["u"]) == (len(x.split()) >= 4, len(x) < 3), repr(x)
        assert len(r["f"].split(" ")) == max(1, len(x.split())), repr(x)


def test_language_is_the_share_of_listed_words(spark):
    texts = ["the cat the", "the the", "thе then other", "a.b a+b x", "The\n\nCAT", "the x y z"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    common = ["the", "a+b", "two words", ""]
    got = [r[0] for r in df.select(X.is_language(F.col("t"), common, 0.3, 2)).collect()]
    assert got == [sum(w in common for w in t.lower().split()) / len(t.split()) >= 0.3 for t in texts]


def test_sentences_of_four_words_on_average(spark):
    texts = ["one two three four five. " * 3 + ",;", "one two. three four. a, b; c", "... . . . a b c d, e", "a.b.c.d.e.f,g;h", "x " * 60 + ",,,", "four words are here. " * 2 + "a;"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")

    def plain(t):
        sentences = [s.strip() for s in t.split(".") if s.strip()]
        mean = sum(len(s.split()) for s in sentences) / len(sentences) >= 4 if sentences else True
        return len(t.split()) >= 3 and sum(t.count(c) for c in ".!?,;:") >= 3 and mean

    assert [r[0] for r in df.select(X.is_quality_content(F.col("t"), 3)).collect()] == [plain(t) for t in texts]


def test_long_words_take_no_square_of_their_length(spark):
    """A word without an address in a text with an "@" was scanned from each of its characters on."""
    df = spark.createDataFrame([("x" * 200_000 + " @ \nmail me at some.one@example.org today, please do.",)], "t string")
    start = time.monotonic()
    df.select(X.clean_for_training(F.col("t"), compat=False)).collect()
    assert time.monotonic() - start < 20


def test_levels_by_word_lists_and_other_patterns(spark):
    df = spark.createDataFrame([("a SMA b",), ("kelas 8",), ("KELAS 12",), ("asma",), ("ſd",), ("",)], "t string")
    assert [r[0] for r in df.select(X.classify_level(F.col("t"))).collect()] == ["SMA", "SMP", "SMA", "Umum", "SD", "Umum"]
    rules = [("x", r"\b(a|b)|c"), ("y", "d$")]
    assert [r[0] for r in spark.createDataFrame([("zc",), ("zd",), ("a",), ("q",)], "t string").select(X.classify_level(F.col("t"), F.lit("zd"), rules)).collect()] == ["x", "y", "x", "y"]
