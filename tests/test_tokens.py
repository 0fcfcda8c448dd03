import random

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import tokens
from corpusloom.functions.text import token_count
from corpusloom.operators.sinks import run_counters
from corpusloom.queries import ranks_path

tiktoken = pytest.importorskip("tiktoken")
pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def ranks():
    return tokens.read_ranks(ranks_path())


@pytest.fixture(scope="module")
def installed(ranks):
    return tiktoken.Encoding("installed", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_every_text_as_the_installed_tokenizer_counts_it(spark, installed):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    odd = [None, "", " ", "a  b", "don't\n\n  go", "日本語 é 🙂", "<|endoftext|>", "x" * 5000, "ab" * 3000 + " 12345"]
    rows = docs.select("text").unionByName(spark.createDataFrame([(t,) for t in odd], "text string"))
    got = rows.select("text", tokens.counter(ranks_path())(F.col("text")).alias("n")).collect()
    assert len(got) > 1000 and all(r["n"] == len(installed.encode_ordinary(r["text"] or "")) for r in got)


def test_both_ways_of_merging_agree(ranks, installed):
    rng = random.Random(4)
    for _ in range(500):
        word = bytes(rng.choice(b"abethoins g\xc3\xa9\xf0") for _ in range(rng.randint(1, 120)))
        parts = tokens._by_heap(word, ranks)
        assert parts == tokens._by_search(word, ranks) and b"".join(parts) == word
    letters = "".join(rng.choice("aehinst") for _ in range(300))
    assert [ranks[p] for p in tokens.merged(letters.encode(), ranks)] == installed.encode_ordinary(letters)


def test_long_words_take_time_in_proportion(ranks):
    import time

    def taken(n):
        began = time.time()
        tokens.merged(b"ab" * n, ranks)
        return time.time() - began

    taken(1000)
    assert taken(100_000) < 60 * max(taken(10_000), 0.01)


def test_no_model_and_no_file(spark):
    rows = spark.createDataFrame([("satu dua  tiga",), (None,)], "t string")
    none, lost = tokens.counter(""), tokens.counter("/nowhere/ranks")
    assert [tuple(r) for r in rows.select(none(F.col("t")), lost(F.col("t"))).collect()] == [(0, 3), (0, 0)]


def test_run_counters_sum_tokens_of_accepted_pages(spark, installed):
    rows = spark.createDataFrame([(None, "satu dua tiga"), ("too_short_raw", "empat lima"), (None, None)], "reject_reason string, main string")
    assert run_counters(rows, tokens.counter(ranks_path())).first()["tokens"] == len(installed.encode_ordinary("satu dua tiga"))
    assert run_counters(rows, token_count).first()["tokens"] == 3


def test_only_the_first_characters_count(spark, monkeypatch):
    monkeypatch.setattr(tokens, "LIMIT", 10)
    assert spark.createDataFrame([("satu dua " * 9,)], "t string").select(tokens.counter(ranks_path())(F.col("t"))).first()[0] == len(tiktoken.Encoding("x", pat_str=tokens.PATTERN, mergeable_ranks=tokens.read_ranks(ranks_path()), special_tokens={}).encode_ordinary(("satu dua " * 9)[:10]))
