import random
import time

from pyspark.sql import functions as F

from corpusloom.functions import automaton
from corpusloom.functions.text import keywords_found

TERMS = ["he", "she", "hers", "his", "S", "ÉLAN", "élan", "a b", "", "he", "ushers", "\n", "日本", "İ", "xyz" * 30, "q1", "q2", "q3"]
TEXTS = ["ushers", "SHE said a  b", "élan vital", None, "", "日本語", "İstanbul", "his\nhers", "xyz" * 31, "nothing"]


def test_equals_contains_with_overlapping_and_nested_terms(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    plain = keywords_found(F.col("t"), TERMS)
    for chars in (automaton.CHARS, 12):
        rows = df.select(plain.alias("a"), automaton.matcher(TERMS, chars=chars)(F.col("t")).alias("b")).collect()
        assert all(r["a"] == r["b"] for r in rows) and rows[0]["b"] == ["he", "she", "hers", "S", "", "he", "ushers"]
    assert all(r[0] == r[1] for r in df.select(plain, automaton.matcher(TERMS, few=99)(F.col("t"))).collect())


def test_parts_hold_what_they_may():
    assert automaton.parts(["aa", "b", "cccc", "d", "e"], 3) == [[0, 1], [2], [3, 4]]
    assert automaton.parts([]) == []


def test_time_hardly_grows_with_the_number_of_terms():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(5, 12)))
    text, terms = " ".join(word() for _ in range(100_000)), [word() for _ in range(10_000)]

    def taken(n):
        known = automaton.automaton(terms[:n])
        began = time.perf_counter()
        sum(1 for _ in known.iter(text))
        return time.perf_counter() - began

    taken(100)
    assert min(taken(10_000) for _ in range(3)) < 12 * min(taken(100) for _ in range(3)) + 0.1
