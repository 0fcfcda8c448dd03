"""Many terms at once: an Aho-Corasick automaton goes over a text once, however many terms there are."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import given, keywords_found

#: Up to so many terms are looked for one by one, by an expression.
FEW = 16
#: Characters of terms of one automaton, about 100 bytes of a task's memory each.
CHARS = 2_000_000


def parts(terms: Sequence[str], chars: int = CHARS) -> list[list[int]]:
    """Places of terms, in order, by automata of ``chars`` characters (a longer term has its own)."""
    out: list[list[int]] = []
    held = chars + 1
    for i, term in enumerate(terms):
        held += len(term)
        if held > chars:
            out.append([])
            held = len(term)
        out[-1].append(i)
    return out


def automaton(terms: Sequence[str]):
    """Over terms with the places that each has; an empty term is in every text and in no automaton."""
    import ahocorasick

    out = ahocorasick.Automaton()
    for i, term in enumerate(terms):
        if term:
            out.add_word(term, (*out.get(term, ()), i))
    if len(out):
        out.make_automaton()
    return out


def matcher(terms: Sequence[str], few: int = FEW, chars: int = CHARS) -> Callable[[Column], Column]:
    """A function of a text column to the ``terms`` that it contains, any case, in the list's order; overlapping and nested ones too.

    The same as :func:`corpusloom.functions.text.keywords_found`, which looks
    for each term by itself; repeated terms come repeated, null texts count as
    empty. Terms are sent to the tasks; beyond ``chars`` characters there are
    several automata, none of which is larger, and one more pass for each.
    """
    terms = list(terms)
    if len(terms) <= few:
        return lambda text: keywords_found(text, terms)
    spark = SparkSession.active()
    low = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(terms)], "i long, t string").orderBy("i").select(F.lower("t")).collect()]

    def one(places: list[int]) -> Callable[[Column], Column]:
        shared = spark.sparkContext.broadcast([(low[i], terms[i]) for i in places])

        @F.pandas_udf("array<string>")
        def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            known, names = automaton([a for a, _ in shared.value]), [b for _, b in shared.value]
            always = {i for i, (a, _) in enumerate(shared.value) if not a}
            for texts in batches:
                out = []
                for text in texts:
                    hit = set(always)
                    if len(known):
                        for _, at in known.iter(text):
                            hit.update(at)
                    out.append([names[i] for i in sorted(hit)])
                yield pd.Series(out)

        return find

    every = [one(p) for p in parts(low, chars)]
    return lambda text: F.concat(*[f(F.lower(given(text))) for f in every])
