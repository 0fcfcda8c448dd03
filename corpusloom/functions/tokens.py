"""Numbers of byte-pair tokens.

A text falls into pre-tokens; the bytes of each are merged in pairs, the pair of
the lowest rank first, until no pair has a rank. A batch's distinct pre-tokens
are merged once, and the latest are remembered. The ranks are those of a file,
one base64 token and its rank a line, read on the driver; a vocabulary's fixed
size bounds what is sent to the tasks.
"""

from __future__ import annotations

import base64
import heapq
import logging
from collections.abc import Callable

import pandas as pd
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import given, token_count

#: How the vocabulary splits texts; a fixed value of its format.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of a text that count.
LIMIT = 200_000
#: Pre-tokens of more bytes are merged by a heap; pre-tokens, of this length at most, that a task remembers.
LONG, KNOWN = 64, 500_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merged(word: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The tokens of a pre-token; of equal ranks the first pair is merged first."""
    if word in ranks:
        return [word]
    return _by_heap(word, ranks) if len(word) > LONG else _by_search(word, ranks)


def _by_search(word: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    parts = [word[i : i + 1] for i in range(len(word))]
    while len(parts) > 1:
        rank, at = min((ranks.get(a + b, 1 << 62), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
        if rank == 1 << 62:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


def _by_heap(word: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """In time of n log n: pairs wait in a heap, and one whose parts have changed since is passed over."""
    n = len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that begins at a place, 0 for none
    waiting = []

    def offer(i: int) -> None:
        j = end[i]
        if j < n and (rank := ranks.get(word[i : end[j]])) is not None:
            heapq.heappush(waiting, (rank, i, j, end[j]))

    for i in range(n):
        offer(i)
    while waiting:
        _, i, j, k = heapq.heappop(waiting)
        if end[i] != j or end[j] != k:
            continue
        end[i], end[j] = k, 0
        if k < n:
            before[k] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    out, i = [], 0
    while i < n:
        out.append(word[i : end[i]])
        i = end[i]
    return out


def counter(path: str | None) -> Callable[[Column], Column]:
    """A function of a text column to its number of tokens by the ranks of ``path``, of the first ``LIMIT`` characters; null and empty texts have none.

    Without a path every text has 0 tokens; if the file can't be read, words are counted.
    """
    if not path:
        return lambda text: F.lit(0).cast("long")
    try:
        ranks = read_ranks(path)
    except (OSError, ValueError) as error:
        logging.getLogger(__name__).warning("no ranks at %s, words are counted: %s", path, error)
        return lambda text: token_count(text).cast("long")
    shared = SparkSession.active().sparkContext.broadcast(ranks)
    split = regex.compile(PATTERN)

    @F.pandas_udf("long")
    def count(batches: pd.Series) -> pd.Series:
        known = count_known.setdefault("words", {})
        out = []
        for text in batches:
            n = 0
            for word in split.findall(text[:LIMIT]):
                m = known.get(word)
                if m is None:
                    m = len(merged(word.encode(), shared.value))
                    if len(word) <= LONG:
                        known[word] = m
                n += m
            out.append(n)
            if len(known) > KNOWN:
                known.clear()
        return pd.Series(out, dtype="int64")

    count_known: dict[str, dict[str, int]] = {}
    return lambda text: count(given(text))
