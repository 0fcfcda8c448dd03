"""Near-duplicates of the pipeline: word shingles with a Jaccard similarity of ``LEAST`` or more.

Operator 4 gives the close candidates: SimHash fingerprints over five words,
joined on pigeonhole blocks and verified by Hamming distance. Two texts of
similarity 0.8 differ in about 10 of 64 bits, though, where blocks no longer
select; candidates further apart come from operator 11's min-max bands, which
miss a pair of 0.8 with a chance of 3 in a million, less above. Every link is
verified on the full shingle sets, as :mod:`corpusloom.llm.minmax` does it: keys
and blocks only say which sets meet, groups are joined by links alone, and no
group is gathered whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import minmax, simhash
from corpusloom.storage import stored

SHINGLE = 5
LEAST = 4, 5
SCHEME = minmax.Scheme(words=SHINGLE, least=LEAST, permutations=80, whole=1 << 18, fingerprints=True)


def close_fingerprints(sets: DataFrame, max_bits: int = simhash.MAX_BITS) -> DataFrame:
    """(a, b): trees over the sets (__set, __n, __fp) whose fingerprints differ in few bits, by operator 4; a fingerprint's first set stands for it."""
    named = stored(sets.where("__n > 0").select("__set", "__fp"))
    first = named.groupBy("__fp").agg(F.min("__set").alias("__first"))
    links = simhash.links(first.select("__fp"), max_bits)
    ends = links.join(first.select(F.col("__fp").alias("a"), F.col("__first").alias("__a")), "a").join(first.select(F.col("__fp").alias("b"), F.col("__first").alias("__b")), "b")
    same = named.join(first, "__fp").where(F.col("__set") != F.col("__first")).select(F.col("__first").alias("a"), F.col("__set").alias("b"))
    return ends.select(F.col("__a").alias("a"), F.col("__b").alias("b")).unionByName(same)


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scheme: minmax.Scheme = SCHEME) -> DataFrame:
    """(__b, __n) of every group of linked texts: its first row, as ``smallest`` has it, and its rows.

    Null text counts as empty; texts without words are equal to each other.
    """
    _, sets = minmax.grouped(docs, id_col, text_col, scheme, close_fingerprints)
    return sets.groupBy("__group").agg(F.min("__b").alias("__b"), F.sum("__k").alias("__n"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of linked texts, that of the smallest id (a null id only if there is no other).

    Null text counts as empty; texts without words are one group. Texts of any
    length are compared whole; of repeated rows one stays. Columns of any name
    pass unchanged. An empty table gives no rows.
    """
    return simhash.chosen(docs, groups(docs, id_col, text_col), id_col, text_col)
