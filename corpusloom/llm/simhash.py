"""SimHash near-dedup: pigeonhole blocks, a join on blocks, Hamming verification.

Two fingerprints that differ in at most d bits agree on at least m - d of m
blocks. With m = 6 and d = 4 every close pair agrees on some 2 of 6 blocks, so
each of the 15 pairs of blocks is a key of about 21 bits, and rows that share a
key are compared. More fingerprints take more blocks, so that keys are longer
and few unlike rows share one: 7 blocks give 35 keys of 27 bits, 8 give 70 of
32; the links are the same. Work is on distinct fingerprints, so copies cost
one row.

A key's rows are never gathered whole: a key of more than ``chunk``
fingerprints is dealt into chunks, and each pair of chunks is a cell of its
own, of about two chunks at most. Inside a cell a breadth-first search over
exact Hamming distances gives a spanning forest of the cell's links (at most
one edge a row), which keeps every connection without emitting all pairs.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import boxed, field
from corpusloom.llm.components import connected_components
from corpusloom.storage import stored

SEED = 42
SHINGLE = 4
MAX_BITS = 4
#: Blocks, and the fingerprints up to which so many do: 64 a key on average.
BLOCKS = ((6, 1 << 27), (7, 1 << 33), (8, 1 << 62))
CHUNK = 2048
HOT_SHARE = 1024
#: Keys of this size or less are compared by shifted arrays, many keys at once.
SMALL = 64
#: Shingles that are hashed at once: 255 rows of bits add up in a byte.
STRIDE = 255 * 128


def _bit_counts(h: np.ndarray) -> np.ndarray:
    h = np.concatenate([h, np.zeros(-len(h) % 255, np.uint64)])
    bits = np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 255, 64)
    return np.add.reduce(bits, axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)


def fingerprint(text: bytes, words: int = SHINGLE) -> int:
    """The 64-bit SimHash of a whole text, unsigned; 0 for a text without words."""
    found = text.lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= words:
        return xxhash.xxh64_intdigest(joined, SEED)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(sizes + 1) - 1
    starts, ends = (ends - sizes)[: len(found) - words + 1], ends[words - 1 :]
    counts, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for i in range(0, len(starts), STRIDE):
        part = [digest(joined[a:b], SEED) for a, b in zip(starts[i : i + STRIDE].tolist(), ends[i : i + STRIDE].tolist(), strict=True)]
        counts += _bit_counts(np.array(part, np.uint64))
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(__id, __th, __fp) of every row; ``__th`` is a hash of the text."""
    rows = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    rows = rows.select("__id", F.xxhash64("__text").alias("__th"), F.col("__text").cast("binary").alias("__text"))

    def run(batches):
        for b in batches:
            known: dict[int, int] = {}  # equal texts of a batch are hashed once
            out = []
            for th, text in zip(b.column(1).to_pylist(), b.column(2), strict=True):
                if th not in known:
                    known[th] = fingerprint(text.as_py())
                out.append(known[th])
            fp = np.array(out, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp)], names=["__id", "__th", "__fp"])

    kind = dict(docs.dtypes)[id_col]
    return rows.mapInArrow(run, f"__id {kind}, __th bigint, __fp bigint")


def _block_keys(fp: Column, blocks: int, max_bits: int) -> Column:
    """An array of longs: the value of each choice of blocks that must agree for some close pair."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    if comb(blocks, max_bits) > 127 or 64 - 64 * max_bits // blocks > 56:
        raise ValueError("too many choices of blocks")
    part = [F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(edges, edges[1:], strict=False)]
    keys = []
    for n, chosen in enumerate(combinations(range(blocks), blocks - max_bits)):
        k = F.lit(0).cast("long")
        for i in chosen:
            k = F.shiftleft(k, edges[i + 1] - edges[i]).bitwiseOR(part[i])
        keys.append(k.bitwiseOR(F.lit(n << 56)))  # below it are the chosen blocks' bits, 56 at most
    return F.array(*keys)


def _forest(fp: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """A spanning forest of the links among ``fp``, by search over the rows not yet reached."""
    left, out = np.unique(fp), []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(left ^ x) <= max_bits
            if near.any():
                found = left[near]
                out.append((np.full(len(found), x), found))
                queue.extend(found.tolist())
                left = left[~near]
    return out


def _close(key: np.ndarray, fp: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links inside each run of equal keys (key: one row per key column)."""
    new = np.flatnonzero(np.any(key[:, 1:] != key[:, :-1], axis=0)) + 1
    starts = np.concatenate([[0], new])
    sizes = np.diff(np.concatenate([starts, [key.shape[1]]]))
    out = []
    for i in np.flatnonzero(sizes > SMALL):
        out += _forest(fp[starts[i] : starts[i] + sizes[i]], max_bits)
    end = np.repeat(starts + sizes, sizes)
    at = np.flatnonzero(np.repeat(sizes <= SMALL, sizes))
    for s in range(1, SMALL):
        at = at[at + s < end[at]]
        if not len(at):
            break
        ok = np.bitwise_count(fp[at] ^ fp[at + s]) <= max_bits
        out.append((fp[at[ok]], fp[at[ok] + s]))
    return out


def links(distinct: DataFrame, max_bits: int = MAX_BITS, blocks: int | None = None, chunk: int = CHUNK) -> DataFrame:
    """Edges (a, b) that connect exactly what links of ``max_bits`` or fewer connect; ``distinct``: (__fp).

    ``blocks`` follows from the number of fingerprints if it is not given.
    """
    if blocks is None:
        n = distinct.count()
        blocks = next(b for b, most in BLOCKS if n <= most)
    rows = distinct.select(F.col("__fp"), F.explode(_block_keys(F.col("__fp"), blocks, max_bits)).alias("__k"))
    rows = stored(rows)
    big = stored(rows.groupBy("__k").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > chunk).select("__k", F.ceil(F.col("__n") / chunk).cast("int").alias("__g")))
    if big.isEmpty():
        cells = rows.withColumn("__cell", F.lit(0).cast("long"))
    else:  # the join's strategy follows the measured size of big
        rows = rows.join(big, "__k", "left").withColumn("__c", F.pmod(F.xxhash64("__fp"), F.col("__g")))
        pair = F.transform(F.sequence(F.lit(0), F.col("__g") - 1), lambda o: F.least(o, F.col("__c")) * F.col("__g") + F.greatest(o, F.col("__c")))
        cells = rows.select("__fp", "__k", F.explode(F.when(F.col("__g").isNull(), F.array(F.lit(0).cast("long"))).otherwise(pair)).alias("__cell"))
    cells = cells.select("__k", "__cell", "__fp").repartition("__k", "__cell").sortWithinPartitions("__k", "__cell")

    def run(batches):
        carry = np.empty((3, 0), np.int64)

        def edges(of):
            found = _close(of[:2], of[2].view(np.uint64), max_bits)
            a = np.concatenate([x for x, _ in found] or [np.empty(0, np.uint64)])
            b = np.concatenate([x for _, x in found] or [np.empty(0, np.uint64)])
            return pa.RecordBatch.from_arrays([pa.array(a.astype(np.uint64).view(np.int64)), pa.array(b.astype(np.uint64).view(np.int64))], names=["a", "b"])

        for batch in batches:
            carry = np.concatenate([carry, np.stack([np.asarray(c) for c in batch.columns])], axis=1)
            change = np.flatnonzero(np.any(carry[:2, 1:] != carry[:2, :-1], axis=0))
            if len(change):
                cut = change[-1] + 1
                yield edges(np.ascontiguousarray(carry[:, :cut]))
                carry = carry[:, cut:]
        if carry.shape[1]:
            yield edges(np.ascontiguousarray(carry))

    return cells.mapInArrow(run, "a bigint, b bigint").distinct()


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """(__id, __th, __fp, __group, __component) of every row.

    ``__group`` tells components apart, those of rows with null ids included.

    ``__component`` is the smallest id reachable over links. Null text counts
    as empty; texts without words share fingerprint zero and link like any
    other. A row with a null id takes part in links; a component of such rows
    only has a null name. Repeated rows come back repeated. Texts of any length
    count whole; columns beside the two don't matter. An empty table gives no
    rows.
    """
    rows = stored(fingerprints(docs, id_col, text_col))
    distinct = stored(rows.groupBy("__fp").agg(F.min("__id").alias("__min"), F.count(F.lit(1)).alias("__n")))
    roots = connected_components(links(distinct.select("__fp"), max_bits))
    named = roots.join(distinct, roots["node"] == distinct["__fp"])
    named = named.groupBy("root").agg(F.min("__min").alias("__component"))
    named = roots.join(named, "root").select(F.col("node").alias("__fp"), F.col("root").alias("__group"), "__component")
    all_fp = distinct.join(named, "__fp", "left").select("__fp", "__n", F.coalesce("__group", F.xxhash64("__fp")).alias("__group"), F.coalesce("__component", "__min").alias("__component"))
    all_fp = stored(all_fp)
    # fingerprints of over 1/HOT_SHARE of all rows, HOT_SHARE at most, are broadcast: no task gathers their rows
    hot = F.broadcast(all_fp.where(F.col("__n") > max(64, rows.count() // HOT_SHARE)).drop("__n"))
    cold = rows.join(hot.select("__fp"), "__fp", "left_anti").join(all_fp.drop("__n"), "__fp")
    cols = ["__id", "__th", "__fp", "__group", "__component"]
    return cold.select(*cols).unionByName(rows.join(hot, "__fp").select(*cols))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id (a null id only if there is no other).

    Columns of any name pass unchanged. Other cases as in :func:`components`.
    """
    rows = components(docs, id_col, text_col, max_bits)
    return chosen(docs, rows.groupBy("__group").agg(smallest().alias("__b"), F.count(F.lit(1)).alias("__n")), id_col, text_col)


def smallest() -> Column:
    """Of rows (__id, __th) the first: smallest id, null last."""
    return F.min(F.struct(F.col("__id").isNull().alias("n"), F.col("__id").alias("i"), F.col("__th").alias("t")))


def chosen(docs: DataFrame, best: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` that ``best`` (__b: what ``smallest`` gave, __n: rows of its group) names, once each.

    Of rows with one id and one text the first by their JSON stays, so reruns agree.
    """
    best = best.select(F.col("__b.i").alias("__id"), F.col("__b.t").alias("__th"), (F.col("__n") > 1).alias("__many"))
    both = boxed(docs).withColumn("__t", F.xxhash64(F.coalesce(field(text_col), F.lit(""))))
    both = both.join(best, field(id_col).eqNullSafe(best["__id"]) & (both["__t"] == best["__th"]))
    # rows with one id and one text could both be the chosen one, in groups of several rows only
    many = both.where("__many").withColumn("__json", F.to_json("__row", {"ignoreNullFields": "false"}))
    many = many.groupBy("__id", "__t").agg(F.min_by("__row", "__json").alias("__row"))
    return both.where(~F.col("__many")).select("__row").unionByName(many.select("__row")).select("__row.*")


def query(docs: DataFrame) -> DataFrame:
    hex_fp = F.lower(F.lpad(F.hex("__fp"), 16, "0"))
    return components(docs).select(F.col("__id").alias("doc_id"), hex_fp.alias("fingerprint"), F.col("__component").alias("component_id"))
