"""Min-max hashing: near-duplicates by the sets of word shingles that texts share.

Each of ``permutations`` seeded permutations is evaluated once a shingle, and
both its least and its greatest value are kept: two values an evaluation, each
of which agrees for two sets with a chance of their Jaccard similarity s. Bands
of ``rows`` values are the keys of candidates; the values of one band come from
different permutations, so a pair of similarity s shares no key with a chance of
(1 - s ** rows) ** bands: 2 in 10 million at 0.85 with the defaults.

No pair is taken for a link unverified, and pairs are never listed:

1. Sets that share a key are a cell. Keys with equal members (found by xor of
   the members' hashes) are one cell. A search inside the cell follows pairs
   whose signatures agree in ``cut`` values or more, six standard deviations
   below what a true link has on average, and gives a tree, an edge a set at most.
2. The trees' components are candidate groups. Unlike sets that meet in a key by
   chance fall apart here, so groups don't grow with the corpus.
3. Each set is sent once to its group, where a search over exact intersections of
   the full sets gives trees of verified links, whose components are the result.

Cells of over ``chunk`` sets and groups of over ``weight`` shingles are dealt
into chunks, and each pair of chunks is a cell of its own; no task gathers more.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.components import connected_components
from corpusloom.llm.simhash import fingerprint, smallest
from corpusloom.storage import stored

SEED = 42
#: Shingles that are hashed by all permutations at once.
STRIDE = 1 << 14
#: Sets of over 1/HOT_SHARE of all rows are broadcast by name, HOT_SHARE at most.
HOT_SHARE = 1024


@dataclass(frozen=True)
class Scheme:
    """What is a link (``least``: a fraction of whole numbers), and how candidates are found."""

    words: int = 3
    least: tuple[int, int] = (85, 100)
    permutations: int = 65
    rows: int = 5
    chunk: int = 2048
    weight: int = 1 << 19
    #: Edges that one task may join (:func:`corpusloom.llm.components.connected_components`).
    whole: int = 0
    #: Whether rows get a SimHash fingerprint over as many words, too.
    fingerprints: bool = False

    @cached_property
    def bands(self) -> int:
        return 2 * (self.permutations // self.rows)

    @cached_property
    def cut(self) -> int:
        """Agreeing values, of two a permutation, under which a pair is no candidate."""
        s, n = self.least[0] / self.least[1], 2 * self.permutations
        return max(0, int(n * s - 6 * (n * s * (1 - s)) ** 0.5))

    @cached_property
    def seeds(self) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng(7)
        xor = rng.integers(0, 1 << 64, self.permutations, np.uint64)
        return xor, rng.integers(0, 1 << 64, self.permutations, np.uint64) | np.uint64(1)

    def extremes(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and the greatest value of a set under each permutation."""
        xor, mul = self.seeds
        low, high = np.full(self.permutations, (1 << 64) - 1, np.uint64), np.zeros(self.permutations, np.uint64)
        for i in range(0, len(found), STRIDE):
            part = found[i : i + STRIDE]
            for k in range(self.permutations):
                at = (part ^ xor[k]) * mul[k]
                low[k], high[k] = min(low[k], at.min()), max(high[k], at.max())
        return low, high

    def described(self, found: np.ndarray) -> tuple[bytes, np.ndarray]:
        """A byte of each extreme, and a key (long) for each band; its number is part of what is hashed."""
        low, high = self.extremes(found)
        used = self.permutations // self.rows * self.rows
        bands = np.concatenate([low[:used], high[:used]]).reshape(-1, self.rows)
        keys = np.array([xxhash.xxh64_intdigest(b.tobytes(), k) for k, b in enumerate(bands)], np.uint64)
        both = np.concatenate([low, high])
        return ((both * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)).astype(np.uint8).tobytes(), keys.view(np.int64)

    def comparable(self, n: int, sizes: np.ndarray) -> np.ndarray:
        """Whether sets of these sizes can be links at all."""
        p, q = self.least
        return (sizes * q >= n * p) & (n * q >= sizes * p)

    def alike(self, a: int, b: int, common: int) -> bool:
        """Whether sets of a and b members with so many in common are a link."""
        return common * self.least[1] >= self.least[0] * (a + b - common)


def shingles(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct hashes of a text's runs of words; of a shorter text, that of the whole; of one without words, none."""
    found = text.lower().split()
    if not found:
        return np.empty(0, np.uint64)
    joined, digest = b" ".join(found), xxhash.xxh64_intdigest
    if len(found) <= words:
        return np.array([digest(joined, SEED)], np.uint64)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(sizes + 1) - 1
    starts, ends = (ends - sizes)[: len(found) - words + 1], ends[words - 1 :]
    return np.unique(np.array([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], np.uint64))


def described(docs: DataFrame, id_col: str, text_col: str, scheme: Scheme) -> DataFrame:
    """(__id, __th, __set, __n, __sig, __keys, __fp) of every row: hash of the text, name and size of its set, signature, band keys, SimHash or 0."""
    rows = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    rows = rows.select("__id", F.xxhash64("__text").alias("__th"), F.col("__text").cast("binary").alias("__text"))

    def run(batches):
        for b in batches:
            known: dict[int, tuple] = {}  # equal texts of a batch are hashed once
            for th, text in zip(b.column(1).to_pylist(), b.column(2), strict=True):
                if th not in known:
                    s = shingles(text.as_py(), scheme.words)
                    name = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED)], np.uint64).view(np.int64)[0]
                    fp = np.array([fingerprint(text.as_py(), scheme.words) if scheme.fingerprints else 0], np.uint64).view(np.int64)[0]
                    known[th] = (int(name), len(s), *(scheme.described(s) if len(s) else (b"", np.empty(0, np.int64))), int(fp))
            of = [known[th] for th in b.column(1).to_pylist()]
            kinds = pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.int64()
            cols = [pa.array([x[i] for x in of], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols], names=["__id", "__th", "__set", "__n", "__sig", "__keys", "__fp"])

    kind = dict(docs.dtypes)[id_col]
    return rows.mapInArrow(run, f"__id {kind}, __th bigint, __set bigint, __n bigint, __sig binary, __keys array<bigint>, __fp bigint")


def trees(names: np.ndarray, near) -> list[tuple[int, int]]:
    """(first, other) for each edge of the trees that a search over rows not yet reached finds; near(x, left): which of ``left`` x links."""
    left, out = np.arange(len(names)), []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            hit = near(x, left)
            out += [(int(names[x]), int(names[y])) for y in left[hit]]
            queue.extend(left[hit].tolist())
            left = left[~hit]
    return out


def _agreeing(scheme: Scheme, sizes: np.ndarray, signs: np.ndarray):
    def near(x, left):
        hit = scheme.comparable(sizes[x], sizes[left])
        hit[hit] = (signs[left[hit]] == signs[x]).sum(axis=1) >= scheme.cut
        return hit

    return near


def _linked(scheme: Scheme, sizes: np.ndarray, signs: np.ndarray, sets: list[np.ndarray]):
    agree = _agreeing(scheme, sizes, signs)

    def near(x, left):
        hit, of = agree(x, left), sets[x]
        for i in np.flatnonzero(hit):
            y = sets[left[i]]
            pos = np.minimum(np.searchsorted(of, y), len(of) - 1)
            hit[i] = scheme.alike(len(of), len(y), int((of[pos] == y).sum()))
        return hit

    return near


def _runs(batches, found):
    """Edges of each run of rows with equal first two columns; found(rows) gives those of one."""
    now, rows = None, []
    batch = lambda e: pa.RecordBatch.from_arrays([pa.array([x[i] for x in e], pa.int64()) for i in (0, 1)], names=["a", "b"])
    for b in batches:
        out = []
        for *key, rest in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), zip(*(c.to_pylist() for c in b.columns[2:]), strict=True), strict=True):
            if key != now:
                out += found(rows) if len(rows) > 1 else []
                now, rows = key, []
            rows.append(rest)
        yield batch(out)
    yield batch(found(rows) if len(rows) > 1 else [])


def _dealt(rows: DataFrame, key: str, chunks: Column) -> DataFrame:
    """``rows`` with __cell: -1, or where there are several chunks one row for each pair of chunks that a row is in; dealt by key and cell."""
    rows = rows.withColumn("__g", chunks).withColumn("__c", F.pmod(F.xxhash64("__set"), F.col("__g")))
    pair = F.transform(F.sequence(F.lit(0), F.col("__g") - 1), lambda o: F.least(o, F.col("__c")) * F.col("__g") + F.greatest(o, F.col("__c")))
    cell = F.explode(F.when(F.col("__g") == 1, F.array(F.lit(-1).cast("long"))).otherwise(pair))
    return rows.withColumn("__cell", cell).drop("__g", "__c").repartition(key, "__cell").sortWithinPartitions(key, "__cell")


def candidates(sets: DataFrame, scheme: Scheme) -> DataFrame:
    """(a, b): trees over the sets (__set, __n, __sig, __keys) whose signatures agree and that share a key."""
    keyed = stored(sets.select("__set", F.explode("__keys").alias("__key")))
    members = [F.bit_xor(F.xxhash64("__set")).alias("__x"), F.bit_xor(F.xxhash64("__set", F.lit(1))).alias("__y")]
    cells = keyed.groupBy("__key").agg(F.count(F.lit(1)).alias("__k"), *members).where("__k > 1")
    cells = cells.groupBy("__k", "__x", "__y").agg(F.min("__key").alias("__key")).select("__key", "__k")
    rows = keyed.join(cells, "__key").join(sets.select("__set", "__n", "__sig"), "__set")
    rows = _dealt(rows, "__key", F.ceil(F.col("__k") / scheme.chunk)).select("__key", "__cell", "__set", "__n", "__sig")

    def found(of):
        names, at = np.unique([x[0] for x in of], return_index=True)
        signs = np.stack([np.frombuffer(of[i][2], np.uint8) for i in at])
        return trees(names, _agreeing(scheme, np.array([of[i][1] for i in at]), signs))

    return rows.mapInArrow(lambda batches: _runs(batches, found), "a bigint, b bigint").distinct()


def verified(members: DataFrame, scheme: Scheme) -> DataFrame:
    """(a, b): trees of the links, by full sets, inside candidate groups; ``members``: (__root, __w, __set, __sig, __text), __w: the group's shingles."""
    rows = _dealt(members, "__root", F.ceil(F.col("__w") / scheme.weight)).select("__root", "__cell", "__set", "__sig", "__text")

    def found(of):
        names, at = np.unique([x[0] for x in of], return_index=True)
        sets = [shingles(of[i][2], scheme.words) for i in at]
        signs = np.stack([np.frombuffer(of[i][1], np.uint8) for i in at])
        return trees(names, _linked(scheme, np.array([len(s) for s in sets]), signs, sets))

    return rows.mapInArrow(lambda batches: _runs(batches, found), "a bigint, b bigint").distinct()


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scheme: Scheme = Scheme(), more: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows (__id, __th, __set, __n), and sets (__set, __b, __k, __n, __group): first row as ``smallest`` has it, rows, size, group of linked sets.

    ``more`` gives further candidates (a, b) among the sets (__set, __n, __fp).
    """
    rows = stored(described(docs, id_col, text_col, scheme))
    sets = stored(rows.groupBy("__set").agg(smallest().alias("__b"), F.count(F.lit(1)).alias("__k"), F.min("__n").alias("__n"), F.min("__sig").alias("__sig"), F.min("__keys").alias("__keys"), F.min("__fp").alias("__fp")))
    edges = candidates(sets, scheme)
    edges = stored(edges if more is None else edges.unionByName(more(sets.select("__set", "__n", "__fp"))))
    roots = connected_components(edges, scheme.whole).select(F.col("node").alias("__set"), F.col("root").alias("__root"))
    named = stored(sets.join(roots, "__set").select("__root", "__set", "__n", "__sig", F.col("__b.i").alias("__id"), F.col("__b.t").alias("__th")))
    named = named.join(named.groupBy("__root").agg(F.sum("__n").alias("__w")), "__root")
    texts = docs.select(F.col(id_col).alias("__i"), F.coalesce(F.col(text_col), F.lit("")).alias("__text")).withColumn("__t", F.xxhash64("__text"))
    members = texts.join(named, texts["__i"].eqNullSafe(named["__id"]) & (texts["__t"] == named["__th"]))
    members = members.select("__root", "__w", "__set", "__sig", F.col("__text").cast("binary").alias("__text"))
    links = connected_components(stored(verified(members, scheme)), scheme.whole).select(F.col("node").alias("__set"), "root")
    sets = sets.join(links, "__set", "left").select("__set", "__b", "__k", "__n", F.coalesce("root", F.xxhash64("__set")).alias("__group"))
    return rows.select("__id", "__th", "__set", "__n"), sets


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scheme: Scheme = Scheme()) -> DataFrame:
    """(__id, __n, __component) of every row: its set's size and the smallest id reachable over links, its own included.

    Null text counts as empty; a row without words has an empty set, is linked
    with nothing and is its own component, as is one whose component holds null
    ids only: that has a null name. A row with a null id takes part in links.
    Equal sets are linked whatever the texts' spacing. Repeated rows come back
    repeated, rows with one id are rows of their own. Texts of any length count
    whole; columns beside the two don't matter. An empty table gives no rows.
    """
    rows, sets = grouped(docs, id_col, text_col, scheme)
    least = sets.groupBy("__group").agg(F.min("__b.i").alias("__component"))
    named = stored(sets.join(least, "__group").select("__set", "__k", "__component"))
    # sets of over 1/HOT_SHARE of all rows, HOT_SHARE at most, are broadcast: no task gathers their rows
    hot = F.broadcast(named.where(F.col("__k") > F.lit(max(64, rows.count() // HOT_SHARE))))
    cold = rows.join(hot.select("__set"), "__set", "left_anti").join(named, "__set")
    both = cold.unionByName(rows.join(hot, "__set"))
    return both.select("__id", "__n", F.when(F.col("__n") == 0, F.col("__id")).otherwise(F.col("__component")).alias("__component"))


def query(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document, at 3 words and 0.85; odd rows as in :func:`components`."""
    rows = components(docs)
    return rows.select(
        F.col("__id").alias("doc_id"),
        F.col("__n").alias("n_shingles"),
        F.col("__component").alias("component_id"),
        F.col("__id").eqNullSafe(F.col("__component")).alias("kept"),
    )
