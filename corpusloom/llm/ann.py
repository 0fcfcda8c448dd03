"""Approximate nearest neighbours by a forest of random-projection trees.

Trees are fitted on a bounded, seeded sample (``SAMPLE`` distinct vectors, and
``SAMPLE_BYTES`` of them, at most). All nodes of a tree's level split along one
direction, the difference of two sampled vectors, at the median of the node's
sampled vectors. Below the levels that the sample fills, ``TURNS`` directions
take turns, and cuts are normal quantiles of the vectors of the nearest node
that the sample fills. So a tree has any depth that the table asks for, while
the model stays small. Every distinct vector is indexed in one leaf of each tree.

A query walks all trees through one shared priority queue: a branch's priority
is the chance that a neighbour lies in it, given the query's distances from the
cuts on the way. How neighbours scatter around a query along each direction is
learned from the sample. Candidates are scored exactly in their leaves.

How many rows a query scores is measured, not set: the fewest with which
queries out of the sample find ``RECALL`` of their neighbours in the sample.
For a larger table, that number and the neighbours' nearness go on growing as
they do from a quarter of the sample to all of it: hardly at all where vectors
have few dimensions in truth, nearly with the table where they are noise. No
query scores more rows than there are; where it would, one leaf holds them all.

Nearness is the inner product: vectors get one more component that brings them
all to the largest norm, so the trees split directions and norms alike.

Equal vectors are indexed once, with their smallest ``k + 1`` ids (more can
never be among k neighbours), so a vector that fills the table is one entry.
The sample also bounds a query's k-th best score from below, and leaves pass on
only what reaches a looser bound, so few of the scored candidates leave their task.

Tasks work on cells, subtrees of about ``PART`` vectors; cells that hold more
by the sample's count are dealt into parts.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.llm.common import seeded_sample
from corpusloom.storage import stored

K = 20
QUERY_EVERY = 20
TREES = 16
LEAF = 64
PART = 8192
SAMPLE, SAMPLE_BYTES = 40_000, 64 << 20
#: Queries out of the sample that measure recall, what they are to reach, and the most leaves to do it with.
TRIALS, RECALL, LEAVES = 200, 0.92, 4_096
#: Sampled vectors of a node that has a cut of its own, at least; directions that take turns below such nodes.
FILLED, TURNS = 8, 4
#: The rank, BOUND * (k + 1), of the score in the sample that bounds a query's k-th best, and queries that get theirs at once.
BOUND, TOGETHER = 2, 64
#: A query whose leaves hold less of its nearest in the sample visits twice as many, until they hold RECALL of them.
LOW = 0.75
#: Queries of a task that walks the trees, about.
WALKS = 256
#: What goes on top of an estimate for a table of four times the sample or more.
SURE = 1.5
#: Rows that a query scores at least, if there are as many.
LEAST = 2_048
#: Bytes of vectors that a task sends on at once.
BLOCK = 16 << 20
#: Scores from matrix products are rounded differently; more are kept, and then scored again exactly.
SPARE = 12


def valid(vector: Column) -> Column:
    """Not null, of one dimension at least, no null or non-finite component, not zero."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(wide, lambda x: x != 0), F.lit(False))


def _medians(node: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """The lower median of each node's values; 0 of a node without any."""
    order = np.lexsort((values, node))
    held = np.bincount(node, minlength=n)
    first = np.cumsum(held) - held
    at = np.minimum(first + np.maximum(held - 1, 0) // 2, len(values) - 1)
    return np.where(held > 0, values[order[at]], 0.0)


class Forest:
    """Trees of one depth over vectors of norm ``top`` at most; leaves are numbered over all trees."""

    def __init__(self, sample: np.ndarray, top: float, depth: int, trees: int, seed: int = 11):
        rng, x = np.random.default_rng(seed), lifted(sample, top)
        self.depth, self.top, self.trees = depth, top, trees
        self.filled = min(depth, int(math.log2(max(len(x) / FILLED, 1))))
        self.directions = np.zeros((trees, depth, x.shape[1]))
        self.cuts: list[list[np.ndarray]] = []
        for t in range(trees):
            for level in range(min(depth, self.filled + TURNS)):
                a, b = rng.choice(len(x), 2, replace=False) if len(x) > 1 else (0, 0)
                way = x[a] - x[b] if np.any(x[a] != x[b]) else rng.normal(size=x.shape[1])
                self.directions[t, level] = way / np.linalg.norm(way)
            for level in range(self.filled + TURNS, depth):
                self.directions[t, level] = self.directions[t, level - TURNS]
            along, node, cuts = x @ self.directions[t].T, np.zeros(len(x), np.int64), []
            for level in range(self.filled):
                cuts.append(_medians(node, along[:, level], 1 << level))
                node = 2 * node + (along[:, level] > cuts[-1][node])
            held = np.maximum(np.bincount(node, minlength=1 << self.filled), 1)
            for level in range(self.filled, depth):
                v = along[:, level]
                mean = np.bincount(node, v, 1 << self.filled) / held
                sd = np.sqrt(np.maximum(np.bincount(node, v * v, 1 << self.filled) / held - mean**2, 0))
                before = (level - self.filled) // TURNS
                at = [NormalDist().inv_cdf((2 * i + 1) / (2 << before)) for i in range(1 << before)]
                cuts.append((mean[:, None] + sd[:, None] * np.array(at)).ravel())
            self.cuts.append(cuts)
        self.slope, self.shift, self.spread = np.ones((trees, depth)), np.zeros((trees, depth)), np.ones((trees, depth))

    def place(self, level: int, node):
        """Where ``cuts`` of a level have a node's (an int's, or an array's of them)."""
        beyond = level - self.filled
        if beyond <= 0:
            return node
        out = node >> beyond
        for back in range(beyond - beyond // TURNS * TURNS, beyond, TURNS):  # the sides taken along this direction, first to last
            out = 2 * out + (node >> (beyond - 1 - back) & 1)
        return out

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """(rows, trees): the leaf of each vector in each tree."""
        x, out = lifted(vectors, self.top), []
        for t in range(self.trees):
            along, node = x @ self.directions[t].T, np.zeros(len(x), np.int64)
            for level, cut in enumerate(self.cuts[t]):
                node = 2 * node + (along[:, level] > cut[self.place(level, node)])
            out.append(node + (t << self.depth))
        return np.stack(out, axis=1)

    def asked(self, queries: np.ndarray) -> np.ndarray:
        """Queries as vectors of the largest norm: their own norm changes no ranks."""
        size = np.abs(queries).max(axis=1, keepdims=True)
        unit = queries / size
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        return np.concatenate([unit * self.top, np.zeros((len(unit), 1))], axis=1)

    def learn(self, queries: np.ndarray, near: np.ndarray, closer: float = 1.0) -> None:
        """How neighbours (queries, k, dimension) lie along each direction, as a line through the query's place.

        ``closer``: how much nearer than those the neighbours in the table are.
        """
        q, y = self.asked(queries), lifted(near.reshape(-1, near.shape[2]), self.top)
        for t in range(self.trees):
            a = np.repeat(q @ self.directions[t].T, near.shape[1], axis=0)
            b = y @ self.directions[t].T
            wide = a.var(axis=0)
            self.slope[t] = np.where(wide > 0, ((a - a.mean(axis=0)) * (b - b.mean(axis=0))).mean(axis=0) / np.maximum(wide, 1e-300), 0.0)
            self.shift[t] = b.mean(axis=0) - self.slope[t] * a.mean(axis=0)
            self.spread[t] = np.maximum((b - self.slope[t] * a - self.shift[t]).std(axis=0), 1e-6 * self.top)
        self.slope = 1 - (1 - self.slope) * closer**2
        self.shift, self.spread = self.shift * closer**2, self.spread * closer

    def visits(self, query: np.ndarray, count: int) -> list[int]:
        """The ``count`` leaves in which a neighbour is likeliest, over all trees, likeliest first."""
        along = self.directions @ self.asked(query[None])[0]
        place = (self.slope * along + self.shift).tolist()
        scale = (math.sqrt(0.5) / self.spread).tolist()
        if not hasattr(self, "listed"):
            self.listed = [[c.tolist() for c in cuts] for cuts in self.cuts]
        depth, filled, erfc, log = self.depth, self.filled, math.erfc, math.log
        push, swap, out = heapq.heappush, heapq.heappushpop, []
        queue = [(0.0, t, 0, 0) for t in range(1, self.trees)]
        now = (0.0, 0, 0, 0)
        while True:
            cost, t, level, node = now
            if level == depth:
                out.append(node + (t << depth))
                if len(out) == count or not queue:
                    return out
                now = heapq.heappop(queue)
                continue
            cut = self.listed[t][level][node if level <= filled else self.place(level, node)]
            right = 0.5 * erfc((cut - place[t][level]) * scale[t][level])
            high = (cost - log(right if right > 1e-12 else 1e-12), t, level + 1, 2 * node + 1)
            low = (cost - log(1 - right if right < 1 - 1e-12 else 1e-12), t, level + 1, 2 * node)
            push(queue, low if right > 0.5 else high)
            now = swap(queue, high if right > 0.5 else low)


def lifted(x: np.ndarray, top: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(top**2 - (x * x).sum(axis=1), 0))
    return np.concatenate([x, rest[:, None]], axis=1)


@dataclass
class Index:
    """The search over vectors of one length: a forest, None for one leaf; leaves a query visits; levels of cells, and their parts."""

    forest: Forest | None
    count: int
    rows: int
    cell_level: int
    parts: np.ndarray
    gauge: np.ndarray
    top: float
    recall: float
    goal: float = RECALL

    def cell(self, leaf: np.ndarray) -> np.ndarray:
        return leaf >> (self.forest.depth - self.cell_level) if self.forest else leaf

    def visits(self, query: np.ndarray, scores: np.ndarray, k: int) -> list[int]:
        """The leaves that a query visits: ``count``, and more where these hold too few of its nearest in the sample, whose ``scores`` are given."""
        forest, count, least = self.forest, self.count, LOW
        if not hasattr(self, "home"):
            self.home = forest.leaves(self.gauge)
        near = self.home[np.argpartition(-scores, min(k, len(scores) - 1))[: k + 1]]
        while True:
            out = forest.visits(query, count)
            hit = np.zeros(forest.trees << forest.depth, bool)
            hit[out] = True
            if count == len(hit) or hit[near].any(axis=1).mean() >= least:
                return out
            count, least = min(2 * count, len(hit)), self.goal

    @property
    def scored(self) -> float:
        """Rows that a query scores, about, repeats included."""
        return self.count * self.rows / (1 << self.forest.depth) if self.forest else float(self.rows)


def _neighbours(sample: np.ndarray, k: int) -> np.ndarray:
    """(trials, k): places of the nearest in the sample of its first rows."""
    trials = sample[:TRIALS]
    scores = trials @ sample.T
    scores[np.arange(len(trials)), np.arange(len(trials))] = -np.inf
    return np.argpartition(-scores, k - 1, axis=1)[:, :k]


def _measured(sample: np.ndarray, top: float, k: int, trees: int, leaf: int, recall: float) -> tuple[float, float, float]:
    """(rows a query is to score among ``sample`` itself, their recall, spread of its neighbours): all rows, if fewer don't do."""
    n = len(sample)
    depth, near, trials = math.ceil(math.log2(max(n / leaf, 1))), _neighbours(sample, k), sample[:TRIALS]
    forest = Forest(sample, top, depth, trees)
    forest.learn(trials, sample[near])
    home, most = forest.leaves(sample), 1 << depth
    first = np.full(near.shape, most)
    for i, q in enumerate(trials):
        rank = {leaf: r for r, leaf in enumerate(forest.visits(q, most))}
        first[i] = [min(rank.get(v, most) for v in row) for row in home[near[i]].tolist()]
    found = np.cumsum(np.bincount(first.ravel(), minlength=most + 1)[:most]) / first.size
    spread = float(forest.spread.mean()) if depth else top
    if found[-1] < recall:
        return n, 1.0, spread
    count = int(np.argmax(found >= recall))
    return (count + 1) * n / most, float(found[count]), spread


def fit(sample: np.ndarray, rows: int, top: float, k: int = K, trees: int = TREES, leaf: int = LEAF, recall: float = RECALL, part: int = PART) -> Index:
    """The index for ``rows`` distinct vectors that ``sample`` (in random order) stands for."""
    n = len(sample)
    exact = Index(None, 1, rows, 0, np.array([max(1, math.ceil(rows / part))]), sample, top, 1.0)
    if rows <= LEAST or n <= 8 * k or not 0 < top * top < math.inf:
        return exact
    least, got, spread = _measured(sample, top, k, trees, leaf, recall)
    closer = 1.0
    if rows > n and n >= 32 * k:
        before, _, wider = _measured(sample[: n // 4], top, k, trees, leaf, recall)
        steps = math.log(rows / n) / math.log(4)
        least *= min(max(least / before, 1.0), 4.0) ** steps * SURE ** min(steps, 1.0)
        closer = min(spread / wider, 1.0) ** steps
    elif rows > n:
        least *= rows / n
    least = max(least, LEAST)
    depth = math.ceil(math.log2(rows / leaf))
    while depth and least / rows * (1 << depth) > LEAVES:
        depth -= 1
    count = math.ceil(least / rows * (1 << depth))
    if count >= 1 << depth:
        return exact
    forest = Forest(sample, top, depth, trees)
    forest.learn(sample[:TRIALS], sample[_neighbours(sample, k)], closer)
    level = min(depth, forest.filled, max(0, math.ceil(math.log2(rows / part))))
    held = np.bincount((forest.leaves(sample) >> (depth - level)).ravel(), minlength=trees << level)
    parts = np.maximum(1, np.ceil(held * (rows / n) / (2 * part))).astype(np.int64)
    return Index(forest, count, rows, level, parts, sample, top, got, recall)


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _packed(rows: np.ndarray) -> pa.Array:
    """Rows of a matrix as binary values."""
    data, wide = np.ascontiguousarray(rows), rows.shape[1] * rows.dtype.itemsize
    offsets = np.arange(len(data) + 1, dtype=np.int64) * wide
    return pa.Array.from_buffers(pa.large_binary(), len(data), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).cast(pa.binary())


def _unpacked(column: pa.ChunkedArray, dim: int, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dim).astype(float)


def indexes(kinds: DataFrame, k: int, trees: int, leaf: int, recall: float) -> dict[int, Index]:
    """An :class:`Index` for each length of ``kinds`` (__key, __v, __dim); the driver gets the sample and a row a length."""
    norm = F.sqrt(F.aggregate("__v", F.lit(0.0), lambda a, x: a + x * x))
    sizes = {r["__dim"]: (r["n"], r["top"]) for r in kinds.groupBy("__dim").agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("top")).collect()}
    if not sizes:
        return {}
    total, widest = sum(n for n, _ in sizes.values()), max(sizes)
    most = max(1, min(SAMPLE, SAMPLE_BYTES // (8 * widest)))
    got = seeded_sample(kinds.select("__key", "__v", "__dim"), F.col("__key"), most, "ann-1", total).select("__v", "__dim").toArrow()
    by_dim = got["__dim"].to_numpy()
    out = {}
    for dim, (n, top) in sizes.items():
        at = np.flatnonzero(by_dim == dim)
        out[dim] = fit(_matrix(got["__v"].take(pa.array(at)), dim), n, top, k, trees, leaf, recall)
    return out


def nearest(vectors: DataFrame, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, trees: int = TREES, leaf: int = LEAF, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every row for which ``queries`` holds.

    Rows with a null id, or whose vector is not :func:`valid`, take no part.
    Vectors of different lengths have no inner product: each length is searched
    by itself. A query is no candidate of its own, its copies are. Ties go to
    the smaller id. Repeated rows (one id, one vector) count once; an id with
    several vectors asks and answers with each of them. Without valid rows the
    result is empty; with few, all candidates come back, else every query gets
    ``k`` rows: what tasks pass on is bounded by a query's scores in the sample,
    and a query that lies apart and finds too few above that is searched again
    without the bound. Norms whose square is beyond a double are searched
    without trees. Other columns don't matter.
    """
    spark = vectors.sparkSession
    narrow = vectors.schema[vector_col].dataType.elementType.typeName() == "float"
    real = np.float32 if narrow else np.float64
    rows = vectors.select(F.col(id_col).cast("long").alias("__id"), F.transform(vector_col, lambda x: x.cast("double") + F.lit(0.0)).alias("__v"), queries.alias("__q"))
    rows = rows.where(F.col("__id").isNotNull() & valid(F.col("__v"))).dropDuplicates(["__id", "__v"])
    rows = stored(rows.withColumn("__h", F.xxhash64("__v")))
    first = rows.select("__h", "__v", "__id", F.row_number().over(W.partitionBy("__h", "__v").orderBy("__id")).alias("__r")).where(F.col("__r") <= k + 1)
    kinds = first.groupBy("__h", "__v").agg(F.sort_array(F.collect_list("__id")).alias("__ids"))
    # an id with several vectors names several kinds, so kinds have names of their own
    kinds = stored(kinds.select("__h", "__v", "__ids", F.col("__ids")[0].alias("__key"), F.size("__v").alias("__dim"), F.monotonically_increasing_id().alias("__kind")))
    asked = stored(rows.where("__q").groupBy("__h", "__v").agg(F.min("__id").alias("__query"), F.size(F.first("__v")).alias("__dim")))
    found = indexes(kinds, k, trees, leaf, recall)
    shared = spark.sparkContext.broadcast(found)  # of a size that the sample bounds

    def by_dim(dims):
        """(length, positions) of a batch's rows."""
        dims = dims.to_numpy()
        for dim in np.unique(dims).tolist():
            yield dim, np.flatnonzero(dims == dim)

    def index(batches):
        for b in batches:
            for dim, rows in by_dim(b.column(2)):
                one = shared.value[dim]
                for at in np.array_split(rows, -(-len(rows) * trees * dim * 8 // BLOCK)):
                    v, kind, key = _matrix(b.column(1).take(pa.array(at)), dim), b.column(0).to_numpy()[at], b.column(3).to_numpy()[at]
                    leaves = one.forest.leaves(v) if one.forest else np.zeros((len(v), 1), np.int64)
                    of = np.repeat(np.arange(len(v)), leaves.shape[1])
                    leaves = leaves.ravel()
                    cell = one.cell(leaves)
                    part = (kind[of] ^ (kind[of] >> 33)) % one.parts[cell]
                    cols = [np.full(len(of), dim), cell, part, leaves, kind[of], key[of]]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, cols), _packed(v.astype(real)).take(pa.array(of))], names=["dim", "cell", "part", "leaf", "kind", "key", "v"])

    def probe(batches, bounded):
        rank, names = BOUND * (k + 1), ["dim", "cell", "part", "query", "q", "least", "leaves"]
        for b in batches:
            for dim, at in by_dim(b.column(2)):
                one, q, query, out = shared.value[dim], _matrix(b.column(1).take(pa.array(at)), dim), b.column(0).to_numpy()[at], []

                def flush():
                    cells, parts, of, least, own = zip(*out, strict=True)
                    out.clear()
                    plain = [pa.array(x, pa.int64()) for x in ([dim] * len(of), cells, parts, query[list(of)])]
                    return pa.RecordBatch.from_arrays([*plain, _packed(q[list(of)].astype(real)), pa.array(least, pa.float64()), pa.array(own, pa.list_(pa.int64()))], names=names)

                for i in range(len(q)):
                    if i % TOGETHER == 0:
                        near = q[i : i + TOGETHER]
                        bound, near = np.full(len(near), -np.inf), near @ one.gauge.T
                        if bounded and len(one.gauge) > rank:
                            bound = np.partition(near, len(one.gauge) - rank, axis=1)[:, len(one.gauge) - rank] - 1e-9 * np.abs(q[i : i + TOGETHER]).sum(axis=1) * one.top
                    least = float(bound[i % TOGETHER])
                    leaves = np.sort(one.visits(q[i], near[i % TOGETHER], k)) if one.forest else np.zeros(1, np.int64)
                    cell, begin = np.unique(one.cell(leaves), return_index=True)
                    for c, own in zip(cell.tolist(), np.split(leaves, begin[1:]), strict=True):
                        out += [(c, p, i, least, own) for p in range(one.parts[c])]
                    if len(out) * dim * 8 > BLOCK:
                        yield flush()
                if out:
                    yield flush()

    def rank(members: pa.Table, probes: pa.Table) -> pa.Table:
        ids, at, scores, keep = [], [], [], k + 1 + SPARE
        if len(members) and len(probes):
            dim = members["dim"][0].as_py()
            x, q = _unpacked(members["v"], dim, real), _unpacked(probes["q"], dim, real)
            order = np.argsort(members["leaf"].to_numpy(), kind="stable")
            x, home = x[order], members["leaf"].to_numpy()[order]
            wanted = probes["leaves"].combine_chunks()
            goal, of = wanted.flatten().to_numpy(), np.repeat(np.arange(len(q)), np.diff(wanted.offsets.to_numpy()))
            turn = np.argsort(goal, kind="stable")
            goal, of = goal[turn], of[turn]
            query, least = probes["query"].to_numpy(), probes["least"].to_numpy()
            held, begin = np.unique(home, return_index=True)
            end = np.append(begin[1:], len(home))
            low, high = np.searchsorted(goal, held), np.searchsorted(goal, held, side="right")
            for b, e, f, t in zip(begin.tolist(), end.tolist(), low.tolist(), high.tolist(), strict=True):
                for a in range(f, t, 512):
                    who = of[a : min(a + 512, t)]
                    rough, edge = q[who] @ x[b:e].T, least[who]
                    if e - b > keep:
                        edge = np.maximum(edge, np.partition(rough, e - b - keep, axis=1)[:, e - b - keep])
                    i, j = np.nonzero(rough >= edge[:, None])
                    ids.append(query[who[i]])
                    at.append(order[b + j])
                    scores.append((q[who[i]] * x[b + j]).sum(axis=1))
        join = lambda xs, kind: np.concatenate(xs) if xs else np.zeros(0, kind)
        at = pa.array(join(at, np.int64))
        return pa.table({"query": join(ids, np.int64), "kind": members["kind"].take(at), "key": members["key"].take(at), "score": join(scores, float)})

    members = kinds.select("__kind", "__v", "__dim", "__key").mapInArrow(index, "dim bigint, cell bigint, part bigint, leaf bigint, kind bigint, key bigint, v binary")
    cell = ["dim", "cell", "part"]

    def lists(asked, n, bounded):
        """(query, __near): up to 2 (k + 1) ids for each of ``n`` queries, nearest first."""
        walks = max(1, min(-(-n // WALKS), max(int(spark.conf.get("spark.sql.shuffle.partitions")), n // 100_000)))
        probes = asked.select("__ask", "__v", "__dim").repartition(walks).mapInArrow(lambda b: probe(b, bounded), "dim bigint, cell bigint, part bigint, query bigint, q binary, least double, leaves array<bigint>")
        pairs = members.groupBy(*cell).cogroup(probes.groupBy(*cell)).applyInArrow(rank, "query bigint, kind bigint, key bigint, score double")
        pairs = pairs.groupBy("query", "kind").agg(F.first("key").alias("key"), F.first("score").alias("score"))  # one pair from several trees has one score
        best = W.partitionBy("query").orderBy(F.desc("score"), "key", "kind")
        pairs = pairs.withColumn("__r", F.row_number().over(best)).where(F.col("__r") <= k + 1).drop("__r")
        pairs = pairs.join(kinds.select(F.col("__kind").alias("kind"), "__ids"), "kind")
        named = pairs.select("query", "score", F.explode("__ids").alias("vec_id"))
        by_id = W.partitionBy("query").orderBy(F.desc("score"), "vec_id")
        named = named.withColumn("__r", F.row_number().over(by_id)).where(F.col("__r") <= 2 * (k + 1))
        return stored(named.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("__r", "vec_id", "score"))).alias("__near")))

    asked = stored(asked.withColumn("__ask", F.monotonically_increasing_id()))
    near = lists(asked, asked.count(), True)
    if any(len(one.gauge) > BOUND * (k + 1) for one in found.values()):
        # the sample's scores bound what is passed on; a query that finds too few above its bound is searched once more without
        full = near.where(F.size("__near") > k).select(F.col("query").alias("__ask"))
        short = stored(asked.join(full, "__ask", "left_anti"))
        if n_short := short.count():
            near = near.where(F.size("__near") > k).unionByName(lists(short, n_short, False))
    every = rows.where("__q").select(F.col("__id").alias("query_id"), "__h", "__v").join(asked, ["__h", "__v"]).select("query_id", F.col("__ask").alias("query"))
    out = every.join(near, "query")
    own = F.slice(F.filter("__near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    out = out.select("query_id", F.posexplode(own).alias("__p", "__n"))
    return out.select("query_id", (F.col("__p") + 1).cast("int").alias("rank"), F.col("__n.vec_id").alias("vec_id"), F.col("__n.score").alias("score"))


def query(vectors: DataFrame) -> DataFrame:
    return nearest(vectors, F.col("vec_id") % QUERY_EVERY == 0).withColumns({"query_id": F.col("query_id").cast("long"), "vec_id": F.col("vec_id").cast("long")})
