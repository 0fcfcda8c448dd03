"""Connected components of a distributed list of edges, by contraction."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.storage import stored


def _rooted(batches):
    """(n, m) for the nodes of a task's edges: each node's component by its smallest node."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for batch in batches:
        for a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            a, b = find(root.setdefault(a, a)), find(root.setdefault(b, b))
            root[max(a, b)] = min(a, b)
    nodes = list(root)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())], names=["n", "m"])


def connected_components(edges: DataFrame, whole: int = 0) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); one root a component.

    Each round points every node to its smallest neighbour under a mixed-up
    order (so that no chain of ids is slow), follows the pointers twice, and
    contracts the edges; the nodes shrink by a constant factor a round. Rounds
    end when no edge is left. Everything stays distributed; every round is cut
    in the shared folder. Self-loops and repeated edges do no harm. Once no more
    than ``whole`` edges are left, one task joins them, which saves small rounds.
    """
    mixed = edges.select(F.xxhash64("a").alias("a"), F.xxhash64("b").alias("b"))
    both = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node"))).distinct()
    names = stored(both.select("node", F.xxhash64("node").alias("root")))
    left = stored(mixed.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    while n := left.count():
        if n <= whole:
            to = left.coalesce(1).mapInArrow(_rooted, "n bigint, m bigint")
            return stored(names.join(to, names["root"] == to["n"], "left").select("node", F.coalesce("m", "root").alias("root")))
        out = left.union(left.select("b", "a"))
        to = out.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m")).select("n", F.least("n", "m").alias("m"))
        to = stored(to)
        for _ in range(2):
            after = to.select(F.col("n").alias("m"), F.col("m").alias("m2"))
            to = to.join(after, "m").select("n", F.col("m2").alias("m"))
        to = stored(to)
        ends = left.join(to, left["a"] == to["n"]).select(F.col("m").alias("a"), "b")
        ends = ends.join(to, ends["b"] == to["n"]).select("a", F.col("m").alias("b"))
        left = stored(ends.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        names = stored(names.join(to, names["root"] == to["n"], "left").select("node", F.coalesce("m", "root").alias("root")))
    return names
