"""Source divergence audit: how the word use of a language's sources differs, by systolic rotation.

Counts are pre-aggregated in the tasks that read the texts and then by shuffle,
so a source of a third of all rows costs no task more. Each language's kept
terms are dealt into slices of ``SLICE`` at most. A source has one vector a
slice, made in one stream over its terms: the local heap of ``TOP`` terms, and
what is left of the vector (the ids and shares of terms that occur; all others
have the source's base share), compressed.

Sources are dealt into ``PODS`` pods. A cell is a language's slice and a pod,
whose vectors stay there, unpacked once; the other pods' compressed vectors
visit it in the rounds of a round-robin tournament, in which every two pods
meet once, in one of their two cells, and a meeting gives both directions. What
a cell holds is bounded: slices shrink where pods grow (``BUDGET`` terms).
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.storage import stored

LEAST_DOCS = 30
SCALE = 1_000_000_000
PRIOR = 5
TOP = 50
#: Even, so that everyone meets someone in each of PODS - 1 rounds.
PODS = 16
SLICE, BUDGET = 1 << 14, 1 << 20
#: Counts that a task holds before it passes them on.
HELD = 1 << 18

#: Bytes of terms (letters, in lower case, and all beyond ASCII); the others separate them.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """(lang, source, term, tf, df) of every group; the term '' stands for the group itself, with no occurrences."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(part(lang_col).alias("lang"), part(source_col).alias("source"), part(text_col).cast("binary").alias("text"))

    def run(batches):
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def passed():
            for (lang, source), (tf, df) in groups.items():
                terms = [b"", *tf]
                names = [pa.array([x] * len(terms)) for x in (lang, source)] + [pa.array(terms, pa.binary()).cast(pa.string())]
                cols = [*names, pa.array([0, *tf.values()], pa.int64()), pa.array([0, *map(df.__getitem__, tf)], pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, names=["lang", "source", "term", "tf", "df"])

        held = 0
        for b in batches:
            for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                tf, df = groups.setdefault((lang, source), (Counter(), Counter()))
                terms = text.as_py().translate(TERM_BYTES).split()
                before = len(tf)
                tf.update(terms)
                df.update(set(terms))
                held += len(tf) - before
                if held > HELD:
                    yield from passed()
                    groups, held = {}, 0
        yield from passed()

    counts = rows.mapInArrow(run, "lang string, source string, term string, tf bigint, df bigint")
    return counts.groupBy("lang", "source", "term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def share(count: Column, total: Column) -> Column:
    """1 + floor(SCALE * (count + PRIOR) / total), exact; 1 + SCALE where there is no total."""
    wide = lambda c: c.cast("decimal(20,0)")
    return F.when(total > 0, F.call_function("div", wide(count + PRIOR) * F.lit(SCALE).cast("decimal(10,0)"), wide(total)) + 1).otherwise(SCALE + 1).cast("long")


def _packed(ids: np.ndarray, shares: np.ndarray) -> bytes:
    return zlib.compress(np.diff(ids, prepend=0).astype("<u4").tobytes() + shares.astype("<u4").tobytes(), 1)


def _unpacked(blob: bytes, base: int, terms: int) -> np.ndarray:
    both = np.frombuffer(zlib.decompress(blob), "<u4").reshape(2, -1)
    out = np.full(terms, base, np.int64)
    out[np.cumsum(both[0])] = both[1]
    return out


def vectors(rows: DataFrame) -> DataFrame:
    """(lang, slice, source, pod, terms, base, blob, top) of every source and slice.

    ``rows``: (lang, source, slice, id, p, q, term, pod), with a row of id -1
    for each vector, its p the base share and its q the number of terms.
    """
    rows = rows.repartition("lang", "source", "slice").sortWithinPartitions("lang", "source", "slice", "id")
    kind = pa.list_(pa.struct([("term", pa.string()), ("f", pa.int64())]))

    def run(batches):
        head, parts = None, []  # of the vector that is being read

        def made():
            if head is None:
                return
            ids, p, q, terms = (np.concatenate([x[i] for x in parts]) for i in range(4))
            at = np.flatnonzero(p > q)
            top = heapq.nsmallest(TOP, zip((q[at] - p[at]).tolist(), (t.encode() for t in terms[at]), strict=True))
            lang, source, slice_, base, size, pod = head
            cols = [[lang], [slice_], [source], [pod], [size], [base], [_packed(ids, p)], [[{"term": t.decode(), "f": -f} for f, t in top]]]
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), kind]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["lang", "slice", "source", "pod", "terms", "base", "blob", "top"])

        for b in batches:
            ids, p, q = (np.asarray(b.column(i)) for i in (3, 4, 5))
            terms = np.asarray(b.column(6), object)
            starts = np.flatnonzero(ids < 0)
            ends = np.append(starts[1:], len(ids))
            if first := (starts[0] if len(starts) else len(ids)):
                parts.append((ids[:first], p[:first], q[:first], terms[:first]))
            for s, e in zip(starts.tolist(), ends[: len(starts)].tolist(), strict=True):
                yield from made()
                head = b.column(0)[s].as_py(), b.column(1)[s].as_py(), b.column(2)[s].as_py(), int(p[s]), int(q[s]), b.column(7)[s].as_py()
                parts = [(ids[s + 1 : e], p[s + 1 : e], q[s + 1 : e], terms[s + 1 : e])]
        yield from made()

    return rows.select("lang", "source", "slice", "id", "p", "q", "term", "pod").mapInArrow(run, "lang string, slice bigint, source string, pod bigint, terms bigint, base bigint, blob binary, top array<struct<term: string, f: bigint>>")


def partner(pod: Column, turn: Column, pods: int) -> Column:
    """Whom a pod meets in a round: pods below the last whose numbers add up to the round, and the last with the one left over."""
    other = F.pmod(turn - pod, F.lit(pods - 1))
    alone = F.pmod(turn * (pods // 2), F.lit(pods - 1))  # twice this is the round
    return F.when(pod == pods - 1, alone).when(other == pod, F.lit(pods - 1)).otherwise(other)


def rotated(blocks: DataFrame, pods: int = PODS) -> DataFrame:
    """(lang, source, item, f) of every two sources that meet, both directions; ``blocks`` as :func:`vectors` has them."""
    kept = blocks.groupBy("lang", "slice", "pod", "terms").agg(F.collect_list(F.struct("source", "base", "blob")).alias("own"))
    resident = kept.withColumn("cell", F.col("pod")).withColumn("turn", F.lit(-1).cast("long"))
    moving = kept.withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(pods - 2).cast("long"))))
    moving = moving.withColumn("cell", partner(F.col("pod"), F.col("turn"), pods)).where("cell < pod")
    cells = resident.unionByName(moving).repartition("lang", "slice", "cell").sortWithinPartitions("lang", "slice", "cell", "turn")

    def run(batches):
        now, here = None, []
        for b in batches:
            for i in range(b.num_rows):
                lang, slice_, cell, turn, terms, own = (b.column(k)[i].as_py() for k in range(6))
                out = []
                if turn < 0:
                    now, here = (lang, slice_, cell), [(x["source"], _unpacked(x["blob"], x["base"], terms)) for x in own]
                    met = [(x, y) for k, x in enumerate(here) for y in here[:k]]
                elif (lang, slice_, cell) != now:
                    continue  # a pod without sources holds nobody to meet
                else:
                    met = ((x, (y["source"], v)) for y in own for v in [_unpacked(y["blob"], y["base"], terms)] for x in here)
                for (x, v), (y, w) in met:
                    f = int(np.abs(v - w).sum())
                    out += [(x, y, f), (y, x, f)]
                cols = [pa.array([lang] * len(out), pa.string()), *(pa.array([o[k] for o in out], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64())))]
                yield pa.RecordBatch.from_arrays(cols, names=["lang", "source", "item", "f"])

    return cells.select("lang", "slice", "cell", "turn", "terms", "own").mapInArrow(run, "lang string, source string, item string, f bigint")


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least: int = LEAST_DOCS, pods: int = PODS, slice_terms: int = SLICE, budget: int = BUDGET) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source is from the language's others, and by which terms from the whole.

    Null text, language and source read as ''. A source without kept terms has
    equal shares for all; a language without kept terms gives pairs of value 0
    and no terms. Repeated rows count as documents of their own. Texts of any
    length count whole; further columns don't matter. An empty table gives no rows.
    """
    counts = stored(term_counts(docs, text_col, lang_col, source_col))
    groups = counts.where("term = ''").select("lang", "source")
    known = stored(counts.where("term <> ''").groupBy("lang", "term").agg(F.sum("tf").alias("c"), F.sum("df").alias("df")).where(F.col("df") >= least).select("lang", "term", "c"))
    langs = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).join(known.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("c").alias("all")), "lang", "left")
    langs = langs.select("lang", "n", F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("all", F.lit(0)).alias("all"))
    wide = F.least(F.lit(slice_terms), F.greatest(F.lit(1), F.floor(F.lit(budget) / F.ceil(F.col("n") / pods))))
    langs = stored(langs.withColumn("slices", F.greatest(F.lit(1), F.ceil(F.col("v") / wide)).cast("long")))

    terms = known.join(langs, "lang").withColumn("slice", F.pmod(F.xxhash64("term"), F.col("slices")))
    terms = terms.withColumn("id", F.row_number().over(Window.partitionBy("lang", "slice").orderBy("term")).cast("long") - 1)
    terms = stored(terms.select("lang", "term", "slice", "id", share(F.col("c"), F.col("all") + PRIOR * F.col("v")).alias("q")))
    sizes = terms.groupBy("lang", "slice").agg(F.count(F.lit(1)).alias("size"))

    found = counts.where("term <> ''").join(terms, ["lang", "term"])
    totals = found.groupBy("lang", "source").agg(F.sum("tf").alias("total"))
    numbered = groups.withColumn("pod", F.pmod(F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1, F.lit(pods)))
    numbered = numbered.join(langs, "lang").join(totals, ["lang", "source"], "left")
    numbered = stored(numbered.select("lang", "source", "pod", "slices", (F.coalesce("total", F.lit(0)) + PRIOR * F.col("v")).alias("total")))
    heads = numbered.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1))).join(sizes, ["lang", "slice"], "left")
    heads = heads.select("lang", "source", "slice", F.lit(-1).cast("long").alias("id"), share(F.lit(0), F.col("total")).alias("p"), F.coalesce("size", F.lit(0)).cast("long").alias("q"), F.lit("").alias("term"), "pod")
    body = found.join(numbered, ["lang", "source"]).select("lang", "source", "slice", "id", share(F.col("tf"), F.col("total")).alias("p"), "q", "term", "pod")
    blocks = stored(vectors(heads.unionByName(body)))

    pairs = rotated(blocks, pods).groupBy("lang", "source", "item").agg(F.sum("f").alias("value")).withColumn("part", F.lit("pair"))
    heaps = blocks.select("lang", "source", F.explode("top").alias("t")).select("lang", "source", F.col("t.term").alias("item"), F.col("t.f").alias("value"), F.lit("term").alias("part"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = [x.withColumn("rank", F.row_number().over(order).cast("int")) for x in (pairs, heaps)]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= TOP)).select("lang", "source", "part", "item", "value", "rank")


def query(docs: DataFrame) -> DataFrame:
    """The audit of all documents; odd rows as in :func:`audit`."""
    return audit(docs)


_SHARE = "1 + (1000000000::HUGEINT * ({c} + 5)) // ({n} + 5 * v)"
SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, coalesce(text, '') AS t, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
words AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS c FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
langs AS (SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang),
whole AS (SELECT lang, term, {_SHARE.format(c="c", n="n")} AS q FROM kept JOIN langs USING (lang)),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS c FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term),
totals AS (SELECT lang, source, sum(c) AS n FROM counts GROUP BY lang, source),
shares AS (
  SELECT g.lang, g.source, w.term, coalesce(k.c, 0) AS c, {_SHARE.format(c="coalesce(k.c, 0)", n="coalesce(t.n, 0)")} AS p, w.q
  FROM groups g JOIN whole w ON w.lang = g.lang JOIN langs l ON l.lang = g.lang
  LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
  LEFT JOIN counts k ON k.lang = g.lang AND k.source = g.source AND k.term = w.term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.f, 0) AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM shares WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
