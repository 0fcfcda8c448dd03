"""Language ID: a byte convolutional network, trained in numpy.

A text's UTF-8 bytes (A-Z in lower case) are cut into windows of fixed length
that cover all of it, the last one padded. One-hot byte filters of widths 2, 3
and 4 slide over each window; their maxima pass a rectifier and a softmax
layer. A text's prediction is the mean of its windows' log-probabilities,
weighted by bytes. Training reads a bounded sample (``sample`` documents, two
cuts of at most ``WINDOW`` characters each); prediction reads every byte of every row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import fold, seeded_sample

FOLDS, HELD_OUT = 5, 0
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
SAMPLE = 6_000
UNKNOWN = "und"
#: Windows that pass the network at once.
CHUNK = 128


@dataclass
class ByteCnn:
    """filters: for each width a table (width, 256, FILTERS); dense: (features, labels)."""

    labels: list[str]
    filters: list[np.ndarray]
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray

    def pair_tables(self) -> list[np.ndarray]:
        """Tables over byte pairs, so that a filter of width 4 takes two lookups instead of four."""
        two, three, four = self.filters
        pair = lambda t, i: (t[i][:, None, :] + t[i + 1][None, :, :]).reshape(65536, FILTERS).astype(np.float32)
        return [pair(two, 0), pair(three, 0), three[2].astype(np.float32), pair(four, 0), pair(four, 2)]


def windows(data: bytes) -> np.ndarray:
    """(windows, WINDOW) of bytes; an empty text has one window of padding."""
    n = max(1, -(-len(data) // WINDOW))
    return np.frombuffer(data.ljust(n * WINDOW, b"\0"), np.uint8).reshape(n, WINDOW)


def held(data: bytes) -> np.ndarray:
    """Bytes of the text in each of its windows, 1 at least."""
    n = max(1, -(-len(data) // WINDOW))
    return np.minimum(WINDOW, np.maximum(1, len(data) - WINDOW * np.arange(n)))


def _maxima(tables: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    """(windows, features) of windows (windows, WINDOW)."""
    t = np.ascontiguousarray(x.T).astype(np.int32)
    pair = (t[:-1] << 8) | t[1:]
    out = [tables[0][pair].max(axis=0)]
    r = tables[1][pair[:-1]]
    r += tables[2][t[2:]]
    out.append(r.max(axis=0))
    r = tables[3][pair[:-2]]
    r += tables[4][pair[2:]]
    out.append(r.max(axis=0))
    return np.concatenate(out, axis=1)


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def fit(texts: list[bytes], langs: list[str], rounds: int = 6, batch: int = 128, seed: int = 3) -> ByteCnn:
    """Adam on all windows of the texts, weighted by their share of a text's bytes. Max pooling sends each gradient to one position, so its pass back is sparse."""
    rng = np.random.default_rng(seed)
    labels = sorted(set(langs))
    parts = [windows(t.lower()) for t in texts]
    x = np.concatenate(parts) if texts else np.zeros((0, WINDOW), np.uint8)
    y = np.array([labels.index(v) for v, w in zip(langs, parts, strict=True) for _ in w], int)
    weight = np.concatenate([held(t) / held(t).sum() for t in texts]) if texts else np.zeros(0)
    params = [rng.normal(0, 0.1, (k, 256, FILTERS)) for k in WIDTHS]
    params += [np.zeros(len(WIDTHS) * FILTERS), rng.normal(0, 0.3, (len(WIDTHS) * FILTERS, len(labels))), np.zeros(len(labels))]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(rounds if len(labels) > 1 else 0):
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // batch)):
            xb, yb, at, tops = x[rows], y[rows], [], []
            for k, table in zip(WIDTHS, params, strict=False):
                r = sum(table[j][xb[:, j : WINDOW - k + 1 + j]] for j in range(k))
                p = r.argmax(axis=1)
                at.append(p)
                tops.append(np.take_along_axis(r, p[:, None, :], axis=1)[:, 0])
            top = np.concatenate(tops, axis=1) + params[3]
            hidden = np.maximum(top, 0.1 * top)
            delta = np.exp(_log_softmax(hidden @ params[4] + params[5]))
            delta[np.arange(len(yb)), yb] -= 1
            delta *= (weight[rows] / weight[rows].sum())[:, None]
            back = (delta @ params[4].T) * np.where(top > 0, 1, 0.1)
            grads = []
            for n, (k, p) in enumerate(zip(WIDTHS, at, strict=True)):
                g, part = np.zeros((k, 256, FILTERS)), back[:, n * FILTERS : (n + 1) * FILTERS]
                for j in range(k):
                    np.add.at(g[j], (xb[np.arange(len(xb))[:, None], p + j], np.arange(FILTERS)[None, :]), part)
                grads.append(g)
            grads += [back.sum(axis=0), hidden.T @ delta, delta.sum(axis=0)]
            step += 1
            for i, g in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                params[i] = params[i] - 0.01 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return ByteCnn(labels, params[:3], params[3], params[4], params[5])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, seed: str = "lang-1") -> ByteCnn:
    """Fits on ``sample`` documents at most, outside the held-out fold, two windows of each.

    A cut starts at a seeded position; the second one has a seeded length, so
    that short texts are learned too. All bytes of a cut are learned. Null texts, languages and ids do not
    take part. What is collected is bounded by the sample.
    """
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"), F.col(lang_col).alias("__lang"))
    rows = rows.where(F.col("__id").isNotNull() & F.col("__lang").isNotNull() & F.col("__text").rlike(r"\p{L}") & (fold(F.col("__id"), FOLDS) != HELD_OUT))
    span = F.greatest(F.char_length("__text") - WINDOW + 1, F.lit(1))
    short = F.pmod(F.xxhash64("__id", F.lit("length")), F.lit(WINDOW - 16)).cast("int") + 16
    cuts = [F.substring("__text", F.pmod(F.xxhash64("__id", F.lit(i)), span.cast("long")).cast("int") + 1, size).alias(f"__w{i}") for i, size in enumerate((F.lit(WINDOW), short))]
    got = seeded_sample(rows.select("__id", "__lang", *cuts), F.col("__id"), sample, seed).toPandas()
    texts = [t.encode("utf-8", "replace") for i in range(2) for t in got[f"__w{i}"]]
    return fit(texts, list(got["__lang"]) * 2)


def predicted(docs: DataFrame, model: ByteCnn, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(__id, __lang, __score) of every row.

    ``und`` with score 0 where the text is null or has no letter, or where
    nothing was learned. Of languages that score alike the first by name is
    taken. Texts of any length are read whole, and hold a task's memory alone.
    Repeated rows come back repeated; other columns don't matter. An empty
    table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("__id"), F.when(F.col(text_col).rlike(r"\p{L}"), F.col(text_col).cast("binary")).alias("__text"))
    tables = model.pair_tables() if model.labels else []
    labels, bias, dense, dense_bias = model.labels, model.bias.astype(np.float32), model.dense.astype(np.float32), model.dense_bias.astype(np.float32)
    shared = docs.sparkSession.sparkContext.broadcast(tables)  # of fixed size: about 8 MB

    def score(texts: list[bytes]) -> tuple[list[int], list[float]]:
        x = [windows(t.lower()) for t in texts]
        counts = np.array([len(w) for w in x])
        flat = np.concatenate(x)
        logs = []
        for i in range(0, len(flat), CHUNK):
            top = _maxima(shared.value, flat[i : i + CHUNK]) + bias
            logs.append(_log_softmax(np.maximum(top, np.float32(0.1) * top) @ dense + dense_bias))
        size = np.concatenate([held(t) for t in texts])
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        total = np.add.reduceat(np.concatenate(logs).astype(float) * size[:, None], starts, axis=0) / np.add.reduceat(size, starts)[:, None]
        p = np.exp(_log_softmax(total))
        return p.argmax(axis=1).tolist(), p.max(axis=1).tolist()

    def run(batches):
        for b in batches:
            langs, scores, at, texts, size = [UNKNOWN] * len(b), [0.0] * len(b), [], [], 0

            def flush():
                for i, k, p in zip(at, *score(texts), strict=True):
                    langs[i], scores[i] = labels[k], p
                at.clear()
                texts.clear()

            for i, t in enumerate(b.column(1)):
                if labels and t.is_valid:
                    at.append(i)
                    texts.append(t.as_py())
                    size += len(texts[-1])
                    if size > 1 << 20:
                        flush()
                        size = 0
            if at:
                flush()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["__id", "__lang", "__score"])

    return rows.mapInArrow(run, f"__id {dict(docs.dtypes)[id_col]}, __lang string, __score double")


def query(docs: DataFrame) -> DataFrame:
    rows = predicted(docs, train(docs))
    return rows.select(
        F.col("__id").alias("doc_id"),
        F.coalesce(fold(F.col("__id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        F.col("__lang").alias("lang_pred"),
        F.col("__score").alias("score"),
    )
