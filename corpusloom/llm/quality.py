"""Quality classifier: a sparse rule ensemble, compiled into Spark columns.

Shallow boosted trees are grown over text statistics; every path of a tree is
a conjunctive rule. A lasso logistic regression over those rules and the
clipped statistics leaves a few dozen terms, which are compiled into one
column expression, so scoring runs inside the JVM over whole texts.

Fitting reads a bounded sample of labelled rows (``sample``, 20,000 at most,
by a seeded hash of the id); scoring reads every row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import WORD_PATTERN, boxed, fold, seeded_sample
from corpusloom.llm.common import field as part_of
from corpusloom.storage import stored

FOLDS, HELD_OUT = 5, 0
SAMPLE = 20_000
THRESHOLD = 0.3
TREES, DEPTH, BINS, RATE = 24, 3, 32, 0.3


def _share(text: Column, char: str) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(char), F.lit("")))


def statistics(text: Column) -> dict[str, Column]:
    """The statistics of a whole text (null: empty), as doubles."""
    chars = F.greatest(F.char_length(text), F.lit(1)).cast("double")
    words = F.regexp_count(text, F.lit(WORD_PATTERN)).cast("double")
    lines = F.split(text, "\n", -1)
    n_lines = F.size(lines).cast("double")
    return {
        "log_chars": F.log1p(F.char_length(text).cast("double")),
        "word_len": chars / (words + 1),
        "line_len": chars / n_lines,
        "upper": F.regexp_count(text, F.lit(r"\p{Lu}")) / chars,
        "digit": F.regexp_count(text, F.lit("[0-9]")) / chars,
        "symbol": F.regexp_count(text, F.lit(r"[#$%&*+<=>@\^_`~\\{}\[\]]")) / chars,
        "pipe": _share(text, "|") / chars,
        "shout": _share(text, "!") / chars,
        "stop": _share(text, ".") / chars,
        "comma": _share(text, ",") / chars,
        "same_lines": 1 - F.size(F.array_distinct(lines)) / n_lines,
        "word_kinds": F.size(F.array_distinct(F.split(text, " ", -1))) / (words + 1),
        "closed_lines": F.size(F.filter(lines, lambda x: F.endswith(x, F.lit(".")))) / n_lines,
    }


def _tree(bins: np.ndarray, grad: np.ndarray, hess: np.ndarray, depth: int) -> tuple[np.ndarray, list[tuple]]:
    """One regression tree on binned rows: its output, and the path (feature, bin, is_left) of every node."""
    out, paths = np.zeros(len(grad)), []

    def grow(rows: np.ndarray, path: tuple, left: int) -> None:
        best = (1e-6, 0, 0)
        total_g, total_h = grad[rows].sum(), hess[rows].sum()
        if left and len(rows) >= 20:
            for f in range(bins.shape[1]):
                g = np.cumsum(np.bincount(bins[rows, f], grad[rows], BINS))[:-1]
                h = np.cumsum(np.bincount(bins[rows, f], hess[rows], BINS))[:-1]
                gain = g**2 / (h + 1) + (total_g - g) ** 2 / (total_h - h + 1) - total_g**2 / (total_h + 1)
                gain[(h < 1) | (total_h - h < 1)] = -1
                at = int(np.argmax(gain))
                if gain[at] > best[0]:
                    best = (gain[at], f, at)
        if best[0] <= 1e-6:
            out[rows] = -total_g / (total_h + 1)
            return
        _, f, at = best
        is_left = bins[rows, f] <= at
        for side, part in ((True, rows[is_left]), (False, rows[~is_left])):
            paths.append((*path, (f, at, side)))
            grow(part, paths[-1], left - 1)

    grow(np.arange(len(grad)), (), depth)
    return out, paths


def _lasso(x: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 250) -> tuple[np.ndarray, float]:
    """Lasso logistic regression by accelerated proximal gradient; the intercept is free."""
    n = len(y)
    v = np.ones(x.shape[1])
    for _ in range(12):
        v = x.T @ (x @ v)
        v /= np.linalg.norm(v) + 1e-12
    step = 4 * n / (float(np.linalg.norm(x.T @ (x @ v))) + n)
    w, b = np.zeros(x.shape[1]), float(np.log((y.mean() + 1e-9) / (1 - y.mean() + 1e-9)))
    zw, zb, t = w, b, 1.0
    for _ in range(rounds):
        r = 1 / (1 + np.exp(-np.clip(x @ zw + zb, -40, 40))) - y
        nw, nb = zw - step * (x.T @ r) / n, zb - step * r.mean()
        nw = np.sign(nw) * np.maximum(np.abs(nw) - step * penalty, 0)
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        zw, zb, w, b, t = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b), nw, nb, nt
    return w, float(b)


@dataclass
class RuleEnsemble:
    """intercept + weights of rules (conjunctions of (statistic, bound, is_below)) + clipped linear terms."""

    intercept: float = 0.0
    rules: list[tuple[float, tuple[tuple[str, float, bool], ...]]] = field(default_factory=list)
    linear: list[tuple[float, str, float, float]] = field(default_factory=list)

    def margin(self) -> Column:
        terms = F.lit(self.intercept)
        for weight, path in self.rules:
            holds = F.lit(True)
            for name, bound, below in path:
                holds = holds & ((F.col(name) <= bound) if below else (F.col(name) > bound))
            terms = terms + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        for weight, name, low, high in self.linear:
            terms = terms + F.lit(weight) * F.least(F.greatest(F.col(name), F.lit(low)), F.lit(high))
        return terms

    def score(self) -> Column:
        return 1 / (1 + F.exp(-F.greatest(F.least(self.margin(), F.lit(40.0)), F.lit(-40.0))))


def fit(values: np.ndarray, y: np.ndarray, names: list[str], seed: int = 7) -> RuleEnsemble:
    """The ensemble of a sample. Without rows the score is 0.5; with one class, its smoothed share."""
    if len(y) == 0 or y.min() == y.max():
        p = (y.sum() + 0.5) / (len(y) + 1)
        return RuleEnsemble(float(np.log(p / (1 - p))))
    cuts = [np.unique(np.quantile(values[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(values.shape[1])]
    bins = np.stack([np.searchsorted(c, values[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    margin, found = np.full(len(y), np.log((y.mean()) / (1 - y.mean()))), {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        out, paths = _tree(bins, p - y, p * (1 - p), DEPTH)
        margin = margin + RATE * out
        for path in paths:
            tight: dict[tuple[int, bool], int] = {}
            for f, at, left in path:
                tight[f, left] = min(tight.get((f, left), at), at) if left else max(tight.get((f, left), at), at)
            found[tuple(sorted((f, at, left) for (f, left), at in tight.items()))] = None
    rules = [r for r in found if all(at < len(cuts[f]) for f, at, _ in r)]
    hold = np.stack([np.logical_and.reduce([(bins[:, f] <= at) == left for f, at, left in r]) for r in rules], axis=1).astype(float) if rules else np.zeros((len(y), 0))
    low, high = np.quantile(values, 0.01, axis=0), np.quantile(values, 0.99, axis=0)
    clipped = np.clip(values, low, high)
    mean, scale = clipped.mean(axis=0), clipped.std(axis=0) / 0.4 + 1e-9
    x = np.concatenate([hold, (clipped - mean) / scale], axis=1)
    inner = np.random.default_rng(seed).random(len(y)) < 0.2
    best = (np.inf, 0.0)
    for penalty in (0.01, 0.003, 0.001, 0.0003):
        w, b = _lasso(x[~inner], y[~inner], penalty)
        z = x[inner] @ w + b
        loss = float(np.mean(np.logaddexp(0, z) - y[inner] * z)) if inner.any() else 0.0
        if loss < best[0] - 1e-4:
            best = (loss, penalty)
    w, b = _lasso(x, y, best[1])
    kept = [(float(w[i]), tuple((names[f], float(cuts[f][at]), left) for f, at, left in r)) for i, r in enumerate(rules) if w[i]]
    lin = w[len(rules) :] / scale
    linear = [(float(lin[f]), names[f], float(low[f]), float(high[f])) for f in range(len(names)) if lin[f]]
    return RuleEnsemble(b - float(lin @ mean), kept, linear)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE, seed: str = "quality-1") -> RuleEnsemble:
    """Fits on at most ``sample`` labelled rows outside the held-out fold.

    Rows with a null id or label do not take part, nor do labels of ids that
    no document has; an id with several labels counts by their mean. Which rows are in the sample goes by hashes of ids
    alone; a task sends about its share of the sample. The sample is bounded,
    so it may be broadcast and its statistics collected.
    """
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.col("__id").cast("string")).cast("binary"))
    known = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("double").alias("__y"))
    known = known.where(F.col("__id").isNotNull() & F.col("__y").isNotNull() & (fold(F.col("__id"), FOLDS) != HELD_OUT))
    known = known.groupBy("__id").agg((F.avg("__y") >= 0.5).cast("double").alias("__y"))
    known = known.join(docs.select(F.col(id_col).alias("__id")), "__id", "left_semi")  # labels of other documents are none
    known = seeded_sample(known, F.col("__id"), sample, seed)
    text = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    rows = text.join(F.broadcast(known), "__id")
    stats = statistics(F.col("__text"))
    rows = stored(rows.select("__id", "__y", *[c.alias(n) for n, c in stats.items()]))
    if (n := rows.count()) > sample:  # ids that many rows share
        rows = rows.where(F.pmod(F.xxhash64("__id", *stats), F.lit(1 << 30)) < (2 * sample << 30) // n)
    got = rows.orderBy(order, *stats).limit(sample).toPandas()
    return fit(got[list(stats)].to_numpy(float), got["__y"].to_numpy(float), list(stats))


def boxed_scores(docs: DataFrame, model: RuleEnsemble, text_col: str = "text") -> DataFrame:
    """(__row, __score): every row as a struct of its columns, whatever their names, and its score of 0 to 1.

    Null texts score as empty ones, repeated rows alike; texts of any length
    count whole. An empty table gives no rows.
    """
    stats = statistics(F.coalesce(part_of(text_col), F.lit("")))
    wide = boxed(docs).select("__row", *[c.alias(n) for n, c in stats.items()])
    return wide.select("__row", model.score().alias("__score"))


def scored(docs: DataFrame, model: RuleEnsemble, text_col: str = "text", name: str = "__score") -> DataFrame:
    """``docs`` with a column ``name``, which none of its own must have, as in :func:`boxed_scores`."""
    return boxed_scores(docs, model, text_col).select("__row.*", F.col("__score").alias(name))


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rows = boxed_scores(docs.select("doc_id", "text"), train(docs, labels))
    ident = part_of("doc_id")
    return rows.select(
        ident.alias("doc_id"),
        F.coalesce(fold(ident, FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        F.col("__score").alias("score"),
        F.when(F.col("__score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
