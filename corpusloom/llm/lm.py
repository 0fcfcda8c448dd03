"""LM scoring: a gated recurrent language model in numpy.

Counts of all training tokens come from the whole corpus. The most
frequent words that occur at least twice, ``VOCABULARY`` at most (a fixed
bound), are broadcast with their counts; all other words are "rare", and what their counts add to a
document's scores is found by a join on the word, so no word list of the
corpus is ever held in one place.

The model factors a token's probability by classes: P(class | h) and
P(word | class, h). The most frequent words form classes of equal size with a
softmax of their own; further bands of ranks, and the rare words, are classes
whose words go by their counts. Words that training never saw are one event, as
in the base: within the rare class it weighs as much as all words seen once.

Biases start from the counts of the whole corpus. Weights are fitted by
truncated backpropagation through windows of ``STEPS`` tokens over the complete
text of every training document: documents are dealt by id into shards of about
``SHARD`` tokens, shard 0 gives the starting point, then every shard trains on
from there in a task and the weights are averaged by tokens. Scoring carries the state
across windows from a document's first token to its end, so each score is the
log-likelihood of the complete text.
"""

from __future__ import annotations

import ctypes
import sys
from collections import Counter
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import fold
from corpusloom.storage import stored

FOLDS, HELD_OUT = 7, 2
END = b"\n"  # no word holds white space
VOCABULARY = 65_536
CLASSES, MEMBERS, BANDS = 32, 32, 12
HIDDEN = 24
STEPS, LANES = 32, 32
#: Tokens of a shard, about; lanes and rate of the shards' training; rows that add weights up.
SHARD, SHARD_LANES, SHARD_RATE, SUMS = 1_000_000, 256, 0.004, 8
#: Texts that are scored together, in bytes, and lanes that step together.
BLOCK, WIDE = 8 << 20, 1_024
#: Entries of a task's dictionary of counts before it is passed on.
FLUSH = 400_000


def tokens(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words, then the end."""
    return [*text.lower().split(), END]


@dataclass
class Vocabulary:
    """Frequent words by rank: id, count, and log10 of the share in a band."""

    ids: dict[bytes, int]
    log_count: np.ndarray
    input_id: np.ndarray
    band_log: np.ndarray
    n_bands: int

    def ranks(self, words: list[bytes]) -> np.ndarray:
        """The rank of each word, -1 where it is none of ours."""
        return np.fromiter(map(self.ids.get, words, repeat(-1)), np.int64, len(words))


def vocabulary(words: list[bytes], counts: list[int]) -> Vocabulary:
    """Of words in order of falling count. Input ids: head words, then bands, then rare."""
    n, head = len(words), CLASSES * MEMBERS
    c = np.array(counts, float)
    inputs, logs = np.arange(n), np.zeros(n)
    edges = np.unique(np.round(head * (max(n, head + 1) / head) ** (np.arange(BANDS + 1) / BANDS)).astype(int))
    for b, (i, j) in enumerate(zip(edges, edges[1:], strict=False)):
        inputs[i:j] = head + b
        logs[i:j] = np.log10(c[i:j] / c[i:j].sum()) if len(c[i:j]) else 0.0
    return Vocabulary({w: i for i, w in enumerate(words)}, np.log10(c + 1), inputs, logs, BANDS)


RARE = CLASSES * MEMBERS + BANDS
N_INPUT = RARE + 1
N_CLASS = CLASSES + BANDS + 1


@dataclass
class Gru:
    """gate_in: input id to gate sums; hidden: (H, 3H); then class and member layers."""

    gate_in: np.ndarray
    hidden: np.ndarray
    new_bias: np.ndarray
    to_class: np.ndarray
    class_bias: np.ndarray
    to_member: np.ndarray
    member_bias: np.ndarray

    def all(self) -> list[np.ndarray]:
        return [self.gate_in, self.hidden, self.new_bias, self.to_class, self.class_bias, self.to_member, self.member_bias]


def fresh(seed: int = 5) -> Gru:
    r, h = np.random.default_rng(seed), HIDDEN
    f = lambda *s, by=1.0: (r.normal(0, by, s)).astype(np.float32)
    return Gru(f(N_INPUT, 3 * h, by=0.3), f(h, 3 * h, by=h**-0.5), np.zeros(h, np.float32), f(h, N_CLASS, by=h**-0.5), np.zeros(N_CLASS, np.float32), f(CLASSES, h, MEMBERS, by=h**-0.5), np.zeros((CLASSES, MEMBERS), np.float32))


def class_of(inputs: np.ndarray) -> np.ndarray:
    head = CLASSES * MEMBERS
    return np.where(inputs < head, inputs // MEMBERS, inputs - head + CLASSES)


@dataclass
class Steps:
    """A model's weights as steps use them, those of gates with the other sign."""

    hidden: np.ndarray
    gate_in: np.ndarray
    new_bias: np.ndarray

    def sums(self, x: np.ndarray) -> np.ndarray:
        """Gate sums of a window's input ids, (steps, sums, lanes)."""
        return np.ascontiguousarray(self.gate_in[x].transpose(0, 2, 1))


def _steps(m: Gru) -> Steps:
    sign = np.where(np.arange(3 * HIDDEN) < 2 * HIDDEN, -1, 1).astype(m.hidden.dtype)
    return Steps(np.ascontiguousarray((m.hidden * sign).T), m.gate_in * sign, m.new_bias[:, None])


def _move(s: Steps, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """The next state, and what the way back needs, from gate sums and a state: a column a lane, so that all runs along lanes.

    Gates far below zero overflow on their way to zero; callers ignore that.
    """
    n, u = HIDDEN, s.hidden @ h
    gates, un = u[: 2 * n], u[2 * n :]
    gates += g[: 2 * n]
    np.exp(gates, out=gates)
    gates += 1
    np.reciprocal(gates, out=gates)
    z, r = gates[:n], gates[n:]
    un += s.new_bias
    new = r * un
    new += g[2 * n :]
    np.tanh(new, out=new)
    out = h - new
    out *= z
    out += new
    return out, z, r, un, new


def _step(m: Gru, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """:func:`_move` from input ids, with a row a lane."""
    s = _steps(m)
    with np.errstate(over="ignore"):
        return tuple(a.T for a in _move(s, s.sums(x[None])[0], h.T))


def _rows(a: np.ndarray) -> np.ndarray:
    """(steps, values, lanes) as a row a step and lane."""
    return a.transpose(0, 2, 1).reshape(-1, a.shape[1])


#: Of every input id, in the smallest integers, which sort fastest.
CLASS_OF = class_of(np.arange(N_INPUT)).astype(np.uint8)
#: Logits whose exponentials, and sums of them, are normal numbers in single precision.
TAME = 80


def _exp(z: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exponentials of rows in place, up to a factor a row: the logit at one place, and the sum."""
    if len(z) and not (z.max() < TAME and z.min() > -TAME):
        z -= z.max(axis=1, keepdims=True)
    held = z[np.arange(len(z)), at]
    np.exp(z, out=z)
    return held, z @ np.ones(z.shape[1], z.dtype)


def _logs_at(z: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The log-softmax of each row at one place; ``z`` is used up."""
    held, total = _exp(z, at)
    return held - np.log(total)


def _softmax(z: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, float]:
    """Probabilities of rows, in place, less one at ``at``, and the sum of the logs there."""
    held, total = _exp(z, at)
    z *= np.reciprocal(total)[:, None]
    z[np.arange(len(z)), at] -= 1
    return z, float(held.sum()) - float(np.log(total).sum())


def _by_class(cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of head classes in order of class, and where each class begins among them."""
    order = np.argsort(cls, kind="stable")
    cuts = np.cumsum([0, *np.bincount(cls, minlength=N_CLASS)[:CLASSES]])
    return order[: cuts[-1]], cuts


def _member_logits(m: Gru, own: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Of states in order of class."""
    z = np.empty((len(own), MEMBERS), own.dtype)
    for k in range(CLASSES):
        part = z[cuts[k] : cuts[k + 1]]
        np.matmul(own[cuts[k] : cuts[k + 1]], m.to_member[k], out=part)
        part += m.member_bias[k]
    return z


def token_logs(m: Gru, h: np.ndarray, x: np.ndarray) -> np.ndarray:
    """ln P(input id | state) of rows, up to the share inside a band or the rare class."""
    cls = CLASS_OF[x]
    z = h @ m.to_class
    z += m.class_bias
    out = _logs_at(z, cls)
    rows, cuts = _by_class(cls)
    if len(rows):
        out[rows] += _logs_at(_member_logits(m, h[rows], cuts), x[rows] % MEMBERS)
    return out


def _window(m: Gru, x: np.ndarray, keep: np.ndarray, h: np.ndarray) -> tuple[float, list[np.ndarray], np.ndarray]:
    """Loss and gradients of a window: x (steps + 1, lanes); keep 0 where a text begins.

    Position t predicts x[t] from the state that x[:t] left; the gradient
    stops at the window's start, the state goes on.
    """
    n, (steps, lanes) = HIDDEN, x.shape
    grads = [np.zeros_like(p) for p in m.all()]
    states, kept, h = np.empty((steps, n, lanes), m.hidden.dtype), [], h.T
    s = _steps(m)
    sums = s.sums(x)
    with np.errstate(over="ignore"):
        for t in range(steps):
            np.multiply(h, keep[t], out=states[t])
            kept.append(_move(s, sums[t], states[t]))
            h = kept[-1][0]
    flat, target = _rows(states), x.ravel()
    cls = CLASS_OF[target]
    z = flat @ m.to_class
    z += m.class_bias
    d, logs = _softmax(z, cls)
    loss = -logs
    back = d @ m.to_class.T
    grads[3], grads[4] = flat.T @ d, np.ones(len(d), d.dtype) @ d
    rows, cuts = _by_class(cls)
    if len(rows):
        own = flat[rows]
        d, logs = _softmax(_member_logits(m, own, cuts), target[rows] % MEMBERS)
        loss -= logs
        more, ones = np.empty_like(own), np.ones(len(own), own.dtype)
        for k in range(CLASSES):
            part = slice(cuts[k], cuts[k + 1])
            np.matmul(d[part], m.to_member[k].T, out=more[part])
            grads[5][k], grads[6][k] = own[part].T @ d[part], ones[part] @ d[part]
        back[rows] += more
    back = np.ascontiguousarray(back.reshape(steps, lanes, n).transpose(0, 2, 1))
    dh = np.zeros_like(h)
    du, new_sums = np.empty((steps, 3 * n, lanes), m.hidden.dtype), np.empty((steps, n, lanes), m.hidden.dtype)
    for t in range(steps - 1, -1, -1):
        _, z, r, un, new = kept[t]
        low = 1 - z
        dn = np.multiply(new, new, out=new_sums[t])
        np.subtract(1, dn, out=dn)
        dn *= low
        dn *= dh
        low *= z
        low *= dh
        np.multiply(states[t] - new, low, out=du[t, :n])
        dr = np.multiply(dn, r, out=du[t, 2 * n :])
        dr = np.multiply(dr, un, out=du[t, n : 2 * n])
        dr *= 1 - r
        dh *= z
        dh += m.hidden @ du[t]
        dh += back[t]
        dh *= keep[t]
    du = _rows(du)
    grads[1], grads[2] = flat.T @ du, np.ones(len(du), du.dtype) @ du[:, 2 * n :]
    du[:, 2 * n :] = _rows(new_sums)
    order = np.argsort(target.astype(np.uint16), kind="stable")
    per_kind = np.bincount(target, minlength=N_INPUT)
    kinds = np.flatnonzero(per_kind)
    first = np.cumsum(per_kind[kinds]) - per_kind[kinds]
    grads[0][kinds] = np.add.reduceat(du[order], first, axis=0)
    return float(loss), grads, h.T


def _keep_memory() -> None:
    """Has the C library keep freed blocks: a window's arrays are needed again at once, and fresh pages cost a fifth of its time."""
    if sys.platform == "linux" and hasattr(libc := ctypes.CDLL(None), "mallopt"):
        libc.mallopt(-3, 32 << 20)  # M_MMAP_THRESHOLD
        libc.mallopt(-1, 64 << 20)  # M_TRIM_THRESHOLD


def fit(texts: list[np.ndarray], seed: int = 5, rate: float = 0.008, rounds: int = 2, lanes: int = LANES, start: Gru | None = None) -> Gru:
    """Adam on lanes of joined texts (arrays of input ids), from ``start`` on if it is given."""
    m, rng, most = fresh(seed), np.random.default_rng(seed), lanes
    if start is not None:
        m = Gru(*[p.copy() for p in start.all()])
    if not texts:
        return m
    if start is None:
        counts = np.bincount(class_of(np.concatenate(texts)), minlength=N_CLASS) + 1.0
        m.class_bias += np.log(counts / counts.sum()).astype(np.float32)
    first, second, step = [np.zeros_like(p) for p in m.all()], [np.zeros_like(p) for p in m.all()], 0
    total = sum(map(len, texts)) * rounds // (most * STEPS) + 1
    for _ in range(rounds):
        order = rng.permutation(len(texts))
        x = np.concatenate([texts[i] for i in order])
        keep = np.ones(len(x), np.float32)
        keep[np.cumsum([0, *(len(texts[i]) for i in order[:-1])])] = 0
        lanes = min(most, len(x))
        size = -(-len(x) // lanes)
        lanes = -(-len(x) // size)
        fill = size * lanes - len(x)  # the last lane ends with the first tokens again, so that none is left out
        x, keep = np.concatenate([x, x[:fill]]), np.concatenate([keep, keep[:fill]])
        x, keep = x.reshape(lanes, size).T, keep.reshape(lanes, size).T.copy()
        keep[0] = 0
        h = np.zeros((lanes, HIDDEN), np.float32)
        for a in range(0, size, STEPS):
            _, grads, h = _window(m, x[a : a + STEPS], keep[a : a + STEPS], h)
            step += 1
            n = x[a : a + STEPS].size
            now = rate * max(0.05, 1 - step / total)
            for p, g, f, s in zip(m.all(), grads, first, second, strict=True):
                g /= n
                f *= np.float32(0.9)
                s *= np.float32(0.99)
                f += np.float32(0.1) * g
                np.square(g, out=g)
                g *= np.float32(0.01)
                s += g
                np.divide(s, np.float32(1 - 0.99**step), out=g)
                np.sqrt(g, out=g)
                g += np.float32(1e-7)
                np.divide(f, g, out=g)
                g *= np.float32(now / (1 - 0.9**step))
                p -= g
    return m


def score_texts(m: Gru, texts: list[np.ndarray]) -> np.ndarray:
    """ln P of whole texts (arrays of input ids), the state carried from window to window."""
    out = np.zeros(len(texts))
    s = _steps(m)
    sizes = np.array([len(t) for t in texts])
    order = np.argsort(-sizes, kind="stable")
    joined = np.concatenate([*texts, np.zeros(STEPS, np.int32)])
    begin = np.cumsum(sizes) - sizes
    for a in range(0, len(order), WIDE):
        rows = order[a : a + WIDE]
        size, at = sizes[rows], begin[rows]
        h = np.zeros((HIDDEN, len(rows)), np.float32)
        for start in range(0, size[0], STEPS):
            live = int(np.searchsorted(-size, -start))
            steps = min(STEPS, int(size[0]) - start)
            x = joined[np.minimum(at[None, :live] + start + np.arange(steps)[:, None], len(joined) - 1)]
            h, states = h[:, :live], np.empty((steps, HIDDEN, live), np.float32)
            sums = s.sums(x)
            with np.errstate(over="ignore"):
                for t in range(steps):
                    states[t] = h
                    if start + t + 1 < size[0]:
                        h = _move(s, sums[t], h)[0]
            full = int(np.searchsorted(-size, -(start + steps), side="right"))  # texts that fill the window, the first ones
            if full:
                out[rows[:full]] += token_logs(m, _rows(states[:, :, :full]), x[:, :full].reshape(-1)).reshape(steps, full).sum(axis=0, dtype=float)
            if full < live:
                real = np.arange(steps)[:, None] < (size[full:live] - start)[None, :]
                logs = np.zeros(real.shape)
                logs[real] = token_logs(m, states.transpose(0, 2, 1)[:, full:][real], x[:, full:][real])
                out[rows[full:live]] += logs.sum(axis=0)
    return out


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) over all training documents; null texts count as empty, null ids are not trained on."""
    train = docs.where(F.col(id_col).isNotNull() & (fold(F.col(id_col), FOLDS) != HELD_OUT))
    text = train.select(F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("__text"))

    def run(batches):
        known: Counter[bytes] = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(list(known), pa.binary()), pa.array(list(known.values()), pa.int64())], names=["word", "n"])
            known.clear()
            return out

        for b in batches:
            for t in b.column(0):
                known.update(tokens(t.as_py()))
                if len(known) > FLUSH:
                    yield flush()
        if known:
            yield flush()

    return stored(text.mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n")))


def _least(counts: DataFrame) -> int:
    """The smallest count, 2 or more, that at most VOCABULARY words reach, to an eighth of a power of two."""
    bins = counts.where("n >= 2").groupBy(F.floor(F.log2("n") * 8).alias("b")).agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("n")).collect()  # 512 rows at most
    reach, least = 0, 1 << 62
    for r in sorted(bins, key=lambda r: -r["b"]):
        reach += r["k"]
        if reach > VOCABULARY:
            break
        least = r["n"]
    return least


def from_counts(vocab: Vocabulary, counts: list[int], n_rare: int) -> Gru:
    """Fresh weights whose biases give classes and head words their shares of the whole corpus."""
    m, head = fresh(), CLASSES * MEMBERS
    n = np.bincount(vocab.input_id, weights=counts, minlength=N_INPUT) + 1.0
    n[RARE] += n_rare
    by_class = np.bincount(class_of(np.arange(N_INPUT)), weights=n, minlength=N_CLASS)
    m.class_bias += np.log(by_class / by_class.sum()).astype(np.float32)
    members = n[:head].reshape(CLASSES, MEMBERS)
    m.member_bias += np.log(members / members.sum(axis=1, keepdims=True)).astype(np.float32)
    return m


def trained(docs: DataFrame, vocab: Vocabulary, start: Gru, n_all: int, id_col: str, text_col: str) -> Gru:
    """``start`` trained on the complete text of every training document; the driver gets SUMS rows of weights a pass."""
    spark = docs.sparkSession
    shards = -(-int(n_all) // SHARD)
    if not shards:
        return start
    key = F.col(id_col).cast("string")
    train = docs.where(F.col(id_col).isNotNull() & (fold(F.col(id_col), FOLDS) != HELD_OUT))
    train = train.select(F.pmod(F.xxhash64(key), F.lit(shards)).cast("int").alias("__shard"), F.xxhash64(F.lit("lm-1"), key).alias("__at"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("__text"))

    def averaged(rows: DataFrame, tasks: int, start: Gru, rounds: int, lanes: int, rate: float) -> Gru:
        shared = spark.sparkContext.broadcast((vocab, start))
        rows = rows.repartition(tasks, "__shard").sortWithinPartitions("__shard", "__at", "__text")

        def run(batches):
            _keep_memory()
            vocab, start = shared.value
            inputs = np.append(vocab.input_id, RARE).astype(np.int32)  # rank -1 is the last
            now, texts = None, []

            def weights():
                n = sum(map(len, texts))
                flat = np.concatenate([p.ravel() for p in fit(texts, rate=rate, rounds=rounds, lanes=lanes, start=start).all()]).astype(float) * n
                return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([n], pa.int64()), pa.array([flat.tobytes()], pa.binary())], names=["shard", "n", "w"])

            for b in batches:
                for shard, text in zip(b.column(0).to_pylist(), b.column(2), strict=True):
                    if shard != now and texts:
                        yield weights()
                        texts = []
                    now = shard
                    words = tokens(text.as_py())
                    texts.append(inputs[vocab.ranks(words)])
            if texts:
                yield weights()

        def add(batches):
            n, total = 0, 0.0
            for b in batches:
                for k, w in zip(b.column(1).to_pylist(), b.column(2), strict=True):
                    n, total = n + k, total + np.frombuffer(w.as_py())
            if n:
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["n", "w"])

        parts = rows.mapInArrow(run, "shard int, n bigint, w binary")
        sums = parts.repartition(SUMS, "shard").sortWithinPartitions("shard").mapInArrow(add, "n bigint, w binary").collect()  # SUMS rows at most
        if not sums:
            return start
        flat, at, out = sum(np.frombuffer(r["w"]) for r in sums) / sum(r["n"] for r in sums), 0, []
        for p in start.all():
            out.append(flat[at : at + p.size].reshape(p.shape).astype(np.float32))
            at += p.size
        return Gru(*out)

    first = averaged(train.where("__shard = 0"), 1, start, 2, LANES, 0.008)
    return averaged(train, shards, first, 1, SHARD_LANES, SHARD_RATE) if shards > 1 else first


def scored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(__id, n_tokens, n_known, train_tokens, base_score, score, rare_tokens) of every row.

    A null text is an empty one: its only token is the end. Rows with a null
    id are scored, not trained on. Repeated rows come back repeated. Without
    training rows every word is unknown and the weights are untrained. An
    empty table gives no rows.
    """
    spark = docs.sparkSession
    counts = word_counts(docs, id_col, text_col)
    n_all, n_kinds, n_once = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.count_if(F.col("n") == 1)).first()
    top = counts.where(F.col("n") >= _least(counts)).collect()  # VOCABULARY rows at most
    top.sort(key=lambda r: (-r["n"], r["word"]))
    vocab = vocabulary([bytes(r["word"]) for r in top], [r["n"] for r in top])
    n_rare = n_all - sum(r["n"] for r in top)
    unseen = n_once / (n_rare + n_once) if n_rare else 1.0

    model = trained(docs, vocab, from_counts(vocab, [r["n"] for r in top], n_rare), n_all, id_col, text_col)
    shared = spark.sparkContext.broadcast((vocab, model))

    rows = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("__text"))
    rows = rows.withColumn("__row", F.monotonically_increasing_id())

    def run(batches):
        _keep_memory()
        vocab, model = shared.value
        to_input = np.append(vocab.input_id, RARE).astype(np.int32)  # rank -1 is the last
        log_count, band_log = np.append(vocab.log_count, 0.0), np.append(vocab.band_log, 0.0)

        def flush(block):
            """One pass over a block: what frequent words give, and each text's rare words with their counts."""
            kinds: dict[bytes, int] = {}
            of = [kinds.setdefault(t, len(kinds)) for _, _, t in block]
            inputs, sums, rares = [], [], []
            for text in kinds:
                words = tokens(text)
                known = vocab.ranks(words)
                rare: dict[bytes, int] = {}
                for i in np.flatnonzero(known < 0).tolist():
                    rare[words[i]] = rare.get(words[i], 0) + 1
                inputs.append(to_input[known])
                sums.append((len(words), len(words) - sum(rare.values()), float(log_count[known].sum()), float(band_log[known].sum())))
                rares.append(rare)
            logs = score_texts(model, inputs) / np.log(10)
            cols = [[b[0] for b in block], [b[1] for b in block]] + [[sums[k][j] for k in of] for j in range(4)] + [[logs[k] for k in of]]
            cols.append([list(rares[k]) for k in of])
            cols.append([list(rares[k].values()) for k in of])
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, shape, strict=True)], schema=shape)

        shape = None
        for b in batches:
            if shape is None:
                shape = pa.schema([("__id", b.schema.field(0).type), ("__row", pa.int64()), ("n_tokens", pa.int64()), ("__known", pa.int64()), ("__base", pa.float64()), ("__band", pa.float64()), ("__gru", pa.float64()), ("__rare", pa.list_(pa.binary())), ("__n", pa.list_(pa.int64()))])
            block, size = [], 0
            for i, t, r in zip(b.column(0), b.column(1), b.column(2), strict=True):
                block.append((i.as_py(), r.as_py(), t.as_py()))
                size += len(block[-1][2])
                if size > BLOCK:
                    yield flush(block)
                    block, size = [], 0
            if block:
                yield flush(block)

    kind = dict(docs.dtypes)[id_col]
    part = stored(rows.select("__id", "__text", "__row").mapInArrow(run, f"__id {kind}, __row bigint, n_tokens bigint, __known bigint, __base double, __band double, __gru double, __rare array<binary>, __n array<bigint>"))
    rare = part.select("__row", F.explode(F.arrays_zip("__rare", "__n")).alias("__r")).select("__row", F.col("__r.__rare").alias("word"), F.col("__r.__n").alias("__tf"))
    rare = rare.join(counts, "word", "left")
    seen_log = F.log10(F.col("n") / F.lit(float(max(n_rare, 1))) * F.lit(max(1 - unseen, 1e-300)))
    unseen_log = float(np.log10(unseen)) if unseen > 0 else -300.0
    rare = rare.groupBy("__row").agg(
        F.sum("__tf").alias("__r_n"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("__tf")).otherwise(0)).alias("__r_known"),
        F.sum(F.col("__tf") * F.log10(F.coalesce("n", F.lit(0)) + 1.0)).alias("__r_base"),
        F.sum(F.col("__tf") * F.when(F.col("n").isNotNull(), seen_log).otherwise(F.lit(unseen_log))).alias("__r_log"),
    )
    both = part.drop("__rare", "__n").join(rare, "__row", "left")
    nil = lambda c: F.coalesce(F.col(c), F.lit(0))
    return both.select(
        "__id",
        "n_tokens",
        (F.col("__known") + nil("__r_known")).cast("long").alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("__base") + nil("__r_base") - F.col("n_tokens") * F.lit(float(np.log10(n_all + n_kinds + 1)))).alias("base_score"),
        (F.col("__gru") + F.col("__band") + nil("__r_log")).alias("score"),
        nil("__r_n").cast("long").alias("rare_tokens"),
    )


def query(docs: DataFrame) -> DataFrame:
    held = F.coalesce(fold(F.col("__id"), FOLDS) == HELD_OUT, F.lit(False))
    return scored(docs).select(F.col("__id").alias("doc_id"), held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "rare_tokens")
