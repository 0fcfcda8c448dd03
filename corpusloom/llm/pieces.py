"""SentencePiece encoding and decoding: forward filtering, backward sampling.

The lattice of a text has a node for every piece at every position where it
matches. Forward filtering sums the weights of all segmentations up to each
position; backward sampling walks from the end, choosing each last piece with
its exact posterior probability. Uniforms come from a hash of the row key and
the position, so a row's segmentation does not depend on partitions or reruns.

No piece goes on after a space or over a line feed, so the lattice falls into
independent words at those points, with the same distribution as the whole.
Words of a block are filtered together, by length, in numpy.

Characters outside the vocabulary, and a literal U+2581, become byte pieces, so
decoding gives back every text exactly. The vocabulary's file is a parameter;
it is read on the driver, and its 32,000 pieces (a fixed size) are broadcast.
The file gives ranks, not probabilities: a piece's weight follows Zipf's law.
"""

from __future__ import annotations

import hashlib
import math
import re
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE_MARK = "▁"
WORDS = re.compile(r"\n| *[^ \n]+| +")
#: Longer words take the way that needs memory in proportion to their length; draws that it makes at once.
LONG, DRAWS = 40, 1 << 14
#: Characters that are segmented at once.
BLOCK = 1 << 21
FALLBACK_LOG = -12.0
SEED = 20_011


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass
class Vocabulary:
    """Trie transitions as sorted integers, log weights, and each id's bytes."""

    keys: np.ndarray
    nexts: np.ndarray
    piece: np.ndarray
    weight: np.ndarray
    data: list[bytes]
    byte_ids: np.ndarray
    longest: int
    ids: dict[str, int]


def load(path: str | None = None) -> Vocabulary:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path or vocabulary_path())
    n = sp.get_piece_size()
    byte_ids, ids, data = np.full(256, -1), {}, [b""] * n
    for i in range(n):
        p = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(p[3:5], 16)] = i
            data[i] = bytes([int(p[3:5], 16)])
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            text = p.replace(SPACE_MARK, " ")
            if " " in text.lstrip(" ") or "\n" in text:
                raise ValueError(f"piece {i} goes on after a space or a line feed")
            ids[text], data[i] = i, text.encode()
    if (byte_ids < 0).any():
        raise ValueError("the vocabulary has no byte pieces")
    by_rank = sorted(ids.values(), key=lambda i: (-sp.get_score(i), i))
    weight = np.full(n, FALLBACK_LOG)
    rank = np.arange(2, len(by_rank) + 2)
    weight[by_rank] = -np.log(rank) - np.log((1 / rank).sum())
    steps, states, ends = {}, 1, {0: -1}
    for text, i in ids.items():
        at = 0
        for c in text:
            key = at << 21 | ord(c)
            if key not in steps:
                steps[key], states = states, states + 1
            at = steps[key]
        ends[at] = i
    keys = np.array(sorted(steps), np.int64)
    piece = np.array([ends.get(s, -1) for s in range(states)], np.int64)
    return Vocabulary(keys, np.array([steps[k] for k in keys.tolist()], np.int64), piece, weight, data, byte_ids, max(map(len, ids)), ids)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(key: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A uniform in (0, 1) for a row key and a position."""
    h = _mix(key + _mix(at.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)))
    return (h >> np.uint64(11)).astype(float) / 2.0**53 + 2.0**-54


def _filter(v: Vocabulary, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For words of one length (words, n) of code points: piece and forward weights.

    ids[i, j]: the piece over [i, j), -1 none, -2 byte pieces; logs: its weight
    plus the forward weight of i; total[j]: the forward weight of j. Word last.
    """
    m, n = chars.shape
    ids = np.full((n, n + 1, m), -1, np.int32)
    for i in range(n):
        alive, state = np.arange(m), np.zeros(m, np.int64)
        for j in range(i, min(n, i + v.longest)):
            key = state << 21 | chars[alive, j]
            at = np.minimum(np.searchsorted(v.keys, key), len(v.keys) - 1)
            ok = v.keys[at] == key
            alive, state = alive[ok], v.nexts[at[ok]]
            if not len(alive):
                break
            ids[i, j + 1, alive] = v.piece[state]
        ids[i, i + 1] = np.where(ids[i, i + 1] < 0, -2, ids[i, i + 1])
    size = np.where(chars < 0x80, 1, np.where(chars < 0x800, 2, np.where(chars < 0x10000, 3, 4)))
    logs, total = np.full((n, n + 1, m), -np.inf), np.zeros((n + 1, m))
    for j in range(1, n + 1):
        top = np.full(m, -np.inf)
        low = max(0, j - v.longest)
        for i in range(low, j):
            w = np.where(ids[i, j] >= 0, v.weight[ids[i, j]], -np.inf)
            if i == j - 1:
                w = np.where(ids[i, j] == -2, FALLBACK_LOG * size[:, i], w)
            logs[i, j] = w + total[i]
            top = np.maximum(top, logs[i, j])
        s = np.zeros(m)
        for i in range(low, j):
            s += np.exp(logs[i, j] - top)
        total[j] = top + np.log(s)
    return ids, logs, total


def _long_word(v: Vocabulary, word: str, key: np.uint64, start: int) -> tuple[list[tuple[int, int]], float]:
    """(position, piece) of one sampled segmentation of a long word, and its log weight.

    The same draw as that of ``_filter``'s way. Of the lattice only the forward
    weights are kept, a number a character; edges are found again on the way back.
    """
    n, total = len(word), array("d", [0.0])

    def edges(j: int) -> list[tuple[float, int, int]]:
        found = [(i, v.ids[word[i:j]]) for i in range(max(0, j - v.longest), j) if word[i:j] in v.ids]
        steps = [(total[i] + float(v.weight[p]), i, p) for i, p in found]
        if not found or found[-1][0] != j - 1:
            steps.append((total[j - 1] + FALLBACK_LOG * len(word[j - 1].encode("utf-8", "surrogatepass")), j - 1, -2))
        return steps

    for j in range(1, n + 1):
        steps = edges(j)
        top = max(s for s, _, _ in steps)
        total.append(top + math.log(sum(math.exp(s - top) for s, _, _ in steps)))
    out, j, log, draws, low = [], n, 0.0, [], n + 1
    while j:
        if j < low:
            low = max(0, j - DRAWS)
            draws = _uniform(np.full(j + 1 - low, key), start + np.arange(low, j + 1)).tolist()
        left = draws[j - low]
        for s, i, p in edges(j):
            left -= math.exp(s - total[j])
            if left < 0:
                break
        out.append((i, p))
        log += s - total[i]
        j = i
    return out, log


def sample(v: Vocabulary, texts: list[str], keys: np.ndarray) -> list[tuple[np.ndarray, float]]:
    """For each text one segmentation drawn from its lattice: ids, and the log weight of the draw.

    A space goes before every text, as the vocabulary expects; ``decode``
    takes it away again.
    """
    texts = [" " + t for t in texts]
    words = [WORDS.findall(t) for t in texts]
    counts = np.array([len(w) for w in words])
    kinds: dict[str, int] = {}
    of = np.array([kinds.setdefault(w, len(kinds)) for ws in words for w in ws], np.int64)
    kind_len = np.array([len(w) for w in kinds], np.int64)
    sizes = kind_len[of]
    start = np.cumsum(sizes) - sizes  # in all texts joined
    doc = np.repeat(np.arange(len(texts)), counts)
    doc_start = np.cumsum([0, *map(len, texts)])[:-1]
    at_doc = start - doc_start[doc]
    tokens = np.full(int(sizes.sum()), -1, np.int32)
    logs = np.zeros(len(texts))
    names = list(kinds)
    by_len: dict[int, list[int]] = {}
    for k, n in enumerate(kind_len.tolist()):
        by_len.setdefault(n, []).append(k)
    local = np.zeros(len(names), np.int64)
    order = np.argsort(sizes, kind="stable")
    ordered = sizes[order]
    bounds = {n: (np.searchsorted(ordered, n), np.searchsorted(ordered, n, side="right")) for n in by_len}
    for n, members in by_len.items():
        rows = order[slice(*bounds[n])]
        if n > LONG:
            for r in rows.tolist():
                cut, log = _long_word(v, names[of[r]], keys[doc[r]], int(at_doc[r]))
                logs[doc[r]] += log
                for i, p in cut:
                    tokens[start[r] + i] = p
            continue
        step = max(1, (1 << 22) // (n * (n + 1)))  # bounds the arrays of _filter
        local[members] = np.arange(len(members))
        place = local[of[rows]]
        near = np.argsort(place, kind="stable")
        rows, place = rows[near], place[near]
        for a in range(0, len(members), step):
            part = members[a : a + step]
            chars = np.frombuffer("".join(names[k] for k in part).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(part), n).astype(np.int64)
            ids, weight, total = _filter(v, chars)
            cut = slice(np.searchsorted(place, a), np.searchsorted(place, a + len(part)))
            row, kind = rows[cut], place[cut] - a
            chance = np.exp(weight - total[None]).transpose(2, 1, 0)  # (word, end, begin)
            last = n - 1 - (chance[:, :, ::-1] > 0).argmax(axis=2)
            upto = np.cumsum(chance, axis=2)
            np.put_along_axis(upto, last[:, :, None], 2.0, axis=2)  # so that rounding can't go past it
            end = np.full(len(row), n)
            while len(row):
                u = _uniform(keys[doc[row]], at_doc[row] + end)
                begin = np.argmax(upto[kind, end] > u[:, None], axis=1)
                tokens[start[row] + begin] = ids[begin, end, kind]
                logs += np.bincount(doc[row], weight[begin, end, kind] - total[begin, kind], len(texts))
                go = begin > 0
                row, kind, end = row[go], kind[go], begin[go]
    at = np.flatnonzero(tokens != -1)
    got = tokens[at]
    if (got == -2).any():
        joined = "".join(texts)
        odd = np.flatnonzero(got == -2)
        wide = [v.byte_ids[list(joined[i].encode("utf-8", "surrogatepass"))] for i in at[odd].tolist()]
        reps = np.ones(len(got), np.int64)
        reps[odd] = [len(w) for w in wide]
        at, got = np.repeat(at, reps), np.repeat(got, reps)
        got[got == -2] = np.concatenate(wide)
    cuts = np.searchsorted(at, doc_start[1:])
    return list(zip(np.split(got.astype(np.int32), cuts), logs.tolist(), strict=True))


def decode(v: Vocabulary, ids: np.ndarray) -> bytes:
    """The UTF-8 text of ids, without the space that encoding put before it."""
    return b"".join(map(v.data.__getitem__, ids.tolist()))[1:]


def encoded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, seed: int = SEED) -> DataFrame:
    """(__id, __ids, __log, __text_sha, __back_sha) of every row.

    ``__ids`` are the piece ids of the sampled segmentation of the whole text
    (null: empty; an empty text has one piece, the space before it). The
    hashes are of the text and of the decoded ids. Rows with one id and one
    text get one segmentation; null ids draw as one key. Texts of any length are
    segmented whole, in memory of their length; repeated rows come back
    repeated; other columns don't matter. An empty table gives no rows.
    """
    key = F.xxhash64(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("null")))
    rows = docs.select(F.col(id_col).alias("__id"), key.alias("__key"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    shared = docs.sparkSession.sparkContext.broadcast(load(path))

    def run(batches):
        v = shared.value

        def flush(block):
            ids = sample(v, [t for _, _, t in block], np.array([k for _, k, _ in block], np.int64).view(np.uint64))
            texts = [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for _, _, t in block]
            back = [hashlib.sha256(decode(v, i)).hexdigest() for i, _ in ids]
            sizes = np.cumsum([0, *(len(i) for i, _ in ids)])
            lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.concatenate([i for i, _ in ids])))
            return pa.RecordBatch.from_arrays([pa.array([i for i, _, _ in block], kind), lists, pa.array([x for _, x in ids]), pa.array(texts), pa.array(back)], names=["__id", "__ids", "__log", "__text_sha", "__back_sha"])

        for b in batches:
            kind, block, size = b.schema.field(0).type, [], 0
            for i, k, t in zip(b.column(0), b.column(1), b.column(2), strict=True):
                block.append((i.as_py(), k.as_py(), t.as_py()))
                size += len(block[-1][2])
                if size > BLOCK:
                    yield flush(block)
                    block, size = [], 0
            if block:
                yield flush(block)

    return rows.mapInArrow(run, f"__id {dict(docs.dtypes)[id_col]}, __ids array<int>, __log double, __text_sha string, __back_sha string")


def query(docs: DataFrame, path: str | None = None) -> DataFrame:
    return encoded(docs, path=path).select(
        F.col("__id").alias("doc_id"),
        F.size("__ids").cast("long").alias("n_pieces"),
        F.sha2(F.array_join("__ids", " ").cast("binary"), 256).alias("pieces_sha256"),
        F.col("__log").alias("log_weight"),
        F.col("__back_sha").alias("decoded_sha256"),
        (F.col("__back_sha") == F.col("__text_sha")).alias("lossless"),
    )
