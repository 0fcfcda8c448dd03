"""Cross-tokenizer alignment: an event sweep over the ends of two tokenizers' tokens.

Each token's end is an event (side, byte offset, token). A text's events travel
in runs: the ids of up to ``RUN`` tokens of one side, from a byte offset on; the
offsets follow from the tokens' lengths. Both sides' runs are dealt by document
and sorted by offset, and a machine sweeps each partition's stream: every
distinct offset is a link of the two current tokens, and an offset where both
sides end closes a group. What it keeps is what no group has closed yet, two
runs as a rule, and the distinct links of the document at hand.

How many documents hold an id pair linked is summed in the tasks, then by
shuffle. Up to ``TABLE`` pairs the table is broadcast; a larger one is dealt by
ids, and each part meets the documents' links of these ids in a stream.

No token goes on from a character that is no white space to a space, so texts
are encoded by the pieces between such points, each distinct one once a batch.
Vocabulary files are read on the driver; their bytes (2 MB) go to the tasks.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.storage import stored

#: How the byte-level vocabulary splits texts before merging; a fixed value of that format.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: From a space after a character that is none to the next one.
PIECES = re.compile(r" \s*(?:\S+(?:[^\S ]\s*\S+)*(?:[^\S ]\s*)?)?")
#: Tokens of a run, tokens that are swept and characters that are encoded at once.
RUN, BLOCK, BATCH = 1 << 15, 1 << 20, 1 << 20
#: Pieces, and their characters, that a task remembers.
KNOWN, KNOWN_CHARS = 300_000, 1 << 24
#: Id pairs (12 bytes each) that are broadcast at most; those of a part and the shares of documents beyond.
TABLE, PART, SHARES = 1 << 22, 1 << 18, 16
#: Distinct pairs that a counting task holds.
HELD = 1 << 21


def paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _letters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 itself, the others from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_tokens(data: bytes) -> dict[bytes, int]:
    """Bytes to id of a byte-level vocabulary without its special tokens, ids in merge order."""
    file, letters = json.loads(data), _letters()
    special = {t["content"] for t in file.get("added_tokens", [])}
    vocab = file["model"]["vocab"]
    for i, pair in enumerate(file["model"]["merges"]):
        if vocab["".join(pair.split(" ") if isinstance(pair, str) else pair)] != 256 + i:
            raise ValueError("ids of the byte-level vocabulary are not in merge order")
    return {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in special}


class Encoders:
    """Both tokenizers, the bytes of their tokens, and the pieces met so far."""

    def __init__(self, a: bytes, b: bytes):
        import sentencepiece
        import tiktoken

        ranks = byte_tokens(a)
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        n = self.b.get_piece_size()
        if max(n, max(ranks.values()) + 1) > 1 << 16:
            raise ValueError("ids of more than 16 bits")
        self.a_bytes, self.b_bytes = {i: t for t, i in ranks.items()}, {}
        for i in range(n):
            if self.b.is_byte(i):
                self.b_bytes[i] = bytes([int(self.b.id_to_piece(i)[3:5], 16)])
            elif not (self.b.is_control(i) or self.b.is_unknown(i)):
                text = self.b.id_to_piece(i).replace("▁", " ")
                if " " in text.lstrip(" "):
                    raise ValueError(f"piece {i} goes on after a space")
                self.b_bytes[i] = text.encode()
        self.space = self.b.piece_to_id("▁")
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.chars, self.ids, self.ends, self.good = 0, (array("H"), array("H")), (array("q", [0]), array("q", [0])), array("b")

    def learn(self, pieces: list[str]) -> None:
        """Encodes pieces, each beginning with a space, and whether both sides' bytes are theirs."""
        of_b = self.b.encode([p[1:] for p in pieces], num_threads=1)
        for p, b in zip(pieces, of_b, strict=True):
            raw, a = p.encode(), self.a.encode_ordinary(p)
            b = b if len(p) > 1 else [self.space]
            same = b"".join(map(self.a_bytes.__getitem__, a)) == raw == b"".join([self.b_bytes.get(i, b"\0\0") for i in b])
            for side, ids in enumerate((a, b) if same else ((), ())):
                self.ids[side].extend(ids)
                self.ends[side].append(len(self.ids[side]))
            self.good.append(same)
            self.known[p] = len(self.known)
            self.chars += len(p)

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of space + text by either; none where the text is empty or the bytes differ."""
        if len(self.known) > KNOWN or self.chars > KNOWN_CHARS:
            self.forget()
        split = [PIECES.findall(" " + t) if t else [] for t in texts]
        if any(sum(map(len, p)) != len(t) + 1 for p, t in zip(split, texts, strict=True) if t):
            raise AssertionError("pieces don't make up the text")
        self.learn([p for p in dict.fromkeys(p for s in split for p in s) if p not in self.known])
        good = np.array(self.good, bool)
        ids, ends = [np.array(x, np.uint16) for x in self.ids], [np.array(x, np.int64) for x in self.ends]
        out: list[tuple[np.ndarray, np.ndarray] | None] = []
        for pieces in split:
            at = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
            out.append((_slices(ids[0], ends[0], at), _slices(ids[1], ends[1], at)) if len(at) and good[at].all() else None)
        return out


def _slices(flat: np.ndarray, ends: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The slices of ``flat`` numbered ``at``, one after another."""
    size = ends[at + 1] - ends[at]
    before = np.cumsum(size) - size
    return flat[np.arange(size.sum()) + np.repeat(ends[at] - before, size)]


@lru_cache(maxsize=1)
def encoders(a: bytes, b: bytes) -> Encoders:
    return Encoders(a, b)


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers as compressed planes of bytes."""
    return pa.compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T), codec="zstd", asbytes=True)


def _unpacked(blob: bytes, n: int, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = pa.decompress(blob, n * width, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, n).T).view(kind).reshape(-1)


def events(docs: DataFrame, id_col: str, text_col: str, a: bytes, b: bytes) -> DataFrame:
    """(__row, __id, __at, __side, __n, __ids): runs of token ends; a row without tokens has one of side -1."""
    sc = docs.sparkSession.sparkContext
    files = sc.broadcast((a, b))
    rows = docs.select(F.monotonically_increasing_id().alias("__row"), F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    kind = dict(docs.dtypes)[id_col]

    def run(batches):
        both = encoders(*files.value)
        sizes = [np.zeros(1 << 16, np.int64) for _ in range(2)]
        for to, of in zip(sizes, (both.a_bytes, both.b_bytes), strict=True):
            to[list(of)] = [len(x) for x in of.values()]

        def runs(batch, first, texts):
            source, cols = [], [[], [], [], []]
            for k, found in enumerate(both.encode(texts)):
                if found is None:
                    source.append(first + k)
                    for c, v in zip(cols, (0, -1, 0, b""), strict=True):
                        c.append(v)
                    continue
                for side, ids in enumerate(found):
                    ends = np.cumsum(sizes[side][ids])
                    for s in range(0, len(ids), RUN):
                        part = ids[s : s + RUN]
                        source.append(first + k)
                        for c, v in zip(cols, (int(ends[s - 1]) if s else 0, side, len(part), _packed(part)), strict=True):
                            c.append(v)
            of = pa.array(source, pa.int64())
            kinds = pa.int64(), pa.int32(), pa.int32(), pa.binary()
            arrays = [batch.column(0).take(of), batch.column(1).take(of), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))]
            return pa.RecordBatch.from_arrays(arrays, names=["__row", "__id", "__at", "__side", "__n", "__ids"])

        for batch in batches:
            first, texts, chars = 0, [], 0
            for k in range(batch.num_rows):
                texts.append(batch.column(2)[k].as_py())
                chars += len(texts[-1])
                if chars > BATCH:
                    yield runs(batch, first, texts)
                    first, texts, chars = k + 1, [], 0
            if texts:
                yield runs(batch, first, texts)

    return rows.mapInArrow(run, f"__row bigint, __id {kind}, __at bigint, __side int, __n int, __ids binary")


_DIGITS = np.zeros((1 << 16, 6), np.uint8)
_WIDTH = np.searchsorted(10 ** np.arange(1, 5), np.arange(1 << 16), "right") + 1
for _k in range(5):
    _has = _WIDTH > _k
    _DIGITS[_has, _k] = 48 + np.arange(1 << 16)[_has] // 10 ** (_WIDTH[_has] - 1 - _k) % 10
_SIGNS = np.frombuffer(b",|;", np.uint8)


def sweep(a: np.ndarray, b: np.ndarray, sizes: tuple[np.ndarray, np.ndarray], cuts: np.ndarray):
    """Of stretches of text with as many bytes on both sides, one after another: groups, links, groups' text, and distinct links with their numbers.

    ``cuts``: the numbers of A and B tokens before each stretch and at the end.
    """
    end_a, end_b = np.cumsum(sizes[0][a]), np.cumsum(sizes[1][b])
    is_a, is_b = np.zeros(end_a[-1] + 1, bool), np.zeros(end_a[-1] + 1, bool)
    is_a[end_a] = True
    is_b[end_b] = True
    at = np.flatnonzero(is_a | is_b)  # the events, by offset
    of_a, of_b = is_a[at], is_b[at]
    close = of_a & of_b
    group = np.cumsum(close) - close
    link = a[np.cumsum(of_a) - of_a].astype(np.uint64) << np.uint64(16) | b[np.cumsum(of_b) - of_b].astype(np.uint64)
    borders = np.searchsorted(at, np.concatenate([[0], end_a])[cuts[0]], "right")
    n_links = np.diff(borders)
    n_groups = np.diff(np.concatenate([[0], np.cumsum(close)])[borders])

    group_a, group_b = group[of_a], group[of_b]
    many = [np.bincount(g, minlength=int(group[-1]) + 1) for g in (group_a, group_b)]
    place = np.arange(len(a)) + (np.cumsum(many[1]) - many[1])[group_a], np.arange(len(b)) + np.cumsum(many[0])[group_b]
    ids, sign = np.empty(len(a) + len(b), np.uint16), np.zeros(len(a) + len(b), np.uint8)
    for p, x, g, last in ((place[0], a, group_a, 1), (place[1], b, group_b, 2)):
        ids[p] = x
        sign[p] = np.where(np.append(g[1:] != g[:-1], True), last, 0)
    chars, width = _DIGITS[ids], _WIDTH[ids]
    chars[np.arange(len(ids)), width] = _SIGNS[sign]
    text = chars[np.arange(6) <= width[:, None]].tobytes()
    text_ends = np.concatenate([[0], np.cumsum(width + 1)])[cuts[0] + cuts[1]]

    keys, times = np.unique(np.repeat(np.arange(len(n_links), dtype=np.uint64), n_links) << np.uint64(32) | link, return_counts=True)
    key_ends = np.searchsorted(keys, np.arange(len(n_links) + 1, dtype=np.uint64) << np.uint64(32))
    return n_groups, n_links, text, text_ends, keys.astype(np.uint32), times.astype(np.uint32), key_ends


def _merged(codes: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, with the sums of their numbers."""
    if len(codes) == 1:
        return codes[0], times[0]
    found, at = np.unique(np.concatenate(codes), return_inverse=True)
    sums = np.bincount(at, np.concatenate(times)).astype(times[0].dtype)
    return found, sums


class Machine:
    """Takes a partition's runs in order, gives a row for each document."""

    def __init__(self, sizes: tuple[np.ndarray, np.ndarray]):
        self.sizes, self.held, self.open, self.done = sizes, 0, None, []

    def take(self, row: int, name, side: int, ids: np.ndarray) -> None:
        if self.open is None or self.open["row"] != row:
            self.close()
            self.open = {"row": row, "id": name, "left": ([], []), "n": [0, 0, 0, 0], "sha": hashlib.sha256(), "text": False, "codes": [], "times": []}
        if side >= 0:
            self.open["left"][side].append(ids)
            self.open["n"][side] += len(ids)
            self.held += len(ids)

    def close(self) -> None:
        if self.open is not None:
            self.done.append(self.open)
            self.open = None

    def stretches(self):
        """What can be swept: documents that are complete, and the open one up to the last group that is."""
        for d in self.done:
            if d["left"][0]:
                yield d, *map(np.concatenate, d["left"])
                d["left"] = ([], [])
        if (d := self.open) and all(d["left"]):
            a, b = map(np.concatenate, d["left"])
            ends = [np.cumsum(s[x]) for s, x in zip(self.sizes, (a, b), strict=True)]
            both = np.intersect1d(*ends, assume_unique=True)
            if len(both):
                n = [int(np.searchsorted(e, both[-1], "right")) for e in ends]
                yield d, a[: n[0]], b[: n[1]]
                d["left"] = ([a[n[0] :]], [b[n[1] :]])
                d["left"] = tuple([x for x in side if len(x)] for side in d["left"])

    def swept(self) -> list[dict]:
        """Sweeps what it can; the documents that are complete by that."""
        found = list(self.stretches())
        if found:
            a, b = (np.concatenate([f[i] for f in found]) for i in (1, 2))
            cuts = np.stack([np.concatenate([[0], np.cumsum([len(f[i]) for f in found])]) for i in (1, 2)])
            groups, links, text, ends, keys, times, key_ends = sweep(a, b, self.sizes, cuts)
            for i, (d, *_) in enumerate(found):
                if d["text"]:
                    d["sha"].update(b";")
                d["sha"].update(text[ends[i] : ends[i + 1] - 1])
                d["text"] = True
                d["n"][2] += int(groups[i])
                d["n"][3] += int(links[i])
                d["codes"].append(keys[key_ends[i] : key_ends[i + 1]])
                d["times"].append(times[key_ends[i] : key_ends[i + 1]])
                if len(d["codes"]) > 8:
                    d["codes"], d["times"] = ([x] for x in _merged(d["codes"], d["times"]))
        out, self.done = self.done, []
        self.held = sum(len(x) for side in (self.open or {"left": ()})["left"] for x in side)
        return out


def swept(runs: DataFrame, a: bytes, b: bytes, kind: str) -> DataFrame:
    """(__row, __id, n_a, n_b, n_groups, n_links, groups_sha256, __k, __links) of every document; __links: its __k distinct links and how often it has each."""
    files = runs.sparkSession.sparkContext.broadcast((a, b))
    rows = runs.repartition("__row").sortWithinPartitions("__row", "__at", "__side")

    def run(batches):
        both = encoders(*files.value)
        sizes = tuple(np.zeros(1 << 16, np.int64) for _ in range(2))
        for to, of in zip(sizes, (both.a_bytes, both.b_bytes), strict=True):
            to[list(of)] = [len(x) for x in of.values()]
        machine, id_type = Machine(sizes), None

        def made():
            found = machine.swept()
            pairs = [_merged(d["codes"], d["times"]) if d["codes"] else (np.empty(0, np.uint32),) * 2 for d in found]
            blobs = [_packed(np.concatenate([np.diff(c, prepend=np.uint32(0)), t])) if len(c) else b"" for c, t in pairs]
            cols = [pa.array([d["row"] for d in found], pa.int64()), pa.array([d["id"] for d in found], id_type)]
            cols += [pa.array([d["n"][i] for d in found], pa.int64()) for i in range(4)]
            cols += [pa.array([d["sha"].hexdigest() if d["text"] else "" for d in found], pa.string())]
            cols += [pa.array([len(c) for c, _ in pairs], pa.int64()), pa.array(blobs, pa.binary())]
            return pa.RecordBatch.from_arrays(cols, names=["__row", "__id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "__k", "__links"])

        for batch in batches:
            id_type = batch.column(1).type
            for row, name, side, n, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4)), batch.column(5), strict=True):
                machine.take(row, name, side, _unpacked(ids.as_py(), n, np.uint16) if n else np.empty(0, np.uint16))
                if machine.held > BLOCK:
                    yield made()
        machine.close()
        if id_type is not None:
            yield made()

    return rows.select("__row", "__id", "__at", "__side", "__n", "__ids").mapInArrow(run, f"__row bigint, __id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, __k bigint, __links binary")


def _links(blob: bytes, k: int) -> tuple[np.ndarray, np.ndarray]:
    both = _unpacked(blob, 2 * k, np.uint32)
    return np.cumsum(both[:k], dtype=np.uint32), both[k:]


def pair_counts(documents: DataFrame) -> DataFrame:
    """(code, n): how many documents hold each id pair (A id * 65536 + B id) linked."""

    def run(batches):
        codes, times, held = [], [], 0

        def batch(c, t):
            return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)), pa.array(t)], names=["code", "n"])

        for b in batches:
            for k, blob in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if k:
                    codes.append(_links(blob.as_py(), k)[0])
                    times.append(np.ones(k, np.int64))
                    held += k
                if held > 2 * HELD:
                    codes, times = ([x] for x in _merged(codes, times))
                    held = len(codes[0])
                    if held > HELD:
                        yield batch(codes[0], times[0])
                        codes, times, held = [], [], 0
        if codes:
            yield batch(*_merged(codes, times))

    counts = documents.select("__k", "__links").mapInArrow(run, "code bigint, n bigint")
    return counts.groupBy("code").agg(F.sum("n").alias("n"))


class Table:
    """Counts of id pairs, and the highest of each A id."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        order = np.argsort(codes)
        self.codes, self.counts = codes[order].astype(np.uint32), counts[order]
        first = np.flatnonzero(np.diff(self.codes >> np.uint32(16), prepend=np.uint32(0xFFFFFFFF)))
        self.best = np.zeros(1 << 16, np.int64)
        if len(first):
            self.best[self.codes[first] >> np.uint32(16)] = np.maximum.reduceat(self.counts, first)

    def of(self, codes: np.ndarray, times: np.ndarray) -> tuple[int, int]:
        """Links whose count is the highest of their A id, and the sum of the links' counts."""
        count, times = self.counts[np.searchsorted(self.codes, codes)], times.astype(np.int64)
        return int(times[count == self.best[codes >> np.uint32(16)]].sum()), int((count * times).sum())


def _by_broadcast(documents: DataFrame, pairs: DataFrame) -> DataFrame:
    """(__row, n_best, count_sum) of documents with links, by the whole table in every task."""
    found = pairs.select("code", "n").toArrow()
    table = documents.sparkSession.sparkContext.broadcast((found.column("code").to_numpy(), found.column("n").to_numpy()))

    def run(batches):
        known = Table(*table.value)
        for b in batches:
            got = [known.of(*_links(blob.as_py(), k)) if k else (0, 0) for k, blob in zip(b.column(1).to_pylist(), b.column(2), strict=True)]
            cols = [b.column(0), *(pa.array([g[i] for g in got], pa.int64()) for i in range(2)), *b.columns[3:]]
            yield pa.RecordBatch.from_arrays(cols, names=["__row", "n_best", "count_sum", *b.schema.names[3:]])

    rest = [c for c in documents.columns if c not in ("__row", "__k", "__links")]
    kinds = ", ".join(f"{c} {t}" for c, t in documents.select(*rest).dtypes)
    return documents.select("__row", "__k", "__links", *rest).mapInArrow(run, f"__row bigint, n_best bigint, count_sum bigint, {kinds}")


def _by_parts(documents: DataFrame, pairs: DataFrame, n: int, part: int) -> DataFrame:
    """As :func:`_by_broadcast`, with tables of about ``part`` pairs: A ids are dealt into parts, each of which its documents' links stream past."""
    parts = -(-n // part)

    def dealt(batches):
        for b in batches:
            rows, to, sizes, blobs = [], [], [], []
            for row, k, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                if not k:
                    continue
                codes, times = _links(blob.as_py(), k)
                of = (codes >> np.uint32(16)) % np.uint32(parts)
                for p in np.unique(of).tolist():
                    at = of == p
                    rows.append(row)
                    to.append(p)
                    sizes.append(int(at.sum()))
                    blobs.append(_packed(np.concatenate([np.diff(codes[at], prepend=np.uint32(0)), times[at]])))
            cols = [pa.array(x, t) for x, t in ((to, pa.int64()), (rows, pa.int64()), (sizes, pa.int64()), (blobs, pa.binary()))]
            yield pa.RecordBatch.from_arrays(cols, names=["part", "code", "n", "links"])

    asked = documents.select("__row", "__k", "__links").mapInArrow(dealt, "part bigint, code bigint, n bigint, links binary")
    asked = asked.withColumn("share", F.pmod("code", F.lit(SHARES)))
    table = pairs.select(F.pmod(F.shiftright("code", 16), F.lit(parts)).alias("part"), "code", "n", F.lit(None).cast("binary").alias("links"))
    table = table.withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SHARES - 1).cast("long"))))
    both = asked.unionByName(table).repartition("part", "share").sortWithinPartitions("part", "share", F.col("links").isNotNull())

    def run(batches):
        now, codes, counts, known = None, [], [], None
        for b in batches:
            out = []
            for key, code, n, links in zip(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True), b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True):
                if key != now:
                    now, codes, counts, known = key, [], [], None
                if links is None:
                    codes.append(code)
                    counts.append(n)
                    continue
                known = known or Table(np.array(codes, np.int64), np.array(counts, np.int64))
                out.append((code, *known.of(*_links(links, n))))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in range(3)], names=["__row", "n_best", "count_sum"])

    found = both.select("part", "share", "code", "n", "links").mapInArrow(run, "__row bigint, n_best bigint, count_sum bigint")
    sums = found.groupBy("__row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return documents.drop("__k", "__links").join(sums, "__row", "left").fillna(0, ["n_best", "count_sum"])


def aligned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None, b_path: str | None = None, table: int = TABLE, part: int = PART) -> DataFrame:
    """(__id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    Null and empty texts, and those whose bytes are not what both sides' tokens
    make up (a literal U+2581, say), have no tokens: zeros and an empty digest.
    Repeated rows and rows with one id, null or not, are documents of their own.
    Texts of any length count whole; further columns don't matter. An empty
    table gives no rows.
    """
    a, b = (open(p or q, "rb").read() for p, q in zip((a_path, b_path), paths(), strict=True))
    kind = dict(docs.dtypes)[id_col]
    documents = stored(swept(events(docs, id_col, text_col, a, b), a, b, kind))
    pairs = stored(pair_counts(documents))
    n = pairs.count()
    found = _by_broadcast(documents, pairs) if n <= table else _by_parts(documents, pairs, n, part)
    return found.select("__id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def query(docs: DataFrame) -> DataFrame:
    """The alignment of the public byte-level and piece vocabularies, with the id as doc_id; odd rows as in :func:`aligned`."""
    return aligned(docs).withColumnRenamed("__id", "doc_id")
