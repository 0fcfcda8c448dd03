import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusloom.llm import alignment

A, B = alignment.paths()
LETTERS = alignment._letters()


@pytest.fixture(scope="module")
def whole():
    """Both tokenizers on whole texts, by the libraries' own ways."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    return a, b


def tokens(whole, text):
    a, b = whole
    of_a = a.encode(" " + text, add_special_tokens=False).ids
    of_b = b.encode(text)
    bytes_a = [bytes(LETTERS[c] for c in a.id_to_token(i)) for i in of_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in of_b]
    if not text or b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
        return [], []
    return list(zip(of_a, map(len, bytes_a), strict=True)), list(zip(of_b, map(len, bytes_b), strict=True))


def plain(whole, texts):
    """A row for each text, by loops over all pairs of tokens' ranges."""
    rows, held = [], Counter()
    for text in texts:
        sides = tokens(whole, text or "")
        ranges = []
        for side in sides:
            at, out = 0, []
            for i, n in side:
                out.append((i, at, at + n))
                at += n
            ranges.append(out)
        a, b = ranges
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        start, groups = 0, []
        for end in ends:
            groups.append("|".join(",".join(str(i) for i, s, e in side if start <= s and e <= end) for side in (a, b)))
            start = end
        links, j0 = [], 0
        for i, s, e in a:
            while j0 < len(b) and b[j0][2] <= s:
                j0 += 1
            j = j0
            while j < len(b) and b[j][1] < e:
                links.append((i, b[j][0]))
                j += 1
        rows.append([len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""])
        held.update(set(links))
    best = {}
    for (i, _), n in held.items():
        best[i] = max(best.get(i, 0), n)
    return [(na, nb, ng, len(ls), sum(held[x] == best[x[0]] for x in ls), sum(held[x] for x in ls), sha) for na, nb, ng, ls, sha in rows]


COLS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
TEXTS = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  \n  b\n\nc ", "don't  stop\tnow then x 　y", "Élan vital, ça va? 12345 6.7", "▁ not the same", "x ▁", "<s> <|endoftext|> </s> <unk> <0x41>",
    "日本語のテキスト、空白なし。" * 20, "🙂🙂 \U0001f468‍\U0001f469‍\U0001f467 mixed é ﬁ Ａ ½", "\r\n\x00\x01\x1c \x1f x\x85y", "0" * 300, "ab" * 2000, "kata " * 50, "kata " * 50, "à ́b", "­soft­ hyphen ﻿ bom",
]


def test_pieces_encode_as_whole_texts_do(whole):
    both = alignment.Encoders(open(A, "rb").read(), open(B, "rb").read())
    rng = np.random.default_rng(2)
    chars = list("  \n\t ab Z9,.'é日🙂▁ ́\x1c\x85") + ["the ", " in", "  ", "\n "]
    texts = [t for t in TEXTS if t] + ["".join(rng.choice(chars, rng.integers(1, 40))) for _ in range(3000)]
    for text, got in zip(texts, both.encode(texts), strict=True):
        want = [[i for i, _ in side] for side in tokens(whole, text)]
        assert [x.tolist() for x in got or (np.empty(0),) * 2] == want, repr(text)


@pytest.mark.parametrize("how", [{}, {"table": 0, "part": 50}])
def test_equals_plain_loops(spark, whole, how):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").withColumn("__row", F.lit(1)).withColumn("code", F.lit("x"))
    got = {r["__id"]: tuple(r[c] for c in COLS) for r in alignment.aligned(df, **how).collect()}
    assert got == dict(enumerate(plain(whole, TEXTS)))


def test_query_on_the_tables(spark, data, whole):
    docs = spark.read.parquet(f"{data}/documents.parquet").orderBy("doc_id").select("doc_id", "text")
    rows = docs.collect()
    want = dict(zip([r["doc_id"] for r in rows], plain(whole, [r["text"] for r in rows]), strict=True))
    assert {r["doc_id"]: tuple(r[c] for c in COLS) for r in alignment.query(docs).collect()} == want


def test_runs_and_blocks_don_t_matter(spark, whole, monkeypatch):
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["kata", "日本語", "abcdefgh", "12", "the"], rng.integers(0, 400))) for _ in range(12)] + ["ab" * 500, None]
    a, b = (open(p, "rb").read() for p in (A, B))
    both = alignment.encoders(a, b)
    sizes = tuple(np.zeros(1 << 16, np.int64) for _ in range(2))
    for to, of in zip(sizes, (both.a_bytes, both.b_bytes), strict=True):
        to[list(of)] = [len(x) for x in of.values()]
    for run, block in ((7, 50), (64, 64), (1 << 15, 1 << 20)):
        machine, out = alignment.Machine(sizes), []
        for row, found in enumerate(both.encode([t or "" for t in texts])):
            if found is None:
                machine.take(row, row, -1, np.empty(0, np.uint16))
                continue
            events = sorted((int(sizes[s][ids[:k]].sum()), s, k) for s, ids in enumerate(found) for k in range(0, len(ids), run))
            for _, s, k in events:
                machine.take(row, row, s, found[s][k : k + run])
                if machine.held > block:
                    out += machine.swept()
        machine.close()
        out += machine.swept()
        got = [(*d["n"], d["sha"].hexdigest() if d["text"] else "") for d in out]
        assert got == [(r[0], r[1], r[2], r[3], r[6]) for r in plain(whole, texts)]


def test_odd_rows(spark):
    kind = "doc_id long, text string"
    rows = [(None, "satu dua"), (None, "satu dua"), (3, "satu dua"), (3, "x " * 400_000), (4, "\n" * 5000 + "y" * 60_000)]
    got = [tuple(r) for r in alignment.query(spark.createDataFrame(rows, kind)).select("doc_id", "n_a", "n_b", "count_sum").collect()]
    assert sorted(str(r[0]) for r in got) == ["3", "3", "4", "None", "None"] and all(r[1] > 0 for r in got)
    assert len({r[1:] for r in got}) == 3
    assert alignment.query(spark.createDataFrame([], kind)).count() == 0
