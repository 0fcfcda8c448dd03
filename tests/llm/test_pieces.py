import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm import pieces


@pytest.fixture(scope="module")
def vocab():
    return pieces.load()


def segmentations(v, word):
    """All ways through the lattice of a word: (ids with -2 for bytes) to its weight."""
    if not word:
        return {(): 0.0}
    out = {}
    for n in range(1, min(len(word), v.longest) + 1):
        head = word[:n]
        if head in v.ids:
            step, cost = v.ids[head], float(v.weight[v.ids[head]])
        elif n == 1:
            step, cost = -2, pieces.FALLBACK_LOG * len(head.encode())
        else:
            continue
        for rest, log in segmentations(v, word[n:]).items():
            out[(step, *rest)] = cost + log
    return out


@settings(max_examples=80, deadline=None)
@given(text=st.text(st.characters(codec="utf-8"), max_size=60))
def test_round_trip(vocab, text):
    [(ids, _)] = pieces.sample(vocab, [text], np.array([7], np.uint64))
    assert pieces.decode(vocab, ids) == text.encode()


def test_awkward_texts(vocab):
    texts = ["", " ", "  a  b ", "▁x▁ y", "<s> <unk> <0x41>", "a\n\n\nb\t\x00", "😀" * 50, "x" * 5000, "kata " * 3000]
    got = pieces.sample(vocab, texts, np.arange(len(texts)).astype(np.uint64))
    assert [pieces.decode(vocab, i) for i, _ in got] == [t.encode() for t in texts]


@pytest.mark.parametrize("long", [False, True])
def test_samples_follow_the_lattice(vocab, monkeypatch, long):
    monkeypatch.setattr(pieces, "LONG", 2 if long else 40)
    word, n = "thers", 4000
    ways = segmentations(vocab, " " + word)
    total = math.log(sum(math.exp(x) for x in ways.values()))
    got = pieces.sample(vocab, [word] * n, np.arange(n).astype(np.uint64) * np.uint64(977))
    seen = Counter(tuple(i.tolist()) for i, _ in got)
    assert set(seen) <= set(ways)
    for way, log in ways.items():
        p = math.exp(log - total)
        assert abs(seen[way] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-3
    for ids, log in got[:20]:
        assert log == pytest.approx(ways[tuple(ids.tolist())])


def test_draws_do_not_depend_on_the_block(vocab):
    texts, keys = ["satu dua tiga", "the others are here", "x" * 60], np.array([1, 2, 3], np.uint64)
    together = pieces.sample(vocab, texts, keys)
    alone = [pieces.sample(vocab, [t], keys[i : i + 1])[0] for i, t in enumerate(texts)]
    assert all((a == b).all() for (a, _), (b, _) in zip(together, alone, strict=True))


def test_query(spark):
    rows = [(1, "Satu dua", 1), (1, "Satu dua", 1), (2, None, 2), (None, "", 3), (3, "▁" * 3 + "\n" + "kata " * 2000, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __ids int")
    got = pieces.query(df).collect()
    assert len(got) == 5 and all(r["lossless"] for r in got)
    assert len({tuple(r) for r in got if r["doc_id"] == 1}) == 1
    assert [r["n_pieces"] for r in got if r["doc_id"] in (2, None)] == [1, 1]
    assert pieces.query(df.limit(0)).count() == 0


def test_both_ways_give_the_same_draw(vocab, monkeypatch):
    """Words below, at and beyond the length where the way changes."""
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("etaoinshrdlué▁😀"), n)) for n in (1, 2, 20, 38, 39, 40, 41, 42, 60, 90) for _ in range(6)]
    keys = rng.integers(0, 2**63, len(texts)).astype(np.uint64)
    got = []
    for long in (0, 40, 500):
        monkeypatch.setattr(pieces, "LONG", long)
        got.append(pieces.sample(vocab, texts, keys))
    for a, b, c in zip(*got, strict=True):
        assert a[0].tolist() == b[0].tolist() == c[0].tolist()
        assert a[1] == pytest.approx(b[1]) and b[1] == pytest.approx(c[1])


def test_a_long_word_takes_memory_of_its_length(vocab, monkeypatch):
    import tracemalloc

    monkeypatch.setattr(pieces, "DRAWS", 500)
    word = "antidisestablishment" * 2_000
    tracemalloc.start()
    cut, _ = pieces._long_word(vocab, word, np.uint64(5), 0)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 150 * len(word) and cut[-1][0] == 0
