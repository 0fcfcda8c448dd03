import collections
import math
import zlib

import numpy as np
import pytest

from corpusloom.llm import lm

TEXTS = ["the cat sat on the mat", "The  cat\tran", "", None, "a b c d e f g " * 60, "the cat sat on the mat", "zebra unseen words", "\n \t"]


@pytest.fixture(scope="module")
def scores(spark):
    df = spark.createDataFrame([(i, t, "x", i) for i, t in enumerate(TEXTS * 3)], "doc_id long, text string, n string, __row int")
    return {r["doc_id"]: r for r in lm.query(df).collect()}


def test_base_score_against_brute_force(scores):
    texts = {i: (t or "") for i, t in enumerate(TEXTS * 3)}
    counts = collections.Counter()
    for i, t in texts.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(lm.tokens(t.encode()))
    total, kinds = sum(counts.values()), len(counts)
    assert len(scores) == len(texts)
    for i, t in texts.items():
        words, r = lm.tokens(t.encode()), scores[i]
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 7 == 2)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words), sum(w in counts for w in words), total)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in words))
        assert math.isfinite(r["score"]) and r["score"] < 0


def test_equal_texts_score_alike(scores):
    assert scores[0]["score"] == pytest.approx(scores[5]["score"], abs=1e-4)


def test_gradients():
    rng, m = np.random.default_rng(0), lm.fresh()
    for f in ("gate_in", "hidden", "new_bias", "to_class", "class_bias", "to_member", "member_bias"):
        setattr(m, f, getattr(m, f).astype(float))
    x, keep, h = rng.integers(0, lm.N_INPUT, (6, 3)), np.ones((6, 3)), rng.normal(size=(3, lm.HIDDEN))
    x[1], keep[2, 1] = lm.RARE, 0
    _, grads, _ = lm._window(m, x, keep, h)
    for p, g in zip(m.all(), grads, strict=True):
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        p[at] += 1e-5
        up = lm._window(m, x, keep, h)[0]
        p[at] -= 2e-5
        down = lm._window(m, x, keep, h)[0]
        p[at] += 1e-5
        assert (up - down) / 2e-5 == pytest.approx(g[at], rel=1e-3)


def test_probabilities_sum_to_one():
    m = lm.fresh()
    h = np.tile(np.random.default_rng(1).normal(size=lm.HIDDEN).astype(np.float32), (lm.N_INPUT, 1))
    assert np.exp(lm.token_logs(m, h, np.arange(lm.N_INPUT))).sum() == pytest.approx(1, abs=1e-4)


def test_state_is_carried_across_windows():
    m, rng = lm.fresh(), np.random.default_rng(2)
    texts = [rng.integers(0, lm.N_INPUT, n) for n in (1, lm.STEPS, lm.STEPS + 1, 3 * lm.STEPS + 5, 7)]
    for text, got in zip(texts, lm.score_texts(m, texts), strict=True):
        h, want = np.zeros((1, lm.HIDDEN), np.float32), 0.0
        for t in text:
            want += lm.token_logs(m, h, np.array([t]))[0]
            h = lm._step(m, np.array([t]), h)[0]
        assert got == pytest.approx(want, rel=1e-4)


def test_training_lowers_the_loss():
    text = np.tile(np.arange(10), 200)
    before, after = lm.score_texts(lm.fresh(), [text])[0], lm.score_texts(lm.fit([text] * 20), [text])[0]
    assert after > before / 2


def test_beats_the_base_on_held_out_documents(spark, data):
    rows = [r for r in lm.query(spark.read.parquet(f"{data}/documents.parquet")).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_empty_table(spark):
    assert lm.query(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_weights_come_from_every_token_of_every_shard(spark, monkeypatch):
    monkeypatch.setattr(lm, "SHARD", 2_000)
    words = [f"w{i}".encode() for i in range(50)]
    vocab = lm.vocabulary([*words, lm.END], [9] * 51)
    rows = [(i, " ".join(f"w{(i + j) % 50}" for j in range(2_500))) for i in range(12)]
    train = [(i, t) for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    n = sum(len(lm.tokens(t.encode())) for _, t in train)
    start = lm.from_counts(vocab, [9] * 51, 0)
    fit = lambda rows: lm.trained(spark.createDataFrame(rows, "doc_id long, text string"), vocab, start, n, "doc_id", "text")
    model = fit(rows)
    assert all((a == b).all() for a, b in zip(model.all(), fit(rows[::-1]).all(), strict=True))
    for i, text in train:  # the last words of each document, beyond any prefix, change the weights
        other = [(k, t if k != i else text[: -len(" w1 w1")] + " w3") for k, t in rows]
        assert any((a != b).any() for a, b in zip(model.all(), fit(other).all(), strict=True))
        break
    held = [(k, t if (k, t) in train else "w1 w1 w1") for k, t in rows]
    assert all((a == b).all() for a, b in zip(model.all(), fit(held).all(), strict=True))


def test_biases_are_shares_of_the_whole_corpus():
    m = lm.from_counts(lm.vocabulary([b"a", b"b"], [80, 20]), [80, 20], 7)
    share = np.exp(m.member_bias[0])
    assert share[0] / share[1] == pytest.approx(81 / 21, rel=1e-4) and np.exp(m.class_bias).sum() == pytest.approx(1, abs=1e-4)


def plain_score(m, counts, text):
    """log10 P of a text by the model's definition, token by token."""
    kinds = sorted((w for w in counts if counts[w] >= 2), key=lambda w: (-counts[w], w))
    rank, head = {w: i for i, w in enumerate(kinds)}, lm.CLASSES * lm.MEMBERS
    edges = sorted({round(head * (len(kinds) / head) ** (i / lm.BANDS)) for i in range(lm.BANDS + 1)})
    once = sum(n == 1 for n in counts.values())
    n_rare = sum(n for n in counts.values() if n < 2)
    unseen = once / (n_rare + once)
    sig = lambda v: 1 / (1 + np.exp(-v))
    soft = lambda z: np.exp(z - z.max()) / np.exp(z - z.max()).sum()
    w64 = [p.astype(float) for p in m.all()]
    gate_in, hidden, new_bias, to_class, class_bias, to_member, member_bias = w64
    h, total, met = np.zeros(lm.HIDDEN), 0.0, set()
    for w in lm.tokens(text.encode()):
        p_class = soft(h @ to_class + class_bias)
        r = rank.get(w)
        if r is not None and r < head:
            met.add("head")
            x, k = r, r // lm.MEMBERS
            total += math.log10(p_class[k]) + math.log10(soft(h @ to_member[k] + member_bias[k])[r % lm.MEMBERS])
        elif r is not None:
            met.add("band")
            b = max(i for i, e in enumerate(edges[:-1]) if e <= r)
            x = head + b
            total += math.log10(p_class[lm.CLASSES + b]) + math.log10(counts[w] / sum(counts[v] for v in kinds[edges[b] : edges[b + 1]]))
        else:
            met.add("rare" if w in counts else "unseen")
            x = lm.RARE
            total += math.log10(p_class[-1]) + math.log10(counts[w] / n_rare * (1 - unseen) if w in counts else unseen)
        n, g, u = lm.HIDDEN, gate_in[x], h @ hidden
        z, reset = sig(g[:n] + u[:n]), sig(g[n : 2 * n] + u[n : 2 * n])
        new = np.tanh(g[2 * n :] + reset * (u[2 * n :] + new_bias))
        h = (1 - z) * new + z * h
    return total, met


def test_whole_scores_against_plain_python(spark, monkeypatch):
    rng, seen, real = np.random.default_rng(5), [], lm.trained
    monkeypatch.setattr(lm, "trained", lambda *a: seen.append(real(*a)) or seen[-1])
    words = [f"kata{i}" for i in range(2_500)]
    texts = [" ".join(words[i] for i in (2_500 * rng.random(120) ** 3).astype(int)) for _ in range(120)] + ["belum pernah kata1 " * 3, "", "kata2 " * 500]
    texts = [t + f" sekali{i}" for i, t in enumerate(texts)]
    got = {r["doc_id"]: r["score"] for r in lm.query(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    counts, met = collections.Counter(), set()
    for i, t in enumerate(texts):
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(lm.tokens(t.encode()))
    for i in [*range(0, 120, 11), 120, 121, 122]:
        want, kinds = plain_score(seen[0], counts, texts[i])
        met |= kinds
        assert got[i] == pytest.approx(want, rel=1e-4)
    assert met == {"head", "band", "rare", "unseen"}


def test_a_very_long_text_is_scored_whole(spark):
    rows = [(i, "satu dua tiga " * 50) for i in range(20)] + [(100, "satu dua tiga " * 60_000)]
    got = {r["doc_id"]: r for r in lm.query(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[100]["n_tokens"] == 180_001 and got[100]["score"] < got[0]["score"]


def test_logits_beyond_single_precision_and_within_it():
    """Rows are shifted by their maxima only if a logit could leave the range of exp; both ways agree with doubles."""
    rng = np.random.default_rng(3)
    for scale, add in ((1, 0), (30, 0), (100, 0), (1, 500), (1, -500)):
        z = (rng.normal(size=(40, 45)) * scale + add).astype(np.float32)
        at, d = rng.integers(0, 45, 40), z.astype(float)
        want = d[np.arange(40), at] - d.max(axis=1) - np.log(np.exp(d - d.max(axis=1, keepdims=True)).sum(axis=1))
        assert lm._logs_at(z.copy(), at) == pytest.approx(want, rel=1e-4, abs=1e-4)
        rest, logs = lm._softmax(z.copy(), at)
        assert logs == pytest.approx(want.sum(), rel=1e-4, abs=1e-3)
        assert rest.sum(axis=1) == pytest.approx(0, abs=1e-4)


def test_step_of_prepared_weights_against_the_plain_formula():
    m, rng, n = lm.fresh(), np.random.default_rng(4), lm.HIDDEN
    x, h = rng.integers(0, lm.N_INPUT, 9), rng.normal(size=(9, n)).astype(np.float32)
    u, g = h @ m.hidden, m.gate_in[x]
    z, r = (1 / (1 + np.exp(-(u + g)[:, k * n : (k + 1) * n])) for k in (0, 1))
    new = np.tanh(g[:, 2 * n :] + r * (u[:, 2 * n :] + m.new_bias))
    s = lm._steps(m)
    assert lm._move(s, s.sums(x[None])[0], h.T)[0].T == pytest.approx(z * h + (1 - z) * new, abs=1e-5)
    assert (lm.CLASS_OF == lm.class_of(np.arange(lm.N_INPUT))).all() and lm.CLASS_OF.dtype == np.uint8
