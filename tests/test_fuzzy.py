import numpy as np

from corpusloom import queries

TERMS, LEAST = ["the tionn", "und der"], 80


def longest_common(term, windows):
    """Of each row of ``windows`` with ``term``, by the whole table."""
    n, m = windows.shape
    table = np.zeros((len(term) + 1, m + 1, n), np.int16)
    for i, c in enumerate(term):
        for j in range(m):
            table[i + 1, j + 1] = np.where(windows[:, j] == ord(c), table[i, j] + 1, np.maximum(table[i, j + 1], table[i + 1, j]))
    return table[-1, -1]


def best_window(term, text):
    """The best ratio of all windows of the term's length, and of those that the text's ends cut off."""
    codes, m, best = np.array([ord(c) for c in text], np.int64), len(term), 0.0
    if len(term) > len(text):
        return best_window(text, term)
    whole = np.lib.stride_tricks.sliding_window_view(codes, m)
    best = 200.0 * longest_common(term, whole).max() / (2 * m)
    for k in range(1, m):
        for part in (codes[:k], codes[-k:]):
            best = max(best, 200.0 * longest_common(term, part[None])[0] / (m + k))
    return best


def plain(text):
    low = " ".join((text or "").lower().split())[:8000]
    scores = [100 if t in low else int(best_window(t, low)) for t in TERMS] if low else []
    hits = [s for s in scores if s >= LEAST]
    return max(hits, default=0), len(hits)


def test_every_document_as_a_search_of_all_windows_scores_it(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: (r["score"], r["n"]) for r in queries.queries()["fuzzy_relevance"](spark, folder).collect()}
    want = {r["doc_id"]: plain(r["text"]) for r in docs}
    assert got == want and len(set(want.values())) > 3


def test_whole_texts_however_long(monkeypatch):
    import pyarrow.parquet as pq

    from corpusloom.functions import fuzzy

    texts = [" ".join((t or "").lower().split()) for t in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist()]
    long = [t for t in texts if len(t) > 8000]
    hits = lambda t: [s for s in (100 if x in t else int(best_window(x, t)) for x in TERMS) if s >= LEAST]
    want = [(max(h, default=0), len(h)) for h in map(hits, long)]
    got = [fuzzy.science_hits(t, TERMS, LEAST) for t in long]
    assert [(s, len(h)) for s, h in got] == want
    assert any((s, len(h)) != w for (s, h), w in zip([fuzzy.science_hits(t, TERMS, LEAST, first=8000) for t in long], want, strict=True))
    monkeypatch.setattr(fuzzy, "WINDOWS", 7)
    for t in (*(t[:300] for t in long), "und d", "der", "d", "n der x und"):
        for term in (*TERMS, "x"):
            assert abs(fuzzy.partial_ratio(term, t) - best_window(term, t)) < 1e-9


def test_the_experiment_finds_what_stands_at_a_long_page_s_end(spark):
    from corpusloom.operators import journal

    page = lambda end: "<p>" + "guru dan murid belajar yang di sekolah, " * 500 + end + "</p>"
    pages = spark.createDataFrame([("u", page("lalu fotosintesis")), ("v", page("lalu gravitasi"))], "url string, html string")
    rows = journal.experiment_records(pages, science=["fotosintesys"], keywords=["zzz"]).collect()
    assert [(r["url"], r["metadata"]["fuzzy_science_score"]) for r in rows] == [("u", 91)]
