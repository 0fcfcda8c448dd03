from corpusloom.llm import language


def test_sparse_labels_fill_the_sample(spark, monkeypatch):
    """One row of 20 has a language; the sample is a share of those rows, not of all."""
    seen = []
    monkeypatch.setattr(language, "fit", lambda texts, labels: seen.append(len(labels)))
    rows = [(i, f"kata {i}", "id" if i % 20 == 0 else None) for i in range(20_000)]
    language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample=200)
    assert seen == [400]  # two windows of each
