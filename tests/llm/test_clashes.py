"""User columns of any name pass every operator that hands on whole rows."""

import pathlib
import re

import pytest

from corpusloom.llm import line_dedup, mixing, near, quality, simhash

ROOT = pathlib.Path(line_dedup.__file__).parent
#: Every internal name in the sources of the operators that hand on rows.
NAMES = sorted({n for f in ("line_dedup", "mixing", "near", "minmax", "quality", "simhash", "common", "components") for n in re.findall(r'["\'.](__[a-z]\w*)', (ROOT / f"{f}.py").read_text())} | {"size", "target", "whole", "part", "root", "node", "a", "b", "n", "m", "source_size", "log_chars", "word_len", "upper", "stop"})
OWN = ["doc_id", "text", "lang", "source", "n_chars"]
TEXTS = ["Baris  yang sama\nsatu dua tiga empat lima enam", "baris  yang sama\nsatu dua tiga empat lima enam", "sendiri di sini saja ya tentu " * 9, "sendiri di sini saja ya tentu " * 9 + "lagi", "x", None]


def applied(name, docs):
    if name == "quality":
        return quality.boxed_scores(docs, quality.RuleEnsemble(1.0, [(0.5, (("upper", 0.5, True),))], [(0.1, "log_chars", 0.0, 9.0)])).where("__score > 0.1").select("__row.*")
    return {"lines": line_dedup.dedup_lines, "simhash": simhash.one_of_each, "near": near.one_of_each, "mixing": mixing.mixed_documents}[name](docs)


@pytest.mark.parametrize("name", ["lines", "simhash", "near", "mixing", "quality"])
def test_values_come_back(spark, name):
    names = [n for n in NAMES if n not in OWN]
    assert len(names) > 40
    rows = [(i, t, "id", "ab"[i % 2], len(t or "")) + tuple(f"{n}:{i}" for n in names) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names))
    out = applied(name, docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert got
    for r in got:
        assert [r[n] for n in names] == [f"{n}:{r['doc_id']}" for n in names]
