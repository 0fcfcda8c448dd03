import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.claims import accepted_per_host, in_claim_order
from corpusloom.plans import crawl
from corpusloom.settings import Settings

KIND = "id long, host string, fingerprint string, early string, late string"


def one_by_one(rows, cap, seen=(), accepted=()):
    seen, count, out = set(seen), dict(accepted), {}
    for i, host, fp, early, late in sorted(rows):
        host = host or ""
        if count.get(host, 0) >= cap:
            out[i] = f"domain_cap:{host}"
            continue
        if early is None:
            again = fp in seen
            seen.add(fp)
            out[i] = "duplicate_content" if again else late
        else:
            out[i] = early
        if out[i] is None:
            count[host] = count.get(host, 0) + 1
    return out


def random_rows(seed, n, hosts, prints):
    r = random.Random(seed)
    return [(i * 7 % n, f"h{min(r.randrange(hosts), r.randrange(hosts))}" if r.random() < 0.95 else None, f"f{r.randrange(prints)}", r.choice([None] * 5 + ["too_short_raw"]), r.choice([None] * 3 + ["low_relevance"])) for i in range(n)]


@pytest.mark.parametrize(("seed", "n", "hosts", "prints", "cap"), [(1, 401, 6, 90, 4), (2, 401, 3, 300, 25), (3, 400, 40, 60, 2), (4, 101, 1, 20, 0)])
def test_equals_a_plain_loop(spark, seed, n, hosts, prints, cap):
    rows = random_rows(seed, n, hosts, prints)
    got = in_claim_order(spark.createDataFrame(rows, KIND), ["id"], cap)
    assert {r["id"]: r["reject_reason"] for r in got.rows.collect()} == one_by_one(rows, cap)
    assert got.rows.columns == ["id", "host", "fingerprint", "reject_reason"] and got.rounds <= 12


def test_goes_on_from_what_was_before(spark):
    rows = random_rows(5, 300, 5, 100)
    before, after = [r for r in rows if r[0] < 150], [r for r in rows if r[0] >= 150]
    cap, whole = 6, one_by_one(rows, 6)
    first = in_claim_order(spark.createDataFrame(before, KIND), ["id"], cap).rows
    reached = first.where(~F.coalesce(F.col("reject_reason").rlike("^(?:domain_cap|too_short)"), F.lit(False))).select("fingerprint")
    then = in_claim_order(spark.createDataFrame(after, KIND), ["id"], cap, seen=reached, accepted=accepted_per_host(first))
    assert {r["id"]: r["reject_reason"] for df in (first, then.rows) for r in df.collect()} == whole


def test_a_copy_of_a_page_that_was_not_looked_at_is_new(spark):
    rows = [(1, "a", "x", None, None), (2, "a", "y", None, None), (3, "b", "y", None, None), (4, "b", "z", None, None), (5, "c", "z", None, None)]
    got = in_claim_order(spark.createDataFrame(rows, KIND), ["id"], 1)
    assert [r["reject_reason"] for r in got.rows.orderBy("id").collect()] == [None, "domain_cap:a", None, "domain_cap:b", None]
    assert got.rounds == 5  # each page waits for the one before, by host or by content


def test_rounds_follow_chains_not_rows(spark):
    rows = [(i, "hot" if i % 3 else f"h{i % 50}", f"f{i // 2}", None, None) for i in range(6000)]
    got = in_claim_order(spark.createDataFrame(rows, KIND), ["id"], 100)
    assert {r["id"]: r["reject_reason"] for r in got.rows.collect()} == one_by_one(rows, 100) and got.rounds <= 20


def test_crawl_plan_in_order(spark):
    text = lambda k: " ".join(f"kata{j} siswa dan guru di sekolah yang belajar pelajaran nomor{k}." for j in range(60))
    page = lambda i, host, k: (i, f"https://{host}/a/{i}", f"<title>Judul {i}</title><article><p>{text(k)}</p></article>")
    pages = spark.createDataFrame([page(1, "a.id", 1), page(2, "a.id", 2), page(3, "b.id", 2), page(4, "b.id", 1)], "id long, url string, html string")
    s = Settings(domain_cap=1, min_quality=0.0)
    got = {r["id"]: r["reject_reason"] for r in crawl.curated_in_order(pages, s=s, keywords=["guru"]).rows.collect()}
    assert got == {1: None, 2: "domain_cap:a.id", 3: None, 4: "domain_cap:b.id"}
    plain = {r["id"]: r["reject_reason"] for r in crawl.curated(pages, s=s, keywords=["guru"]).collect()}
    assert plain[3] == "duplicate_content"  # there a page beyond the cap has left its fingerprint


def test_empty_table(spark):
    got = in_claim_order(spark.createDataFrame([], KIND), ["id"], 3)
    assert got.rows.count() == 0 and got.rounds == 0
