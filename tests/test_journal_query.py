from pyspark.sql import functions as F

from corpusloom import queries, queries_sql


def test_every_document_is_a_journal_page(spark, data):
    import duckdb

    got = queries.queries()["journal_records"](spark, data)
    sql = queries_sql.oracle_sql()["journal_records"]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{data}/documents.parquet')")
    want = con.execute(sql).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
    number = F.regexp_extract("source_page", "[0-9]+$", 0).cast("long") % 3
    assert {r[0] for r in got.select(number).distinct().collect()} == {0, 1, 2}
