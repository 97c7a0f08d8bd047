"""The operators' queries against their SQL twins, on the smallest tables."""

import duckdb
import pytest

from cartloom.llm import catalogue

QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, small, name):
    db = duckdb.connect()
    for table in ("documents", "conversations", "embeddings"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    frame = QUERIES[name](spark, small)
    cursor = db.execute(SQL[name])
    place = [[c[0] for c in cursor.description].index(c) for c in frame.columns]
    want = sorted(repr(tuple(r[i] for i in place)) for r in cursor.fetchall())
    assert sorted(repr(tuple(r)) for r in frame.collect()) == want


@pytest.mark.parametrize("name,table", [
    ("op2_language", "documents"), ("op6_fingerprint", "documents"), ("op7_toxicity", "documents"), ("op8_mixing", "documents"), ("op9_main_text", "pages"),
])
def test_one_row_each(spark, small, name, table):
    assert QUERIES[name](spark, small).count() == spark.read.parquet(f"{small}/{table}.parquet").count()
