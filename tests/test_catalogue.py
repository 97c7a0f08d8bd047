"""Every registered query against its SQL twin, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from cartloom.plans import catalogue

QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()
TABLES = ("customer", "orders", "part", "embeddings", "events")


@pytest.fixture(scope="module")
def db(small):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    return con


def test_every_sql_text_has_a_query():
    assert set(SQL) <= set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, db, small, name):
    frame = QUERIES[name](spark, small)
    cursor = db.execute(SQL[name])
    place = [[c[0] for c in cursor.description].index(c) for c in frame.columns]
    want = sorted(repr(tuple(r[i] for i in place)) for r in cursor.fetchall())
    assert sorted(repr(tuple(r)) for r in frame.collect()) == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0
