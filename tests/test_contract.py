"""Every registered query against its SQL counterpart on the smallest test tables."""

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as contract  # noqa: E402
from check_oracle import TABLES, rows_of  # noqa: E402

ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def db(sf):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return connection


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["query_id", "query", "answer", "confidence", "n_sources", "disclaimer"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, sf, db, name):
    df = contract.queries()[name](spark, sf)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        assert got
        return
    cursor = db.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows_of(columns, cursor.fetchall())
