"""Every registered query against its SQL on the smallest test tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, rows_of

SF_DIR = "/root/testdata/sf0.001"
from contentgate.plans.catalog import ORACLES, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{os.path.join(SF_DIR, table)}.parquet'")
    return con


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    mine, columns = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(ORACLES[name])
    theirs, their_columns = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert columns == their_columns
    assert mine == theirs


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
