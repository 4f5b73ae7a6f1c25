"""Every query with SQL against DuckDB, value by value."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

TABLES = "documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    for table in TABLES.split():
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    return con


def frame(df):
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns), kind="stable").reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, sf, con, name):
    got = entry.queries()[name](spark, sf).toPandas()
    want = con.sql(entry.oracle_sql()[name]).df()
    assert len(want)
    assert sorted(got.columns) == sorted(want.columns)
    pd.testing.assert_frame_equal(frame(got), frame(want), check_dtype=False, check_exact=True)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
