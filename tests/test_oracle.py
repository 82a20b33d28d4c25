"""Every query with a SQL twin against DuckDB on the same tables."""

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
        return None
    if isinstance(v, (bool, np.bool_)):
        return str(bool(v))
    try:
        return f"{float(v):.6g}"
    except (TypeError, ValueError):
        return str(v)


def rows(df):
    df = df[sorted(df.columns)]
    return sorted((tuple(map(plain, r)) for r in df.itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, duck, name):
    ours, theirs = entry.queries()[name](spark, SF).toPandas(), duck.sql(SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


def test_entry(spark):
    assert entry.entry(spark).count() == 3
