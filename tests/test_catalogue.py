"""Every query of the catalogue against DuckDB, on the smallest tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from tidewright.plans import catalogue

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.sql("set timezone='UTC'")
    for path in glob.glob(f"{TABLES}/*.parquet"):
        c.sql(f"create view {os.path.basename(path)[:-8]} as select * from read_parquet('{path}')")
    return c


def plain(df):
    cell = lambda v: "~" if pd.isna(v) else f"{v:.9g}" if isinstance(v, float) else str(v)[:26]
    return sorted(tuple(cell(v) for v in row) for row in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no test tables")
@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    rows = catalogue.QUERIES[name](spark, TABLES).toPandas()
    assert name in catalogue.ORACLE_SQL
    expected = duck.sql(catalogue.ORACLE_SQL[name]).df()
    assert sorted(rows.columns) == sorted(expected.columns)
    assert plain(rows) == plain(expected)
