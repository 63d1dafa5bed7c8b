"""Every registered query against its SQL in DuckDB, at the smallest size."""

import math
import os

import duckdb
import pandas as pd
import pytest

from padron import plans

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = plans.load()
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def rows(df):
    def plain(x):
        if hasattr(x, "tolist"):
            x = x.tolist()
        if x is None or x is pd.NaT or (isinstance(x, float) and math.isnan(x)):
            return None
        if isinstance(x, float):
            return repr(round(x, 6))
        return str(pd.Timestamp(x)) if hasattr(x, "isoformat") else str(x)

    df = df[sorted(df.columns)]
    return list(df.columns), sorted([tuple(map(plain, r)) for r in df.itertuples(index=False)], key=str)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    assert rows(QUERIES[name](spark, SF).toPandas()) == rows(duck.sql(ORACLES[name]).df())


def test_queries_without_sql_run(spark):
    for name in QUERIES.keys() - ORACLES.keys():
        assert QUERIES[name](spark, SF).columns
