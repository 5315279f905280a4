"""Every query against its SQL, on the smallest test tables."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_module
from flowspark.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def plain(value):
    if value is None or value is pd.NA or value is pd.NaT or isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, float) or hasattr(value, "as_tuple"):
        return round(float(value), 6)
    if hasattr(value, "isoformat"):
        return value.isoformat()[:10]
    return float(value) if isinstance(value, int) and not isinstance(value, bool) else value


def rows(df: pd.DataFrame) -> list[str]:
    return sorted(repr([plain(v) for v in r]) for r in df[sorted(df.columns)].astype(object).itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert rows(QUERIES[name](spark, DATA).toPandas()) == rows(duck.sql(ORACLES[name]).df())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLES) <= set(entry_module.oracle_sql())
