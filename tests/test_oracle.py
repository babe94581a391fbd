"""Every query with SQL gives the rows that DuckDB gives."""

import math
import os

import duckdb
import pandas as pd
import pytest

from glotta.plans.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"


def plain(x):
    if x is None or x is pd.NA or isinstance(x, float) and math.isnan(x):
        return None
    if hasattr(x, "tolist"):
        x = x.tolist()
    if isinstance(x, (list, tuple)):
        return tuple(plain(v) for v in x)
    if isinstance(x, bool) or isinstance(x, str):
        return x
    return float(x) if isinstance(x, (int, float)) or type(x).__name__ == "Decimal" else x


def rows(df, columns):
    return sorted((tuple(plain(v) for v in r) for r in df[columns].astype(object).itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(DATA):
        pytest.skip("no test data here")
    c = duckdb.connect()
    c.sql("SET timezone = 'UTC'")
    for f in os.listdir(DATA):
        c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, DATA).toPandas()
    if name not in ORACLES:
        assert len(got) > 0
        return
    want = duck.sql(ORACLES[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert rows(got, columns) == rows(want, columns)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())
