"""Every table query with SQL against DuckDB."""

import math
import os

import pytest

import __spark_entry__ as entry
from sparquill import catalogue

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def _rows(df):
    out = []
    for row in df[sorted(df.columns)].astype(object).itertuples(index=False):
        out.append(repr([None if v is None or (isinstance(v, float) and math.isnan(v)) or str(v) == "<NA>" else float(v) if hasattr(v, "__float__") and not isinstance(v, str) else v for v in row]))
    return sorted(out)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    assert _rows(catalogue.QUERIES[name](spark, DATA).toPandas()) == _rows(duck.execute(catalogue.ORACLE_SQL[name]).df())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
