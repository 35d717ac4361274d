"""Every registered query against its DuckDB SQL at sf0.001 (the driver
runs the same comparison at sf0.01; tools/check_oracle.py does it locally)."""

import datetime

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E

from conftest import SF0001

QUERIES = sorted(E.oracle_sql())          # every registered query has one


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("orders", "customer", "documents"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


def _canon(v):
    """One text form per value (NULL/NaN/NaT -> None, floats exact)."""
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
        return None
    if isinstance(v, (pd.Timestamp, datetime.datetime)):
        return pd.Timestamp(v).strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(v, datetime.date):
        return v.isoformat()
    if isinstance(v, float) and v.is_integer() and abs(v) < 2**53:
        return str(int(v))
    return repr(v) if isinstance(v, float) else str(v)


def _rows(df):
    cols = sorted(df.columns)
    rows = [tuple(_canon(v) for v in r) for r in df[cols].astype(object).itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((v is None, v or "") for v in r)), cols


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, con, name):
    s = E.queries()[name](spark, SF0001).toPandas()
    d = con.execute(E.oracle_sql()[name]).df()
    assert sorted(s.columns) == sorted(d.columns)
    assert len(s) == len(d)
    assert _rows(s) == _rows(d)
