"""Every query with a DuckDB statement gives the statement's rows on the smallest tables."""

import datetime as dt
import os

import pandas as pd
import pytest

from lodestone import catalog

HERE = "/root/testdata/sf0.001"
SQL = catalog.oracle_sql()


def plain(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
        return None
    if isinstance(v, (dt.date, pd.Timestamp)):
        return str(pd.Timestamp(v))
    if isinstance(v, bool) or not isinstance(v, (int, float)):
        return str(v)
    return round(float(v), 5)


def rows(frame, columns):
    return sorted(map(repr, ([plain(v) for v in r] for r in frame[columns].astype(object).values.tolist())))


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for f in os.listdir(HERE):
        c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{HERE}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, name):
    got, wanted = catalog.queries()[name](spark, HERE).toPandas(), duck.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(wanted.columns)
    assert rows(got, sorted(got.columns)) == rows(wanted, sorted(got.columns))


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(SQL)))
def test_runs(spark, name):
    assert catalog.queries()[name](spark, HERE).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_import_needs_no_session():
    import subprocess
    import sys

    code = "import __spark_entry__ as e; assert len(e.queries()) >= len(e.oracle_sql()) > 100"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), timeout=120)
