"""Every registered query against its DuckDB oracle on the smallest supplied tables."""

from __future__ import annotations

import datetime as dt

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ["customer", "supplier", "orders", "lineitem"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        return repr(round(v, 6))
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return str(v)


def _canon(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in data)


def test_every_query_has_an_oracle():
    assert set(E.core_queries()) == set(E.core_oracle_sql())


@pytest.mark.parametrize("name", sorted(E.core_queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    got = df.collect()
    cur = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert _canon(df.columns, got) == _canon(cols, want)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["Id_Employee", "Id_PositionHistory", "training_day_duration"]
    assert df.count() > 0
