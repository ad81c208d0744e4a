"""Every SQL-expressible registered query equals its DuckDB oracle (sf0.001)."""

import datetime as dt
import math

import pytest

from conftest import SF_SMALL

import __spark_entry__ as entry

ORACLE = entry.oracle_sql()
NAMES = sorted(ORACLE)


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_a_callable():
    qs = entry.queries()
    assert set(ORACLE) <= set(qs)
    assert len(qs) >= 60


@pytest.mark.parametrize("name", NAMES)
def test_matches_duckdb(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert _rows(df.columns, s_rows) == _rows(d_cols, d_rows)


def test_entry_smoke(spark):
    out = entry.entry(spark).collect()
    assert len(out) == 6
    assert [f.name for f in entry.entry(spark).schema.fields] == [
        "BASIC_ZONE", "attempts", "fg_pct", "pts_per_attempt"]
