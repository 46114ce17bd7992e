"""Every registered query beside its SQL on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from check import _alike, _cell, _rows
from suite import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{sf_dir}/{f}'")
    return con


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    df = entry_points.queries()[name](spark, sf_dir)
    mine = [tuple(r) for r in df.collect()]
    cur = con.execute(entry_points.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    kinds = {d[0]: str(d[1]) for d in cur.description}
    assert sorted(columns) == sorted(df.columns)
    assert all(_alike(t, kinds[c]) for c, t in df.dtypes)
    assert _rows(df.columns, mine) == _rows(columns, cur.fetchall())


def test_the_comparison_tells_seconds_apart():
    assert _cell(1704067200) != _cell(1704067201)
    assert _cell(0.1 + 0.2) == _cell(0.3)
    assert _cell("1") != _cell("1.0")


def test_entry(spark, sf_dir):
    assert entry_points.entry(spark).count() > 0
