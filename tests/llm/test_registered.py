"""Registered queries beside their SQL."""

from __future__ import annotations

import os

import __spark_entry__
import duckdb
import pytest

from telefold.llm import queries


def test_all_are_registered():
    names = __spark_entry__.queries()
    assert {*queries.QUERIES, "pipeline"} <= names.keys()
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_as_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{sf_dir}/{f}'")
    found = con.execute(queries.SQL[name])
    columns = [d[0] for d in found.description]
    got = queries.QUERIES[name](spark, sf_dir)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(tuple(r[c] for c in columns) for r in got.collect()) == sorted(found.fetchall())
