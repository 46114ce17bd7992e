"""Name to query and SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query; without ``sql`` its result has no SQL form."""

    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register
