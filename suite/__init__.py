"""Queries over the given tables, each with the same result stated in SQL."""

from suite import checks, cleaning, fusion, metadata, scans, storage, streams, writing  # noqa: F401
from suite.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
