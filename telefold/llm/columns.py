"""Column names: any name a caller's table may have, and names it hasn't."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def named(name: str) -> Column:
    """The column of exactly that name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def aside(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For operators whose own names begin with two underscores: a caller's columns that do are called otherwise while
    the operator works, and have their names again in its result."""

    @functools.wraps(operator)
    def run(docs: DataFrame, *args, **options) -> DataFrame:
        others: dict[str, str] = {}
        for c in docs.columns:
            if c.startswith("__"):
                others[c] = unused(docs, f"kept_{len(others)}_")
        if not others:
            return operator(docs, *args, **options)
        args = [others.get(a, a) if isinstance(a, str) else a for a in args]
        options = {k: others.get(a, a) if isinstance(a, str) else a for k, a in options.items()}
        out = operator(docs.withColumnsRenamed(others), *args, **options)
        return out.withColumnsRenamed({other: c for c, other in others.items()})

    return run
