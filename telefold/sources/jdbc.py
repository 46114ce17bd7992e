"""Database reads and appends through Spark's JDBC source. Connections come from the caller's options."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Split:
    """How a query is read in parallel: equal ranges of a numeric or date column."""

    column: str
    lower: str
    upper: str
    partitions: int


def read_options(query: str, split: Split | None = None, fetch: int = 50_000) -> dict[str, str]:
    """Options of a query scan. A split query goes in as a derived table: the ``query`` option cannot be
    combined with partition columns."""
    options = {"fetchsize": str(fetch)}
    if split is None:
        return {**options, "query": query}
    return {
        **options,
        "dbtable": f"({query}) q",
        "partitionColumn": split.column,
        "lowerBound": split.lower,
        "upperBound": split.upper,
        "numPartitions": str(split.partitions),
    }


def read_query(spark: SparkSession, connection: dict[str, str], query: str, split: Split | None = None) -> DataFrame:
    """A query's rows; ``connection`` has ``url``, ``driver``, and ``user`` and ``password`` if needed."""
    return spark.read.format("jdbc").options(**connection, **read_options(query, split)).load()


def append_table(df: DataFrame, connection: dict[str, str], table: str, batch: int = 50_000, writers: int = 64) -> None:
    """Appends in batches; at most ``writers`` connections write at a time."""
    (
        df.write.format("jdbc")
        .options(**connection, dbtable=table, batchsize=str(batch), numPartitions=str(writers))
        .mode("append")
        .save()
    )


def reload_table(df: DataFrame, connection: dict[str, str], table: str, batch: int = 50_000) -> None:
    """Empties a small table and fills it again, keeping its definition."""
    (
        df.write.format("jdbc")
        .options(**connection, dbtable=table, batchsize=str(batch), truncate="true")
        .mode("overwrite")
        .save()
    )
