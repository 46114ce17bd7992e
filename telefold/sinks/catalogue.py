"""Tables of the session's catalogue: made from the mapping's DDL, reloaded by partition, bucketed for joins.

Tables are managed by the catalogue, so a dropped partition's files go with it. Partitions are found in the catalogue's
own list, not by reading the table.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from telefold.operators.mapping import fused_ddl
from telefold.sinks.tables import LAYOUT

#: How the catalogue spells a NULL partition.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def make_fused_table(spark: SparkSession, mapping: DataFrame, table: str, order: str | None = None) -> None:
    """The fused table with its types, comments and partitions; ``order`` says whose description counts."""
    spark.sql(fused_ddl(mapping, table, order=order))


def _in_order(df: DataFrame, table: str) -> DataFrame:
    """``df``'s columns as the table has them; an insert goes by place, not by name."""
    return df.select(*(F.col(f"`{c}`") for c in df.sparkSession.table(table).columns))


def append_rows(df: DataFrame, table: str) -> None:
    _in_order(df, table).write.insertInto(table)


def replace_partitions(df: DataFrame, table: str) -> None:
    """Replaces exactly the partitions that ``df`` has rows for. Running it twice changes nothing.

    Only a session setting makes an insert replace single partitions. It is set in a session of its own, which shares
    the catalogue and has the other settings of this one, so queries that run at the same time don't see it.
    """
    spark, view = df.sparkSession, f"rows_{uuid.uuid4().hex[:12]}"
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            own.conf.set(name, value)
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    where = table if "." in table else f"{spark.catalog.currentDatabase()}.{table}"
    _in_order(df, table).createGlobalTempView(view)
    try:
        own.sql(f"INSERT OVERWRITE TABLE {where} SELECT * FROM global_temp.{view}")
    finally:
        spark.catalog.dropGlobalTempView(view)
    spark.catalog.refreshTable(table)


def partitions(spark: SparkSession, table: str, layout: Sequence[str] = LAYOUT) -> DataFrame:
    """The table's partitions, values as text, from the catalogue."""
    listed = []
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():  # one row a partition
        values = dict(part.split("=", 1) for part in row.partition.split("/"))
        listed.append([None if values[c] == NULL_PARTITION else unquote(values[c]) for c in layout])
    return spark.createDataFrame(listed, T.StructType([T.StructField(c, T.StringType()) for c in layout]))


def _literal(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def drop_partitions(spark: SparkSession, table: str, matches: Column, layout: Sequence[str] = LAYOUT) -> int:
    """Drops the partitions that match, with their rows; says how many. One call of the catalogue each."""
    gone = partitions(spark, table, layout).where(matches).collect()
    for row in gone:
        spec = ", ".join(f"`{c}` = {_literal(row[c])}" for c in layout)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
    return len(gone)


def reload_days(df: DataFrame, table: str, first: str, last: str, data_source: str | None = None, data_type: str | None = None) -> None:
    """Replaces the closed range of days; a day without rows becomes empty. A source or type narrows what is replaced;
    rows of ``df`` outside of it aren't written."""
    spark = df.sparkSession
    asked = F.col("clt_date").cast("string").between(first, last)
    for name, wanted in (("data_source", data_source), ("data_type", data_type)):
        if wanted is not None:
            asked = asked & (F.col(name) == wanted)
    rows = df.where(asked)
    filled = {tuple(r) for r in rows.select(*(F.col(c).cast("string") for c in LAYOUT)).distinct().collect()}  # one row a partition
    replace_partitions(rows, table)
    own = F.struct(*LAYOUT)
    if filled:
        asked = asked & ~F.coalesce(own.isin(*(F.struct(*(F.lit(v).cast("string").alias(c) for c, v in zip(LAYOUT, values))) for values in filled)), F.lit(False))
    drop_partitions(spark, table, asked)


def empty_table(spark: SparkSession, table: str) -> None:
    """Deletes all rows and partitions; the definition stays."""
    spark.sql(f"TRUNCATE TABLE {table}")


def definition(spark: SparkSession, table: str) -> DataFrame:
    """``name, kind, comment, is_partition`` of the table's columns, as the catalogue has them."""
    rows = [(c.name, c.dataType, c.description, c.isPartition) for c in spark.catalog.listColumns(table)]
    return spark.createDataFrame(rows, "name string, kind string, comment string, is_partition boolean")


def save_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int) -> None:
    """A table dealt into ``buckets`` files by a hash of ``keys`` and sorted by them. Tables of as many buckets on the same
    keys are joined without a shuffle, however often; rows are shuffled once, here."""
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
