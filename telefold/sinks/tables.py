"""Writes that can be repeated: partition reloads, delete-then-append, CSV exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from telefold.session import work_path

LAYOUT = ("data_source", "data_type", "clt_date")
SORTED_BY = ("vin", "clt_timestamp")


def _sorted(df: DataFrame) -> DataFrame:
    by = [c for c in SORTED_BY if c in df.columns]
    return df.sortWithinPartitions(*LAYOUT, *by) if by else df


def append_partitions(df: DataFrame, path: str) -> None:
    _sorted(df).write.partitionBy(*LAYOUT).mode("append").parquet(path)


def reload_partitions(
    df: DataFrame, path: str, layout: Sequence[str] = LAYOUT, cluster: bool = False
) -> None:
    """Replaces exactly the partitions that ``df`` has rows for. Running it twice changes nothing.

    Rows are written where they are. ``cluster`` gathers each partition's rows first, for input in no
    order of date; adaptive execution then splits a large partition and merges small ones.
    """
    rows = df.hint("rebalance", *layout) if cluster else df
    rows = _sorted(rows) if tuple(layout) == LAYOUT else rows
    (
        rows.write.partitionBy(*layout)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )


def read_partitions(spark: SparkSession, path: str, layout: Sequence[str] = LAYOUT) -> DataFrame:
    """The table with its partition columns as they were written: text stays text, so ``001`` isn't 1."""
    found = spark.read.parquet(path).schema
    fields = [T.StructField(f.name, T.StringType()) if f.name in layout else f for f in found]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(place) and any("=" in s.getPath().getName() for s in files.listStatus(place))


def _empty_partitions(spark: SparkSession, path: str, gone: DataFrame, layout: Sequence[str]) -> None:
    """Deletes the folders of the partitions in ``gone``. They are found by the files read, never by a name made up
    from values; one job finds them all, and deleting one is a call of the file system."""
    old = read_partitions(spark, path, layout)
    files = old.select(*layout, F.col("_metadata.file_path").alias("_file"))
    folders = files.join(gone, _same_partition(files, gone, layout), "left_semi")
    folders = folders.select(F.regexp_replace("_file", "/[^/]*$", "").alias("folder")).distinct()
    for row in folders.toLocalIterator():
        place = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(row.folder))
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def reload_days(
    spark: SparkSession, df: DataFrame, path: str, first: str, last: str,
    data_source: str | None = None, data_type: str | None = None, cluster: bool = False,
) -> None:
    """Replaces the closed range of days; a day without rows becomes empty. A source or type narrows what is
    replaced; rows of ``df`` outside of it aren't written.

    Days that become empty are deleted first. A failure after that leaves days of the range missing, which a rerun
    writes; no other day is touched.
    """
    asked = F.col("clt_date").cast("string").between(first, last)
    for name, wanted in (("data_source", data_source), ("data_type", data_type)):
        if wanted is not None:
            asked = asked & (F.col(name) == wanted)
    rows = df.withColumns({c: F.col(c).cast("string") for c in LAYOUT}).where(asked)
    staged = work_path(spark, "staged")
    rows.write.parquet(staged)
    rows = spark.read.parquet(staged)
    if _exists(spark, path):
        old = read_partitions(spark, path).where(asked).select(*LAYOUT).distinct()
        new = rows.select(*LAYOUT).distinct()
        _empty_partitions(spark, path, old.join(new, _same_partition(old, new, LAYOUT), "left_anti"), LAYOUT)
    reload_partitions(rows, path, cluster=cluster)
    drop_staged(spark, staged)


def reload_between(df: DataFrame, path: str, column: str, first: str, last: str) -> None:
    """Replaces the partitions ``first`` to ``last`` of a table laid out by one column of text; those without rows go."""
    spark, asked = df.sparkSession, F.col(column).between(first, last)
    staged = work_path(spark, "staged")
    df.where(asked).write.parquet(staged)
    rows = spark.read.parquet(staged)
    if _exists(spark, path):
        old = read_partitions(spark, path, [column]).where(asked).select(column).distinct()
        new = rows.select(column).distinct()
        _empty_partitions(spark, path, old.join(new, _same_partition(old, new, [column]), "left_anti"), [column])
    reload_partitions(rows, path, [column], cluster=True)
    drop_staged(spark, staged)


def store_raw(raw: DataFrame, path: str, date: str) -> None:
    """Raw frames by day: a scan of some days reads only their files. A day written again replaces the former."""
    reload_partitions(raw, path, [date], cluster=True)


def reload_day(df: DataFrame, path: str, data_source: str, data_type: str, day: str) -> None:
    """Replaces one day of one source and type; a day without rows becomes empty."""
    reload_days(df.sparkSession, df, path, day, day, data_source, data_type)


def delete_then_append(
    spark: SparkSession, path: str, matches: Column, new: DataFrame, layout: Sequence[str] = LAYOUT
) -> None:
    """Deletes the rows that match, then adds new ones; a row the test is NULL for stays. ``matches`` sees partition
    columns as text.

    What remains is written aside first. Partitions left without rows are deleted, then those that hold a matching
    or a new row are replaced. A failure between the two has only deleted rows that were to go.
    """
    old = read_partitions(spark, path, layout)
    new = new.withColumns({c: F.col(c).cast("string") for c in layout})
    hit = F.coalesce(matches, F.lit(False))
    touched = old.where(hit).select(*layout).union(new.select(*layout)).distinct()
    rest = old.where(~hit).join(touched, _same_partition(old, touched, layout), "left_semi")
    staged, parts = work_path(spark, "staged"), work_path(spark, "touched")
    touched.write.parquet(parts)
    rest.unionByName(new.select(*old.columns)).write.parquet(staged)
    rows, parts_rows = spark.read.parquet(staged), spark.read.parquet(parts)
    filled = rows.select(*layout).distinct()
    _empty_partitions(spark, path, parts_rows.join(filled, _same_partition(parts_rows, filled, layout), "left_anti"), layout)
    reload_partitions(rows, path, layout)
    drop_staged(spark, staged, parts)


def _same_partition(a: DataFrame, b: DataFrame, layout: Sequence[str]) -> Column:
    test = F.lit(True)
    for c in layout:
        test = test & a[c].eqNullSafe(b[c])
    return test


def drop_staged(spark: SparkSession, *paths: str) -> None:
    """Deletes work folders that nothing reads any more."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def export_csv(df: DataFrame, path: str, separator: str = ",", bom: bool = False) -> None:
    """CSV with a header. ``bom`` starts every file with a byte-order mark, for spreadsheets."""
    if bom and df.columns:
        df = df.withColumnRenamed(df.columns[0], "﻿" + df.columns[0])
    df.write.mode("overwrite").option("sep", separator).option("header", True).csv(path)


def export_archive(df: DataFrame, path: str) -> None:
    """The archive's CSV form, separated by ``@``."""
    export_csv(df, path, separator="@")


def write_sized(df: DataFrame, path: str, rows_per_file: int = 1000) -> None:
    """Files of at most that many rows, without counting first."""
    df.write.option("maxRecordsPerFile", rows_per_file).mode("append").parquet(path)


def in_parts(df: DataFrame, rows_per_part: int = 1000) -> DataFrame:
    """Repartitions to one part per that many rows."""
    return df.repartition(df.count() // rows_per_part + 1)


def replace_table(df: DataFrame, path: str) -> None:
    """Replaces a small table as a whole."""
    df.write.mode("overwrite").parquet(path)


def append_with(df: DataFrame, path: str, **constants: str) -> None:
    """Appends with constant columns."""
    df.withColumns({k: F.lit(v) for k, v in constants.items()}).write.mode("append").parquet(path)


def copy_rows(source: DataFrame, keep: Column, path: str) -> None:
    """Copies the rows that pass a test from one table to another."""
    source.where(keep).write.mode("append").parquet(path)
