"""Scans of mapping, scaling, device and catalogue tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from telefold.functions.clean import series_base


def mapping_scan(
    df: DataFrame, data_source: str, hos_series: str | None = None, data_type: str | None = None
) -> DataFrame:
    """Mapping rows of a data source (series, data type) that name a signal, packed or normalised."""
    signal = "signal_code" if "signal_code" in df.columns else "signal_name"
    rows = df.where((F.col("data_source") == data_source) & F.col(signal).isNotNull())
    if hos_series is not None:
        rows = rows.where(series_base(F.col("hos_series")) == hos_series.removesuffix("系列"))
    if data_type is not None:
        rows = rows.where(F.col("data_type") == data_type)
    return rows


def packed_as_normalised(df: DataFrame) -> DataFrame:
    """A packed mapping under the names of the normalised one."""
    return df.withColumnsRenamed({"signal_code": "signal_name", "data_type": "signal_type"})


def scaling_scan(df: DataFrame) -> DataFrame:
    """``pid, multiplier, offset`` of signals that are no fault codes."""
    return df.where(F.col("isfaultcode") == 0).select(
        F.col("signalcode").alias("pid"),
        F.col("multiplier").cast("double").alias("multiplier"),
        F.col("offset").cast("double").alias("offset"),
    )


def device_scan(df: DataFrame) -> DataFrame:
    return df.select("hos_id", "vin", "hos_mat_id", "hos_series", "type", "create_time")


def catalogue_scan(df: DataFrame) -> DataFrame:
    return df.select("PID", "Description", "ECUName", "name", "unitname")


def sheet_scan(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A sheet exported as CSV with a header; every column is read as text, none is guessed."""
    df = spark.read.csv(path, header=True, encoding="UTF-8")
    return df if columns is None else df.select(*[F.col(f"`{c}`") for c in columns])
