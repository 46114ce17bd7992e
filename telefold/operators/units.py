"""Unit conversion as a small table joined to the mapping once per mapping row, not per value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed values: (from unit, to unit, factor), lower case.
CONVERSIONS: list[tuple[str, str, float]] = [
    # voltage
    ("mv", "v", 1e-3),
    # length and speed
    ("km", "m", 1e3),
    ("m", "km", 1e-3),
    ("cm", "km", 1e-5),
    ("cm", "m", 1e-2),
    # time
    ("s", "min", 1 / 60),
    ("s", "h", 1 / 3600),
    ("min", "s", 60.0),
    ("min", "h", 1 / 60),
    ("h", "s", 3600.0),
    ("h", "min", 60.0),
    # air flow
    ("kg/h", "m3/h", 0.85566),
    ("kg/h", "m³/h", 0.85566),
    ("m3/h", "kg/h", 1 / 0.85566),
    ("m³/h", "kg/h", 1 / 0.85566),
    ("m3/h", "m³/h", 1.0),
    ("m³/h", "m3/h", 1.0),
    # pressure
    ("hpa", "kpa", 0.1),
    ("hpa", "mpa", 0.0001),
    ("kpa", "hpa", 10.0),
    ("kpa", "mpa", 0.001),
    ("mpa", "hpa", 10000.0),
    ("mpa", "kpa", 1000.0),
    # mass per time
    ("mg/s", "g/min", 0.06),
    ("g/min", "mg/s", 1000 / 60),
    # volume per time
    ("m3/h", "m^3/h", 1.0),
    ("m^3/h", "m3/h", 1.0),
    # mass per stroke
    ("mg/hub", "mg/cyl", 1.0),
    ("mg/cyl", "mg/hub", 1.0),
    # angle
    ("degc", "ca", 1.0),
    ("ca", "degc", 1.0),
]

# What older tables were built with, where it differs. None: passed through unconverted.
LEGACY: list[tuple[str, str, float | None]] = [
    ("cm", "km", 1e-6),
    ("cm", "m", 1e-3),
    ("g/min", "mg/s", 16.67),
    ("kg/h", "m3/h", None),
    ("m³/h", "m3/h", None),
]


def unit_table(spark: SparkSession, legacy: bool = False) -> DataFrame:
    """``from_unit, to_unit, factor``; a pair without a row cannot be converted."""
    pairs = {(a, b): f for a, b, f in CONVERSIONS}
    if legacy:
        pairs.update({(a, b): f for a, b, f in LEGACY})
    rows = [(a, b, f) for (a, b), f in pairs.items() if f is not None]
    return spark.createDataFrame(rows, "from_unit string, to_unit string, factor double")


def attach_factor(
    df: DataFrame, from_unit: Column | str, to_unit: Column | str, legacy: bool = False
) -> DataFrame:
    """Adds ``factor``: 1 for equal units (also unknown ones), the table's otherwise, else NULL."""
    a, b = (F.lower(F.col(c) if isinstance(c, str) else c) for c in (from_unit, to_unit))
    table = unit_table(df.sparkSession, legacy).withColumnRenamed("factor", "_factor")
    joined = df.withColumn("_a", a).withColumn("_b", b).join(
        F.broadcast(table),  # fixed size: the list above
        (F.col("_a") == F.col("from_unit")) & (F.col("_b") == F.col("to_unit")),
        "left",
    )
    same = F.col("_a") == F.col("_b")
    return joined.withColumn(
        "factor", F.when(same, F.lit(1.0)).otherwise(F.col("_factor"))
    ).drop("_a", "_b", "_factor", "from_unit", "to_unit")
