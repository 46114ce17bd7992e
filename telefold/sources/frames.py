"""Raw-frame scans. Filters and columns are plain expressions, so they reach the storage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from telefold.functions.clean import strip_one_zero
from telefold.functions.clock import WALL_FORMAT
from telefold.operators.enrich import only_keys


def _frame(df: DataFrame, time: str, date: str, codes: Column, values: Column, vin: str, lng: str | None, lat: str | None) -> DataFrame:
    none = F.lit(None).cast("string")
    return df.select(
        strip_one_zero(F.col("ein")).alias("ein"),
        F.col(vin).alias("vin"),
        F.date_format(time, WALL_FORMAT).alias("clt_time"),
        F.unix_timestamp(F.col(time).cast("timestamp")).alias("clt_timestamp"),
        codes.alias("codes"),
        values.alias("vals"),
        (F.col(lng) if lng else none).alias("longitude"),
        (F.col(lat) if lat else none).alias("latitude"),
        F.col(date).cast("string").alias("clt_date"),
    )


def frames_a(
    raw: DataFrame, first: str, last: str | None = None, vehicles: DataFrame | None = None, limit: int | None = None
) -> DataFrame:
    """Flavour A: the days ``first`` to ``last`` (one day by default), both lists present, id not blank.

    ``vehicles`` keeps only the engines in its ``ein`` column.
    """
    rows = raw.where(
        F.col("uploadDate").between(F.lit(first).cast("date"), F.lit(last or first).cast("date"))
        & F.col("params.valueM").isNotNull()
        & F.col("params.codeM").isNotNull()
        & (F.col("ein") != "")
    )
    frames = _frame(
        rows, "uploadTime1", "uploadDate", F.col("params.codeM"), F.col("params.valueM"),
        "deviceID", "longitude", "latitude",
    )
    if vehicles is not None:
        frames = only_keys(frames, vehicles)
    return frames if limit is None else frames.limit(limit)


def frames_b(raw: DataFrame, data_source: str, first: str, last: str | None = None) -> DataFrame:
    """Flavour B: other column names, filtered by data source too."""
    rows = raw.where(
        F.col("clt_date").between(F.lit(first).cast("date"), F.lit(last or first).cast("date"))
        & (F.col("data_source") == data_source)
        & F.col("parse_value").isNotNull()
        & F.col("code").isNotNull()
        & (strip_one_zero(F.col("ein")) != "")
    )
    return _frame(rows, "clt_time", "clt_date", F.col("code"), F.col("parse_value"), "vin", "lng", "lat")


# Column names of the tables a time slice can be read from; None where a table has none.
SLICE_TABLES: dict[str, dict[str, str | None]] = {
    "upload": dict(time="uploadTime1", date="uploadDate", codes="params.codeM", values="params.valueM", vin="deviceID", lng="longitude", lat="latitude"),
    "signal": dict(time="clt_time", date="clt_date", codes="code", values="parse_value", vin="vin", lng="lng", lat="lat"),
    "stream": dict(time="create_time", date="create_date", codes="code", values="parse_value", vin="vin", lng=None, lat=None),
}


def frames_slice(raw: DataFrame, start: str, end: str, table: str = "upload") -> DataFrame:
    """Frames of the half-open time ``[start, end)``; the days it touches are named for partition pruning."""
    t = SLICE_TABLES[table]
    lo, hi = (F.lit(x).cast("timestamp_ntz") for x in (start, end))
    stamp = F.col(t["time"]).cast("timestamp_ntz")
    rows = raw.where(
        F.col(t["date"]).between(F.lit(start[:10]).cast("date"), F.lit(end[:10]).cast("date"))
        & (stamp >= lo)
        & (stamp < hi)
        & F.col(t["values"]).isNotNull()
        & F.col(t["codes"]).isNotNull()
        & (F.col("ein") != "")
    )
    return _frame(rows, t["time"], t["date"], F.col(t["codes"]), F.col(t["values"]), t["vin"], t["lng"], t["lat"])


def frames_of_days(raw: DataFrame, days: DataFrame, date: str = "uploadDate") -> DataFrame:
    """Raw rows of the days in another table. Where ``raw`` is stored by day and ``days`` can be broadcast, Spark prunes the
    partitions at run time by the days it finds; a filter on ``days`` makes it worth while."""
    return raw.join(days.select(F.col(days.columns[0]).alias(date)).distinct(), date, "left_semi")


def in_time_order(frames: DataFrame, across: bool = True) -> DataFrame:
    """Frames by engine and time: over the whole table, or inside each partition only."""
    order = ("ein", "clt_timestamp")
    return frames.orderBy(*order) if across else frames.sortWithinPartitions(*order)


def archive_scan(raw: DataFrame, created: str) -> DataFrame:
    """Archived frames by creation date, lists as text, for the CSV export."""
    from telefold.functions.listtext import join_list

    rows = raw.where(F.col("CreateDate") == F.lit(created).cast("date"))
    frames = _frame(
        rows, "uploadTime1", "uploadDate", join_list(F.col("params.codeM")), join_list(F.col("params.valueM")),
        "deviceID", None, None,
    )
    return frames.select("ein", "vin", "clt_time", "clt_timestamp", "vals", "codes", "clt_date")


def preview(df: DataFrame, date: str, day: str, n: int, *order: Column | str) -> DataFrame:
    """A few rows of one day, the first ones by ``order`` if it is given."""
    rows = df.where(F.col(date) == F.lit(day).cast("date"))
    return (rows.orderBy(*order) if order else rows).limit(n)
