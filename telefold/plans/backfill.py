"""Daily and historical runs. A range of days is one job, not one job per day."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from telefold.functions import clock
from telefold.sinks.tables import reload_days

Fuse = Callable[[DataFrame], DataFrame]


def day_range(frames: DataFrame, date: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Rows of the closed range of days; without bounds, yesterday's."""
    day = F.col(date).cast("date")
    yesterday = F.date_sub(F.current_date(), 1)
    low = yesterday if first is None else F.lit(first).cast("date")
    high = low if last is None else F.lit(last).cast("date")
    return frames.where(day.between(low, high))


def backfill(
    frames: DataFrame, fuse: Fuse, path: str, first: str | None = None, last: str | None = None, date: str = "clt_date",
    data_source: str | None = None, data_type: str | None = None,
) -> None:
    """Fuses a range of days and replaces them, days without rows too; without bounds, yesterday. Name the source and
    type where the table holds others. Rows are gathered by partition, so a long range gives few files."""
    spark = frames.sparkSession
    low = first or str(spark.range(1).select(F.date_sub(F.current_date(), 1)).first()[0])
    high = last or low
    reload_days(spark, fuse(day_range(frames, date, low, high)), path, low, high, data_source, data_type, cluster=True)


def day_list(first: str, last: str) -> list[str]:
    """The dates of a closed range, for callers that schedule day by day."""
    a, b = datetime.date.fromisoformat(first), datetime.date.fromisoformat(last)
    return [(a + datetime.timedelta(days=i)).isoformat() for i in range((b - a).days + 1)]


def with_slice(frames: DataFrame, time: str, start: str, seconds: int) -> DataFrame:
    """Frames with the start of the time slice they fall in, counted from ``start`` and cut at midnight."""
    origin = F.lit(start if len(start) > 10 else start + " 00:00:00").cast("timestamp_ntz")
    return frames.withColumn("slice_start", clock.slice_of(F.col(time), origin, seconds))
