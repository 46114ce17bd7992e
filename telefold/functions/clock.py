"""Epochs, wall clocks, day series and time slices.

Without a zone the session's time zone applies. With one, the wall clock of that zone is computed on
zone-less timestamps, whatever the session says.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

WALL_FORMAT = "yyyy-MM-dd HH:mm:ss"
LONGEST_STEP = 3600
#: Epoch seconds of the years 1 to 9999, a day less at both ends, so that the wall clock of every zone stays inside.
READABLE_SECONDS = (-62_135_596_800 + 86_400, 253_402_300_799 - 86_400)


def _zero() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _span(seconds: Column) -> Column:
    whole = F.lit(0)
    return F.make_dt_interval(whole, whole, whole, seconds.cast("decimal(18,6)"))


def wall_clock(seconds: Column, zone: str) -> Column:
    """Epoch seconds as the wall clock of a zone."""
    utc = _zero() + _span(seconds)
    return utc if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def epoch_text(seconds: Column, fmt: str = WALL_FORMAT, zone: str | None = None) -> Column:
    if zone is None:
        return F.from_unixtime(seconds, fmt)
    return F.date_format(wall_clock(seconds, zone), fmt)


def text_epoch(text: Column, fmt: str = WALL_FORMAT, zone: str | None = None) -> Column:
    if zone is None:
        return F.unix_timestamp(text, fmt)
    wall = F.to_timestamp_ntz(text, F.lit(fmt))
    utc = wall if zone == "UTC" else F.convert_timezone(F.lit(zone), F.lit("UTC"), wall)
    return (utc - _zero()).cast("interval second").cast("bigint")


def stamp_epoch(stamp: Column) -> Column:
    """The whole seconds of a wall clock of UTC as ``text_epoch`` has them, without a text in between."""
    since = (stamp.cast("timestamp_ntz") - _zero()).cast("interval second")
    return F.floor(since.cast("decimal(18,6)")).cast("bigint")


def millis_to_seconds(millis: Column) -> Column:
    """Truncates toward zero."""
    return ((millis - millis % 1000) / 1000).cast("bigint")


def readable(seconds: Column) -> Column:
    """Seconds that are a time of the years 1 to 9999, else NULL."""
    return F.when(seconds.between(*READABLE_SECONDS), seconds)


def text_millis_to_seconds(text: Column) -> Column:
    """Epoch milliseconds as text, truncated toward zero. What is no whole number or no readable time is NULL."""
    return readable(millis_to_seconds(text.try_cast("bigint")))


def epoch_stamp(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def epoch_day(seconds: Column, zone: str | None = None) -> Column:
    if zone is None:
        return F.to_date(F.timestamp_seconds(seconds))
    return F.to_date(wall_clock(seconds, zone))


def days_between(first: Column, last: Column) -> Column:
    """Every date of the closed range; empty when it runs backwards."""
    a, b = F.to_date(first), F.to_date(last)
    return F.when(a <= b, F.sequence(a, b, F.expr("interval 1 day"))).otherwise(
        F.array().cast("array<date>")
    )


def slice_step(seconds: int) -> int:
    return min(seconds, LONGEST_STEP)


def slice_bounds(start: Column, end: Column, seconds: int) -> Column:
    """Bounds of contiguous slices: every step from the start, every midnight, and the end."""
    step = F.expr(f"interval {slice_step(seconds)} second")
    midnight = F.date_trunc("DAY", start) + F.expr("interval 1 day")
    kind = "array<timestamp_ntz>"
    start, end, midnight = (c.cast("timestamp_ntz") for c in (start, end, midnight))
    grid = F.when(start <= end, F.sequence(start, end, step))
    days = F.when(midnight <= end, F.sequence(midnight, end, F.expr("interval 1 day"))).otherwise(
        F.array().cast(kind)
    )
    return F.array_distinct(F.array_sort(F.concat(grid, days, F.array(end))))


def slices(df: DataFrame, start: str, end: str, seconds: int) -> DataFrame:
    """One row per half-open slice ``[slice_start, slice_end)`` of each input row's time span."""
    bounds = df.withColumn("_bounds", slice_bounds(F.col(start), F.col(end), seconds))
    n = F.size("_bounds") - 1
    pairs = F.arrays_zip(
        F.slice("_bounds", F.lit(1), n).alias("slice_start"),
        F.slice("_bounds", F.lit(2), n).alias("slice_end"),
    )
    return (
        bounds.withColumn("_pair", F.explode(F.when(n > 0, pairs)))
        .withColumn("slice_start", F.col("_pair").getField("slice_start"))
        .withColumn("slice_end", F.col("_pair").getField("slice_end"))
        .drop("_bounds", "_pair")
    )


def slice_of(stamp: Column, start: Column, seconds: int) -> Column:
    """Start of the slice a time falls in, by arithmetic on the row itself: no range join."""
    step = slice_step(seconds)
    stamp, start = stamp.cast("timestamp_ntz"), start.cast("timestamp_ntz")
    elapsed = (stamp - start).cast("interval second").cast("decimal(18,6)")
    grid = start + _span(F.floor(elapsed / step) * step)
    return F.greatest(grid, F.date_trunc("DAY", stamp).cast("timestamp_ntz"))
