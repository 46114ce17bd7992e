"""Reconciliation of raw frames with the fused table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from telefold.functions.signals import sent_number
from telefold.operators.fusion import sent_at, with_signals
from telefold.operators.mapping import Target, read_targets
from telefold.session import keep_last_key

# Tolerances of the checks and the sample they read.
COUNT_TOLERANCE = 1000
RATIO_TOLERANCE = 1e-6
SAMPLE_ROWS = 50
WORKING_SPEED = 1000
WORKING_HOURS = (8, 17)


def reconcile_counts(
    raw: DataFrame, fused: DataFrame, raw_date: str, fused_date: str, tolerance: int = COUNT_TOLERANCE
) -> DataFrame:
    """``day, raw_rows, fused_rows, ok`` for every day either side has."""
    a = raw.groupBy(F.col(raw_date).cast("string").alias("day")).agg(F.count(F.lit(1)).alias("raw_rows"))
    b = fused.groupBy(F.col(fused_date).cast("string").alias("day")).agg(F.count(F.lit(1)).alias("fused_rows"))
    both = a.join(b, "day", "full").na.fill(0, ["raw_rows", "fused_rows"])
    return both.withColumn("ok", F.abs(F.col("raw_rows") - F.col("fused_rows")) < tolerance)


def working_rows(
    fused: DataFrame, speed: str = "engine_speed", clock: str = "clt_time",
    above: float = WORKING_SPEED, hours: tuple[int, int] = WORKING_HOURS,
) -> DataFrame:
    """Fused rows of a running engine in working hours, both ends included."""
    seconds = F.hour(clock) * 3600 + F.minute(clock) * 60 + F.second(clock)
    return fused.where(
        (F.col(speed) > above) & seconds.between(hours[0] * 3600, hours[1] * 3600)
    )


def _agrees(raw: Column, fused: Column, factor: float, tolerance: float, rounded: bool) -> Column:
    """Fused is raw times the factor within a relative tolerance; ``rounded`` compares the ratio of values rounded to
    seven places instead, as older checks did."""
    if rounded:
        a, b = F.round(raw, 7), F.round(fused, 7)
        ratio = F.when(a == 0, F.try_divide(b, a + 1)).otherwise(F.try_divide(b, a))
        same = (a == b) | (F.abs(ratio - F.lit(factor)) <= tolerance)
    else:
        want = raw * F.lit(factor)
        same = F.abs(fused - want) <= F.abs(want) * tolerance
    return F.when(raw.isNull() | fused.isNull(), raw.isNull() & fused.isNull()).otherwise(same)


def value_checks(
    raw: DataFrame,
    fused: DataFrame,
    mapping: DataFrame | list[Target],
    keys: Sequence[str] = ("ein", "clt_timestamp"),
    tolerance: float = RATIO_TOLERANCE,
    rounded: bool = False,
) -> DataFrame:
    """One row per frame and numeric target whose signal was sent: raw and fused value, factor, ``ok``.

    Raw and fused rows meet by ``keys``; after that join everything is computed inside the row. To check
    a sample, pass a sampled and written ``fused``: it is then broadcast, and the join only keeps its frames.
    """
    keep_last_key(raw.sparkSession)
    targets = mapping if isinstance(mapping, list) else read_targets(mapping)
    targets = [t for t in targets if not t.is_text and t.name in fused.columns]
    sides = raw.select(*keys, "codes", "vals").join(
        fused.select(*keys, *[F.col(f"`{t.name}`") for t in targets]), list(keys)
    )
    kept = [c for c in sides.columns if c not in ("codes", "vals")]
    keyed = with_signals(sides, kept, targets, "codes", "vals")
    sent, checks = sent_at(targets), []
    for t in targets:
        check = None
        for s in t.signals:
            field = F.expr(sent[s.code])
            factor = 1.0 if s.factor is None else s.factor
            read, made = sent_number(field), F.col(f"`{t.name}`")
            row = F.struct(
                F.lit(t.name).alias("target_name"),
                F.lit(s.code).alias("signal_name"),
                read.alias("raw_value"),
                made.cast("double").alias("fused_value"),
                F.lit(factor).alias("factor"),
                _agrees(read, made.cast("double"), factor, tolerance, rounded).alias("ok"),
            )
            check = F.when(field.isNotNull(), row) if check is None else check.when(field.isNotNull(), row)
        checks.append(check)
    found = F.filter(F.array(*checks), lambda c: c.isNotNull())
    return keyed.select(*keys, F.explode(found).alias("_c")).select(*keys, "_c.*")


def value_summary(checks: DataFrame) -> DataFrame:
    """Checked and failed values per target and signal."""
    return checks.groupBy("target_name", "signal_name").agg(
        F.count(F.lit(1)).alias("checked"),
        F.sum(F.when(F.col("ok"), 0).otherwise(1)).alias("failed"),
    )


def compare_max(
    raw: DataFrame, fused: DataFrame, by: str, raw_value: Column, fused_value: Column
) -> DataFrame:
    """Largest raw and fused value of one signal per group, side by side."""
    a = raw.groupBy(by).agg(F.max(raw_value).alias("raw_max"))
    b = fused.groupBy(by).agg(F.max(fused_value).alias("fused_max"))
    return a.join(b, by, "full")
