"""Fusion of tall signal rows, where one frame's signals arrive as separate rows.

Both operators aggregate in two steps. The first, by (frame, target) or (frame, code), combines before
its shuffle, so a frame with a third of all rows leaves each map task as at most one row per target.
The second gathers those few rows; what it collects is bounded by the mapping, not by the data.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from telefold.functions.clean import number, scaled
from telefold.functions.signals import SENT_NULL, quoted, sent_number_sql
from telefold.operators.fusion import LOOKED_UP, fuse_frames
from telefold.operators.mapping import Target, list_targets, sized
from telefold.session import keep_last_key


def _order(columns: Sequence[str]) -> Column:
    return F.col(columns[0]) if len(columns) == 1 else F.struct(*columns)


def attach_mapping(tall: DataFrame, mapping: DataFrame, scaling: DataFrame | None = None) -> DataFrame:
    """Signals left-joined to their targets and scaling by ``pid``; signals without either stay."""
    ids = [c for c in mapping.columns if c not in ("signal_name",)]
    rows = tall.join(mapping.withColumnRenamed("signal_name", "pid").select("pid", *ids), "pid", "left")
    if scaling is None:
        return rows.withColumn("multiplier", F.lit(1.0)).withColumn("offset", F.lit(0.0))
    return rows.join(scaling.select("pid", "multiplier", "offset"), "pid", "left")


def fuse_grouped(
    tall: DataFrame,
    mapping: DataFrame,
    keys: Sequence[str] = ("ein", "clt_timestamp"),
    order: Sequence[str] = ("pos",),
    ids: Sequence[str] = ("vin",),
    scaling: DataFrame | None = None,
    targets: list[Target] | None = None,
    opening: Column | None = None,
) -> DataFrame:
    """One row per key: for each target the first matching row in arrival order, scaled, converted.

    ``ids`` are carried as their first non-NULL value; they may come from the rows or the mapping.
    A key none of whose signals is mapped still gives a row. Without ``targets`` they are read from the
    mapping, and metadata is written so its size is known; with them nothing is read or written here.
    ``opening`` is true for rows that come before all others of their frame, which have the same keys and ids. Of those
    others, the ones without a target then add nothing and are left out before the rows are sorted and shuffled.
    """
    keep_last_key(tall.sparkSession)
    if targets is None:
        targets = list_targets(mapping)
        mapping = sized(mapping)
        scaling = None if scaling is None else sized(scaling)
    rows = attach_mapping(tall, mapping, scaling)
    if opening is not None:
        told = [F.col(c).isNotNull() for c in ("target_name", *ids) if c not in tall.columns]
        rows = rows.where(functools.reduce(lambda a, b: a | b, told, opening))
    # The signal itself settles equal stamps, so a recomputed task picks the same row.
    stamp = F.struct(
        _order(order).alias("at"), F.coalesce("priority", F.lit(0)).alias("priority"), F.struct("pid", "value").alias("tie")
    )
    value = scaled(number(F.col("value")), F.col("multiplier"), F.col("offset"))
    value = value * F.coalesce("factor", F.lit(1.0))
    text = F.when(F.col("is_text"), F.col("value")).otherwise(value.cast("string"))
    shaped = rows.select(
        *keys,
        "target_name",
        stamp.alias("_at"),
        F.coalesce(text, F.lit(SENT_NULL)).alias("_value"),
        *[F.col(c).alias(f"_{c}") for c in ids],
    )
    # made while they are combined, so the rows that are sorted hold the stamp once
    first = {c: F.when(F.col(f"_{c}").isNotNull(), F.struct(F.col("_at").alias("at"), F.col(f"_{c}").alias("id"))) for c in ids}
    best = shaped.groupBy(*keys, "target_name").agg(
        F.min_by("_value", "_at").alias("_value"), *[F.min(one).alias(f"_{c}") for c, one in first.items()]
    )
    firsts = [F.min(f"_{c}").getField("id").alias(c) for c in ids]
    if len(targets) <= LOOKED_UP:
        # one row a key and target: its value goes to the target's place, over rows that are sorted by key already
        places = [F.max(F.when(F.col("target_name") == t.name, F.col("_value"))).alias(f"_{i}") for i, t in enumerate(targets)]
        return _read_targets(best.groupBy(*keys).agg(*places, *firsts), [*keys, *ids], targets, [f"_{i}" for i in range(len(targets))])
    entry = F.when(F.col("target_name").isNotNull(), F.struct("target_name", "_value"))
    gathered = best.groupBy(*keys).agg(F.map_from_entries(F.collect_list(entry)).alias("_m"), *firsts)
    schema = T.StructType([T.StructField(t.name, T.StringType()) for t in targets])
    wide = gathered.select(*keys, *ids, F.from_json(F.to_json("_m"), schema).alias("_s"))
    return _read_targets(wide, [*keys, *ids], targets, [f"_s[{quoted(t.name)}]" for t in targets])


def _unless_null(value: Column) -> Column:
    return F.when(value != SENT_NULL, value)


def _read_targets(wide: DataFrame, kept_columns: list[str], targets: list[Target], places: list[str]) -> DataFrame:
    """Targets from the SQL expressions of what was gathered for them."""
    columns = []
    for t, kept in zip(targets, places):
        text = f"IF({kept} <> {quoted(SENT_NULL)}, {kept}, NULL)"
        columns.append(F.expr(text if t.is_text else sent_number_sql(kept)).alias(t.name))
    return wide.select(*kept_columns, *columns)


def gather_frames(
    tall: DataFrame,
    mapping: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """Tall signals back to frames with ``codes`` and ``vals``, for ``fusion.fuse_frames``.

    Only mapped codes are gathered and each counts once, with its last value by ``order``, so a frame
    is no longer than the mapping. A frame none of whose codes is mapped keeps a row with empty lists.
    """
    known = mapping.select(F.col("signal_name").alias("pid")).distinct().withColumn("_known", F.lit(True))
    known = sized(known)
    rows = tall.join(known, "pid", "left").withColumn("pid", F.when(F.col("_known"), F.col("pid")))
    best = rows.groupBy(*keys, "pid").agg(
        F.max_by(F.coalesce("value", F.lit(SENT_NULL)), _order(order)).alias("value")
    )
    pair = F.when(F.col("pid").isNotNull(), F.struct("pid", "value"))
    return best.groupBy(*keys).agg(F.array_sort(F.collect_list(pair)).alias("_pairs")).select(
        *keys,
        F.transform("_pairs", lambda p: p.getField("pid")).alias("codes"),
        F.transform("_pairs", lambda p: _unless_null(p.getField("value"))).alias("vals"),
    )


def fuse_tall(
    tall: DataFrame,
    mapping: DataFrame,
    keys: Sequence[str] = ("ein", "clt_timestamp"),
    order: Sequence[str] = ("pos",),
    rule: str = "valid",
    **options,
) -> DataFrame:
    """Tall signals fused by any rule of ``fusion.fuse_frames``, formulas too: gathered to frames, which hold no more
    than the mapped codes, then fused inside the row."""
    return fuse_frames(gather_frames(tall, mapping, keys, order), mapping, rule, **options)
