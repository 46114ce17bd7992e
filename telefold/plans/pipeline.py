"""From raw frames to the fused table: parse, fuse, fixed columns, devices, rejects.

One projection from scan to write; only a device table too large to broadcast adds a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from telefold.functions import clean, clock, listtext
from telefold.operators.enrich import enrich_devices
from telefold.operators.fusion import fuse_frames
from telefold.operators.mapping import Target

#: How code and value lists arrive: as arrays, or as text in one of three spellings.
FORMS = {
    "arrays": (lambda c: c, lambda c: c),
    "comma": (listtext.split_list, listtext.split_list),
    "bracket": (listtext.quoted_items, listtext.bracket_items),
    "words": (listtext.word_items, listtext.bracket_items),
    "quoted": (listtext.quoted_items, listtext.quoted_items),
}


def parse_lists(frames: DataFrame, form: str) -> DataFrame:
    """``codes`` and ``vals`` as arrays."""
    read_codes, read_values = FORMS[form]
    codes, values = read_codes(F.col("codes")), read_values(F.col("vals"))
    if form == "quoted":
        values = F.transform(values, lambda x: F.btrim(x, F.lit("val")))
    return frames.withColumn("codes", codes).withColumn("vals", values)


def _reason(bad_number: bool, corrupt: bool = False) -> Column:
    reason = (
        F.when(F.col("corrupt").isNotNull() if corrupt else F.lit(False), F.lit("unreadable message"))
        .when(F.coalesce(F.col("ein"), F.lit("")) == "", F.lit("no engine id"))
        .when(F.col("clt_timestamp").isNull(), F.lit("no readable time"))
    )
    if bad_number:
        names = F.array_join("bad_targets", ",")
        reason = reason.when(F.size("bad_targets") > 0, F.concat(F.lit("unreadable number: "), names))
    return reason


def fuse_table(
    frames: DataFrame,
    mapping: DataFrame | list[Target],
    devices: DataFrame | None = None,
    data_source: str = "telemetry",
    data_type: str = "gc",
    form: str = "arrays",
    rule: str = "first",
    on_bad_number: str = "null",
    round_to: int | None = None,
    number_type: str = "double",
    formulas: bool = False,
    zone: str | None = None,
    salts: int = 1,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Every frame as one fused row with its key columns and a ``reject_reason`` (NULL for a good row).

    ``carry`` names more input columns to keep; one of them, ``corrupt``, is the text of an unreadable message.

    Input columns, as the scans give them: ``ein`` (already without its extra zero), ``vin``, ``clt_time``
    (wall-clock text), ``codes``, ``vals``, ``longitude``, ``latitude``.
    """
    seconds = clock.text_epoch(F.col("clt_time"), zone=zone) if zone else F.unix_timestamp(
        F.col("clt_time").try_cast("timestamp")
    )
    keyed = parse_lists(frames, form).select(
        "ein",
        "vin",
        F.lit(data_source).alias("data_source"),
        F.lit(data_type).alias("data_type"),
        seconds.alias("clt_timestamp"),
        "clt_time",
        F.substring("clt_time", 1, 10).alias("clt_date"),
        clean.number(F.col("longitude").cast("string")).alias("lng"),
        clean.number(F.col("latitude").cast("string")).alias("lat"),
        *([clean.number(F.col("high").cast("string")).alias("high")] if "high" in frames.columns else []),
        *carry,
        "codes",
        "vals",
    )
    fused = fuse_frames(
        keyed,
        mapping,
        rule,
        on_bad_number=on_bad_number,
        round_to=round_to,
        number_type=number_type,
        formulas=formulas,
    )
    if devices is not None:
        fused = enrich_devices(fused, devices, salts)
    marked = fused.withColumn("reject_reason", _reason("bad_targets" in fused.columns, "corrupt" in carry))
    return marked.drop("bad_targets")


def good_rows(fused: DataFrame) -> DataFrame:
    return fused.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected_rows(fused: DataFrame) -> DataFrame:
    return fused.where(F.col("reject_reason").isNotNull())
