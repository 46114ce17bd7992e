"""Fusion in its variants."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.inputs import DEVICES_SQL, FORMULA_ROWS, MAPPING_ROWS, RAW_SQL, devices, frames, mapping, parallel, signal_events, table
from suite.registry import query
from telefold.functions import listtext
from telefold.functions.clock import WALL_FORMAT
from telefold.operators import fusion, grouped, mapping as maps
from telefold.plans.backfill import with_slice
from telefold.plans.pipeline import fuse_table, good_rows, rejected_rows

IDS = ["l_orderkey", "l_linenumber", "ein"]

G_MIN = repr(1000 / 60)


@query(
    "fuse_first_present",
    f"""WITH {RAW_SQL}
    SELECT l_orderkey, l_linenumber, ein,
           CASE WHEN qa IS NOT NULL THEN qa * 1000.0::DOUBLE ELSE qn END AS distance,
           CASE WHEN pf IS NOT NULL THEN pf * 10.0::DOUBLE ELSE po * 10000.0::DOUBLE END AS pressure,
           d AS ratio, t * {G_MIN}::DOUBLE AS flow, d AS mix, s AS state
    FROM raw""",
)
def fuse_first_present(spark, sf_dir):
    compiled = maps.compile_mapping(mapping(spark), "id")
    return _ids(fusion.fuse_frames(frames(spark, sf_dir), compiled, "first"))


def _ids(df, *more):
    targets = [c for c in ("distance", "pressure", "ratio", "flow", "mix", "state") if c in df.columns]
    return df.select(*IDS, *targets, *more)


@query(
    "fuse_slices",
    f"""WITH {RAW_SQL}
    SELECT l_orderkey, l_linenumber, ein,
           CASE WHEN qa IS NOT NULL THEN qa * 1000.0::DOUBLE ELSE qn END AS distance,
           CASE WHEN pf IS NOT NULL THEN pf * 10.0::DOUBLE ELSE po * 10000.0::DOUBLE END AS pressure,
           d AS ratio, t * {G_MIN}::DOUBLE AS flow, d AS mix, s AS state,
           strftime(greatest(TIMESTAMP '1991-12-31 23:50:00' + to_seconds(
             floor(epoch(sent_at - TIMESTAMP '1991-12-31 23:50:00') / 3000)::BIGINT * 3000), date_trunc('day', sent_at)),
             '%Y-%m-%d %H:%M:%S') AS slice_start
    FROM raw""",
)
def fuse_slices(spark, sf_dir):
    """All slices fused in one job: each frame names its slice, nothing loops."""
    compiled = maps.compile_mapping(mapping(spark), "id")
    raw = frames(spark, sf_dir).withColumn("sent", F.col("clt_time").cast("timestamp_ntz"))
    fused = fusion.fuse_frames(with_slice(raw, "sent", "1991-12-31 23:50:00", 3000), compiled, "first")
    return _ids(fused, F.date_format("slice_start", WALL_FORMAT).alias("slice_start"))


PACKED = [
    ("distance", "m", "SAE_QA;SAE_QN;SAE_QR", "km;m;cm", 1),
    ("pressure", "kPa", "WW_PO;WW_PF", "MPa;hPa", 2),
    ("flow", "g/min", "MD1_T", "mg/s", 3),
    ("state", None, "F17_S;F17_T", None, 4),
    ("broken", "m", "SAE_QA;SAE_QN", "km", 5),
]


@query(
    "fuse_packed_config",
    f"""WITH {RAW_SQL}
    SELECT l_orderkey, l_linenumber, ein,
           CASE l_returnflag WHEN 'A' THEN l_quantity * 1000.0::DOUBLE WHEN 'N' THEN l_quantity
                ELSE l_quantity * 0.01::DOUBLE END AS distance,
           CASE l_linestatus WHEN 'O' THEN l_extendedprice * 1000.0::DOUBLE
                ELSE l_extendedprice * 0.1::DOUBLE END AS pressure,
           coalesce(t * 0.06::DOUBLE, -999.0::DOUBLE) AS flow, s AS state
    FROM raw""",
)
def fuse_packed_config(spark, sf_dir):
    packed = spark.createDataFrame(
        PACKED, "target_name string, target_unit string, signal_code string, signal_unit string, id int"
    )
    flat = maps.unpack_mapping(packed).where(F.col("reason").isNull())
    compiled = maps.compile_mapping(flat, ["id", "place"])
    return _ids(fusion.fuse_frames(frames(spark, sf_dir), compiled, "first", on_bad_number="default"))


@query(
    "fuse_range_default",
    f"""WITH {RAW_SQL}
    SELECT l_orderkey, l_linenumber, ein,
           round(CASE WHEN qa BETWEEN 5 AND 40 THEN qa * 1000.0::DOUBLE WHEN qn BETWEEN 0 AND 30 THEN qn
                WHEN qn IS NOT NULL THEN -2.0::DOUBLE WHEN qa IS NOT NULL THEN -1.0::DOUBLE END, 6) AS distance,
           round(CASE WHEN pf BETWEEN 1000 AND 90000 THEN pf * 10.0::DOUBLE
                WHEN po <= 90000 THEN po * 10000.0::DOUBLE
                WHEN po IS NOT NULL THEN -2.0::DOUBLE ELSE -1.0::DOUBLE END, 6) AS pressure,
           round(d, 6) AS ratio,
           round(CASE WHEN t BETWEEN 0 AND 0.05::DOUBLE THEN t * {G_MIN}::DOUBLE
                ELSE -999.0::DOUBLE END, 6) AS flow,
           round(CASE WHEN d BETWEEN 0.02::DOUBLE AND 0.06::DOUBLE THEN d
                WHEN t BETWEEN 0 AND 0.05::DOUBLE THEN t ELSE -2.0::DOUBLE END, 6) AS mix,
           s AS state
    FROM raw""",
)
def fuse_range_default(spark, sf_dir):
    compiled = maps.compile_mapping(mapping(spark), "id")
    return _ids(fusion.fuse_frames(frames(spark, sf_dir), compiled, "valid", round_to=6))


@query(
    "fuse_last_present",
    f"""WITH {RAW_SQL}
    SELECT l_orderkey, l_linenumber, ein,
           CASE WHEN qn IS NOT NULL THEN qn ELSE qa * 1000.0::DOUBLE END AS distance,
           CASE WHEN po IS NOT NULL THEN po * 10000.0::DOUBLE ELSE pf * 10.0::DOUBLE END AS pressure,
           d AS ratio, t * {G_MIN}::DOUBLE AS flow, t AS mix, s AS state
    FROM raw""",
)
def fuse_last_present(spark, sf_dir):
    compiled = maps.compile_mapping(mapping(spark), "id")
    return _ids(fusion.fuse_frames(frames(spark, sf_dir), compiled, "last"))


@query(
    "fuse_positional",
    f"""WITH {RAW_SQL}
    SELECT l_orderkey, l_linenumber, ein,
           CASE WHEN qa IS NOT NULL THEN qa * 1000.0::DOUBLE ELSE qn END AS distance,
           CASE WHEN pf IS NOT NULL THEN pf * 10.0::DOUBLE ELSE po * 10000.0::DOUBLE END AS pressure,
           l_discount AS ratio, t * {G_MIN}::DOUBLE AS flow, l_discount AS mix, s AS state
    FROM raw""",
)
def fuse_positional(spark, sf_dir):
    """A code sent twice counts with its first value."""
    compiled = maps.compile_mapping(mapping(spark), "id")
    return _ids(fusion.fuse_frames(frames(spark, sf_dir), compiled, "first", duplicates="first"))


@query(
    "fuse_formula",
    f"""WITH {RAW_SQL}, f AS (
      SELECT l_orderkey, l_linenumber, ein,
             round(CASE WHEN qa BETWEEN 5 AND 40 THEN qa * 1000.0::DOUBLE WHEN qn BETWEEN 0 AND 30 THEN qn
                  WHEN qn IS NOT NULL THEN -2.0::DOUBLE WHEN qa IS NOT NULL THEN -1.0::DOUBLE END, 3) AS a,
             round(d, 3) AS b,
             round(CASE WHEN t BETWEEN 0 AND 0.05::DOUBLE THEN t * {G_MIN}::DOUBLE
                  ELSE -999.0::DOUBLE END, 3) AS c
      FROM raw), g AS (
      SELECT *, a / nullif(b * (273.0::DOUBLE + c), 0) - -1.0::DOUBLE AS v FROM f)
    SELECT l_orderkey, l_linenumber, ein,
           round(CASE WHEN v BETWEEN 0 AND 4000 THEN v ELSE -999.0::DOUBLE END, 4) AS load_index
    FROM g""",
)
def fuse_formula(spark, sf_dir):
    compiled = maps.compile_mapping(mapping(spark, FORMULA_ROWS), "id")
    fused = fusion.fuse_frames(frames(spark, sf_dir), compiled, "valid", round_to=6, formulas=True)
    return _ids(fused, F.round("load_index", 4).alias("load_index")).select(*IDS, "load_index")


@query(
    "fuse_reject",
    f"""WITH {RAW_SQL}
    SELECT ein, vin, strftime(sent_at, '%Y-%m-%d %H:%M:%S') AS clt_time,
           CASE WHEN ein = '' THEN 'no engine id'
                WHEN t IS NULL THEN 'unreadable number: flow' END AS reject_reason
    FROM raw WHERE ein = '' OR t IS NULL""",
)
def fuse_reject(spark, sf_dir):
    compiled = maps.compile_mapping(mapping(spark), "id")
    fused = fuse_table(frames(spark, sf_dir), compiled, on_bad_number="reject")
    return rejected_rows(fused).select("ein", "vin", "clt_time", "reject_reason")


FULL_SQL = f"""WITH {RAW_SQL}, {DEVICES_SQL}
    SELECT r.ein, r.vin, 'source_a' AS data_source, 'gc' AS data_type,
           epoch(sent_at)::BIGINT AS clt_timestamp, strftime(sent_at, '%Y-%m-%d %H:%M:%S') AS clt_time,
           strftime(sent_at, '%Y-%m-%d') AS clt_date,
           l_discount * 100 + 100 AS lng, CASE WHEN l_linestatus = 'O' THEN l_quantity END AS lat,
           CASE WHEN qa BETWEEN 5 AND 40 THEN qa * 1000.0::DOUBLE WHEN qn BETWEEN 0 AND 30 THEN qn
                WHEN qn IS NOT NULL THEN -2.0::DOUBLE WHEN qa IS NOT NULL THEN -1.0::DOUBLE END AS distance,
           CASE WHEN pf BETWEEN 1000 AND 90000 THEN pf * 10.0::DOUBLE WHEN po <= 90000 THEN po * 10000.0::DOUBLE
                WHEN po IS NOT NULL THEN -2.0::DOUBLE ELSE -1.0::DOUBLE END AS pressure,
           d AS ratio, CASE WHEN t BETWEEN 0 AND 0.05::DOUBLE THEN t * {G_MIN}::DOUBLE ELSE -999.0::DOUBLE END AS flow,
           CASE WHEN d BETWEEN 0.02::DOUBLE AND 0.06::DOUBLE THEN d
                WHEN t BETWEEN 0 AND 0.05::DOUBLE THEN t ELSE -2.0::DOUBLE END AS mix,
           s AS state, n.hos_series, n.hos_mat_id
    FROM raw r LEFT JOIN newest n ON r.ein = n.hos_id WHERE r.ein <> ''"""


@query("fuse_full", FULL_SQL)
def fuse_full(spark, sf_dir):
    """Text lists in, enriched fused table out."""
    raw = frames(spark, sf_dir).withColumns(
        {"codes": listtext.join_list(F.col("codes")), "vals": listtext.join_list(F.col("vals"))}
    )
    compiled = maps.compile_mapping(mapping(spark), "id")
    fused = fuse_table(
        raw, compiled, devices(spark, sf_dir), data_source="source_a", form="comma", rule="valid", zone="UTC"
    )
    return good_rows(fused)


@query(
    "fuse_decimal",
    f"""WITH {RAW_SQL}
    SELECT l_orderkey, l_linenumber, ein,
           CASE WHEN qa IS NOT NULL THEN qa * 1000.0::DOUBLE ELSE qn END::DECIMAL(20,7)::VARCHAR AS distance,
           CASE WHEN pf IS NOT NULL THEN pf * 10.0::DOUBLE ELSE po * 10000.0::DOUBLE END::DECIMAL(20,3)::VARCHAR AS pressure,
           d::DECIMAL(20,7)::VARCHAR AS ratio, (t * {G_MIN}::DOUBLE)::DECIMAL(20,7)::VARCHAR AS flow,
           d::DECIMAL(20,7)::VARCHAR AS mix, s AS state
    FROM raw""",
)
def fuse_decimal(spark, sf_dir):
    compiled = maps.compile_mapping(mapping(spark), "id")
    fused = fusion.fuse_frames(frames(spark, sf_dir), compiled, number_type="decimal(20,7)")
    texts = (F.col(c).cast("string").alias(c) for c in ("distance", "ratio", "flow", "mix"))
    # a large double has no seven digits after the point
    pressure = F.col("pressure").cast("decimal(20,3)").cast("string").alias("pressure")
    return _ids(fused).select(*IDS, *texts, pressure, "state")


@query(
    "fuse_by_series",
    f"""WITH {RAW_SQL}
    SELECT l_orderkey, l_linenumber, ein, l_linestatus AS hos_series,
           CASE l_linestatus WHEN 'F' THEN pf * 10.0::DOUBLE END AS pressure,
           d AS ratio,
           CASE l_linestatus WHEN 'O' THEN s END AS state
    FROM raw""",
)
def fuse_by_series(spark, sf_dir):
    """Two series, two mappings, one pass."""
    one = [r for r in MAPPING_ROWS if r[0] in ("pressure", "ratio")]
    two = [r for r in MAPPING_ROWS if r[0] in ("ratio", "state")]
    series = F.when(F.col("codes")[1] == "WW_PF", F.lit("F系列")).otherwise(F.lit("O"))
    fused = fusion.fuse_by_series(
        frames(spark, sf_dir).withColumn("hos_series", series),
        {
            "F": maps.compile_mapping(mapping(spark, one), "id"),
            "O系列": maps.compile_mapping(mapping(spark, two), "id"),
        },
    )
    base = F.regexp_replace("hos_series", "系列$", "")
    return _ids(fused, base.alias("hos_series")).select(*IDS, "hos_series", "pressure", "ratio", "state")


GROUP_ROWS = [
    ("speed", "km", "click", "m", 1),
    ("speed", "km", "view", "km", 2),
    ("pressure", "hPa", "error", "kPa", 3),
    ("note", None, "signup", None, 4),
]

GROUP_SQL = """
    WITH s AS (
      SELECT user_id::VARCHAR AS ein, 'V' || user_id::VARCHAR AS vin,
             epoch(date_trunc('hour', ts))::BIGINT AS clt_timestamp, event_id, event_type, value,
             CASE event_type WHEN 'click' THEN 'speed' WHEN 'view' THEN 'speed'
                  WHEN 'error' THEN 'pressure' WHEN 'signup' THEN 'note' END AS target,
             CASE event_type WHEN 'click' THEN (value * 2.0::DOUBLE + 1.0::DOUBLE) * 0.001::DOUBLE
                  WHEN 'view' THEN value
                  WHEN 'error' THEN (value * 1.0::DOUBLE + 0.5::DOUBLE) * 10.0::DOUBLE END AS v
      FROM events)
    SELECT ein, clt_timestamp, min(vin) AS vin,
           arg_min(v, event_id) FILTER (WHERE target = 'speed') AS speed,
           arg_min(v, event_id) FILTER (WHERE target = 'pressure') AS pressure,
           arg_min(value, event_id) FILTER (WHERE target = 'note') AS note
    FROM s GROUP BY ein, clt_timestamp"""


def group_mapping(spark):
    rows = spark.createDataFrame(
        GROUP_ROWS, "target_name string, target_unit string, signal_name string, signal_unit string, id int"
    )
    return maps.compile_mapping(rows, "id")


def group_scaling(spark):
    return spark.createDataFrame(
        [("click", 2.0, 1.0), ("error", None, 0.5)], "pid string, multiplier double, offset double"
    )


@query("fuse_scaled_group", GROUP_SQL)
def fuse_scaled_group(spark, sf_dir):
    fused = grouped.fuse_grouped(
        signal_events(spark, sf_dir), group_mapping(spark), scaling=group_scaling(spark)
    )
    return fused.withColumn("note", F.col("note").try_cast("double"))


@query(
    "fuse_gathered_frames",
    """WITH s AS (
      SELECT user_id::VARCHAR AS ein, epoch(date_trunc('hour', ts))::BIGINT AS clt_timestamp, event_type,
             event_id, value FROM events),
    l AS (SELECT ein, clt_timestamp, event_type, arg_max(value, event_id) AS v FROM s GROUP BY ALL)
    SELECT ein, clt_timestamp,
           coalesce(max(v * 0.001::DOUBLE) FILTER (WHERE event_type = 'click'),
                    max(v) FILTER (WHERE event_type = 'view')) AS speed,
           max(v * 10.0::DOUBLE) FILTER (WHERE event_type = 'error') AS pressure,
           max(v) FILTER (WHERE event_type = 'signup') AS note
    FROM l GROUP BY ein, clt_timestamp""",
)
def fuse_gathered_frames(spark, sf_dir):
    compiled = group_mapping(spark)
    gathered = grouped.gather_frames(
        signal_events(spark, sf_dir), compiled, ["ein", "clt_timestamp"], ["pos"]
    )
    fused = fusion.fuse_frames(gathered, compiled).select("ein", "clt_timestamp", "speed", "pressure", "note")
    return fused.withColumn("note", F.col("note").try_cast("double"))


WIDE_CODES = 114

# The values that a number's remainder by 1000 gives, in tenths, as Spark prints them; a negative one's has its sign.
WIDE_LOWEST = -1998
WIDE_VALUES = [repr((x % 1000 if x >= 0 else -(-x % 1000)) / 10) for x in range(WIDE_LOWEST, 1000 + WIDE_CODES)]


def wide_frames(spark, sf_dir):
    """Every line item as a frame of 114 signals."""
    codes = F.array(*[F.lit(f"SAE_J{i * 4:05d}") for i in range(WIDE_CODES)])
    base = F.col("l_orderkey") * 7 + F.col("l_partkey")
    # the 114 numbers after the base have neighbouring remainders, so their values are a piece of one list
    shown = F.when(base >= 0, base % 1000).when(base > -1000, base).otherwise(base % 1000 - 1000)
    values = F.slice(F.split(F.lit(",".join(WIDE_VALUES)), ","), (shown + 2 - WIDE_LOWEST).cast("int"), F.lit(WIDE_CODES))
    values = F.coalesce(values, F.array_repeat(F.lit(None).cast("string"), WIDE_CODES))
    keys = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return parallel(keys).select(
        "l_orderkey", "l_linenumber", "l_suppkey", codes.alias("codes"), values.alias("vals")
    )


def wide_mapping(spark):
    """228 targets, two signals each; one in four codes is sent."""
    rows = []
    for j in range(228):
        for k in (0, 1):
            rows.append((f"t{j}", "m", f"SAE_J{(2 * j + k) % 456:05d}", "km" if k == 0 else "cm", k))
    df = spark.createDataFrame(
        rows, "target_name string, target_unit string, signal_name string, signal_unit string, id int"
    )
    return maps.compile_mapping(df, "id")


def _wide(j: int) -> str:
    code, factor = (j * 2) % 456, "1000.0"
    if code % 4:
        code, factor = code + 1, "0.01"
    if code % 4:
        return "NULL::DOUBLE"
    return f"max(((l_orderkey * 7 + l_partkey + {code // 4 + 1}) % 1000) / 10.0::DOUBLE * {factor}::DOUBLE)"


@query(
    "fuse_wide_table",
    "SELECT l_suppkey, count(*) AS frames, "
    + ", ".join(f"{_wide(j)} AS t{j}" for j in range(228))
    + " FROM lineitem GROUP BY l_suppkey",
)
def fuse_wide_table(spark, sf_dir):
    """228 targets from 114-signal frames, then each target's largest value per engine."""
    fused = fusion.fuse_frames(wide_frames(spark, sf_dir), read_wide(spark))
    return fused.groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("frames"), *[F.max(f"t{j}").alias(f"t{j}") for j in range(228)]
    )


def read_wide(spark):
    return maps.read_targets(wide_mapping(spark))


@query(
    "fuse_wide_tall",
    "SELECT l_orderkey, l_linenumber, "
    + ", ".join(f"CASE WHEN l_linenumber % 2 = {i % 2} THEN l_quantity + {i} END AS t{i}" for i in range(70))
    + " FROM lineitem",
)
def fuse_wide_tall(spark, sf_dir):
    """Seventy codes, each two of which differ only in case; an even line sends the lower ones."""
    rows = [(f"t{i}", "m", f"{'c' if i % 2 == 0 else 'C'}{i // 2}", "m", i) for i in range(70)]
    compiled = maps.compile_mapping(
        spark.createDataFrame(rows, "target_name string, target_unit string, signal_name string, signal_unit string, id int"), "id"
    )
    even = F.col("l_linenumber") % 2 == 0
    codes = F.when(even, F.array(*[F.lit(f"c{i}") for i in range(35)])).otherwise(F.array(*[F.lit(f"C{i}") for i in range(35)]))
    first = F.when(even, 0).otherwise(1)
    values = F.transform(F.sequence(F.lit(0), F.lit(34)), lambda i: (F.col("l_quantity") + i * 2 + first).cast("string"))
    sent = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", codes.alias("codes"), values.alias("vals"))
    return fusion.fuse_frames(sent, compiled)


TALL_ROWS = [
    ("speed", "km", "click", "m", 5.0, 50.0, -1.0, None, 1),
    ("speed", "km", "view", "km", 0.0, 80.0, -2.0, None, 2),
    ("pressure", "hPa", "error", "kPa", None, 60.0, -9.0, None, 3),
    ("load", "%", "NO_SIGNAL", "%", 0.0, 5.0, -999.0, '{"extend": {"type": "calculate", "formula": "{speed} / ({pressure} + 20)"}}', 4),
]


@query(
    "fuse_grouped_valid",
    """WITH s AS (
      SELECT user_id::VARCHAR AS ein, epoch(date_trunc('hour', ts))::BIGINT AS clt_timestamp, event_type, event_id, value FROM events),
    l AS (SELECT ein, clt_timestamp, event_type, arg_max(value, event_id) AS v FROM s GROUP BY ALL),
    k AS (SELECT ein, clt_timestamp, max(v) FILTER (WHERE event_type = 'click') AS c, max(v) FILTER (WHERE event_type = 'view') AS w,
                 max(v) FILTER (WHERE event_type = 'error') AS e FROM l GROUP BY ALL),
    f AS (SELECT ein, clt_timestamp,
                 round(CASE WHEN c BETWEEN 5 AND 50 THEN c * 0.001::DOUBLE WHEN w BETWEEN 0 AND 80 THEN w
                            WHEN w IS NOT NULL THEN -2.0::DOUBLE WHEN c IS NOT NULL THEN -1.0::DOUBLE END, 3) AS speed,
                 round(CASE WHEN e <= 60 THEN e * 10.0::DOUBLE WHEN e IS NOT NULL THEN -9.0::DOUBLE END, 3) AS pressure FROM k)
    SELECT ein, clt_timestamp, speed, pressure,
           CASE WHEN speed / (pressure + 20) BETWEEN 0 AND 5 THEN speed / (pressure + 20) ELSE -999.0::DOUBLE END AS load FROM f""",
)
def fuse_grouped_valid(spark, sf_dir):
    """Range rule, defaults and a formula on tall rows."""
    compiled = maps.compile_mapping(mapping(spark, TALL_ROWS), "id")
    return grouped.fuse_tall(signal_events(spark, sf_dir), compiled, rule="valid", round_to=3, formulas=True)
