"""The given tables read as telemetry, row by row, so the work grows with them.

A line item is one raw frame of an engine (its supplier): its numbers are signals, and the return flag
and line status decide which of several codes carries one. An order is an entry of the device history of
an engine (its customer). An event is one signal row of a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from telefold.functions.clean import strip_one_zero
from telefold.functions.clock import text_epoch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parallel(df: DataFrame) -> DataFrame:
    """The given files are one row group each, which Spark cannot split, so a scan with fewer tasks than cores is
    dealt out. Tables of more row groups are read as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def text(c: str) -> Column:
    return F.col(c).cast("string")


def _clock() -> Column:
    return F.col("l_shipdate").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("l_linenumber") * 3)


def raw_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flavour A: ``ein, deviceID, uploadTime1, uploadDate, params, longitude, latitude, CreateTime``.

    Lists differ in length on line 7, the code DCW_D comes twice on lines 6 and 7, a tax of 0.08 is
    sent as text that is no number, and the engine id of supplier 0 is blank unless it has a zero more.
    """
    flag_a = F.col("l_returnflag") == "A"
    again = F.col("l_linenumber") > 5
    codes = F.concat(
        F.array(
            F.concat(F.lit("SAE_Q"), "l_returnflag"),
            F.concat(F.lit("WW_P"), "l_linestatus"),
            F.lit("DCW_D"),
            F.lit("MD1_T"),
            F.lit("ZZ_X"),
        ),
        F.when(flag_a, F.array(F.lit("F17_S"))).otherwise(F.array().cast("array<string>")),
        F.when(again, F.array(F.lit("DCW_D"))).otherwise(F.array().cast("array<string>")),
    )
    values = F.concat(
        F.array(
            text("l_quantity"),
            text("l_extendedprice"),
            text("l_discount"),
            F.when(F.col("l_tax") >= 0.08, F.lit("n/a")).otherwise(text("l_tax")),
            text("l_partkey"),
        ),
        F.when(flag_a, F.array(F.concat_ws("/", "l_returnflag", "l_linestatus"))).otherwise(
            F.array().cast("array<string>")
        ),
        F.when(F.col("l_linenumber") == 6, F.array(text("l_tax"))).otherwise(F.array().cast("array<string>")),
    )
    return parallel(table(spark, sf_dir, "lineitem")).select(
        "l_orderkey",
        "l_linenumber",
        F.when(flag_a, F.concat(F.lit("0"), text("l_suppkey"))).otherwise(text("l_suppkey")).alias("ein"),
        F.concat(F.lit("V"), text("l_partkey")).alias("deviceID"),
        _clock().alias("uploadTime1"),
        F.to_date("l_shipdate").alias("uploadDate"),
        F.struct(codes.alias("codeM"), values.alias("valueM")).alias("params"),
        (F.col("l_discount") * 100 + 100).cast("string").alias("longitude"),
        F.when(F.col("l_linestatus") == "O", text("l_quantity")).alias("latitude"),
        "l_shipdate",
    )


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same frames as the fusion takes them."""
    raw = raw_frames(spark, sf_dir)
    clt_time = F.date_format("uploadTime1", "yyyy-MM-dd HH:mm:ss")
    return raw.select(
        "l_orderkey",
        "l_linenumber",
        strip_one_zero(F.col("ein")).alias("ein"),
        F.col("deviceID").alias("vin"),
        clt_time.alias("clt_time"),
        text_epoch(clt_time, zone="UTC").alias("clt_timestamp"),
        F.col("uploadDate").cast("string").alias("clt_date"),
        F.col("params.codeM").alias("codes"),
        F.col("params.valueM").alias("vals"),
        "longitude",
        "latitude",
    )


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device history: ``hos_id, vin, hos_mat_id, hos_series, type, create_time``; ids repeat."""
    return table(spark, sf_dir, "orders").select(
        text("o_custkey").alias("hos_id"),
        F.when(F.col("o_totalprice") > 50000, F.concat(F.lit("V"), text("o_orderkey"))).alias("vin"),
        text("o_orderkey").alias("hos_mat_id"),
        F.when(F.col("o_orderstatus") == "F", F.concat(F.substring("o_orderpriority", 1, 1), F.lit("系列")))
        .otherwise(F.substring("o_orderpriority", 1, 1))
        .alias("hos_series"),
        F.col("o_orderstatus").alias("type"),
        F.col("o_orderdate").alias("create_time"),
    )


def signal_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tall signal rows: one engine's signals of one hour share a time stamp."""
    hour = F.date_format("ts", "yyyy-MM-dd HH:00:00")
    return table(spark, sf_dir, "events").select(
        text("user_id").alias("ein"),
        F.concat(F.lit("V"), text("user_id")).alias("vin"),
        text_epoch(hour, zone="UTC").alias("clt_timestamp"),
        F.col("event_id").alias("pos"),
        F.col("event_type").alias("pid"),
        text("value").alias("value"),
    )


MAPPING = "target_name string, target_unit string, signal_name string, signal_unit string, min_val double, max_val double, default_val double, extend_feature string, id int"

# The mapping most queries fuse with.
MAPPING_ROWS = [
    ("distance", "m", "SAE_QA", "km", 5.0, 40.0, -1.0, None, 1),
    ("distance", "m", "SAE_QN", "m", 0.0, 30.0, -2.0, None, 2),
    ("pressure", "hPa", "WW_PF", "kPa", 1000.0, 90000.0, -1.0, None, 3),
    ("pressure", "hPa", "WW_PO", "MPa", None, 90000.0, -2.0, None, 4),
    ("ratio", "rate", "DCW_D", "pct", None, None, -999.0, None, 5),
    ("flow", "mg/s", "MD1_T", "g/min", 0.0, 0.05, -999.0, None, 6),
    ("mix", "%", "DCW_D", "%", 0.02, 0.06, -1.0, None, 7),
    ("mix", "%", "MD1_T", "%", 0.0, 0.05, -2.0, None, 8),
    ("state", None, "F17_S", "-", None, None, None, None, 9),
]
FORMULA_ROWS = [
    *MAPPING_ROWS,
    (
        "load_index", "%", "NO_SIGNAL", "%", 0.0, 4000.0, -999.0,
        '{"extend": {"type": "calculate", "formula": "{distance} / ({ratio} * (273 + {flow})) - -1"}}', 10,
    ),
]


def mapping(spark: SparkSession, rows: list | None = None) -> DataFrame:
    return spark.createDataFrame(rows or MAPPING_ROWS, MAPPING)


# The frames' signals stated directly in SQL: what each code carries after cutting and de-duplication.
RAW_SQL = """
raw AS (
  SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice,
         l_discount, l_tax, l_returnflag, l_linestatus,
         CASE WHEN l_returnflag = 'A' THEN l_suppkey::VARCHAR
              WHEN l_suppkey::VARCHAR LIKE '0%' THEN substr(l_suppkey::VARCHAR, 2)
              ELSE l_suppkey::VARCHAR END AS ein,
         'V' || l_partkey::VARCHAR AS vin,
         l_shipdate + to_hours(l_linenumber * 3) AS sent_at,
         CASE WHEN l_returnflag = 'A' THEN l_quantity END AS qa,
         CASE WHEN l_returnflag = 'N' THEN l_quantity END AS qn,
         CASE WHEN l_linestatus = 'F' THEN l_extendedprice END AS pf,
         CASE WHEN l_linestatus = 'O' THEN l_extendedprice END AS po,
         CASE WHEN l_linenumber = 6 THEN l_tax ELSE l_discount END AS d,
         CASE WHEN l_tax < 0.08::DOUBLE THEN l_tax END AS t,
         CASE WHEN l_returnflag = 'A' THEN l_returnflag || '/' || l_linestatus END AS s
  FROM lineitem)
"""

DEVICES_SQL = """
devices AS (
  SELECT o_custkey::VARCHAR AS hos_id,
         CASE WHEN o_totalprice > 50000 THEN 'V' || o_orderkey::VARCHAR END AS vin,
         o_orderkey::VARCHAR AS hos_mat_id,
         substr(o_orderpriority, 1, 1) || CASE WHEN o_orderstatus = 'F' THEN '系列' ELSE '' END AS hos_series,
         o_orderstatus AS type, o_orderdate AS create_time
  FROM orders),
newest AS (
  SELECT hos_id, hos_mat_id, hos_series, type, create_time FROM (
    SELECT *, row_number() OVER (PARTITION BY hos_id ORDER BY create_time DESC, hos_mat_id DESC) AS rn
    FROM devices) WHERE rn = 1)
"""

# Both lists of a frame as comma-separated text, numbers as Spark prints them.
_NUMBER_SQL = "CASE WHEN {0} = floor({0}) AND abs({0}) < 1e7 THEN CAST({0}::BIGINT AS VARCHAR) || '.0' ELSE CAST({0} AS VARCHAR) END"
LISTS_SQL = f"""'SAE_Q' || l_returnflag || ',WW_P' || l_linestatus || ',DCW_D,MD1_T,ZZ_X'
        || CASE WHEN s IS NULL THEN '' ELSE ',F17_S' END || CASE WHEN l_linenumber > 5 THEN ',DCW_D' ELSE '' END AS codes,
      {_NUMBER_SQL.format("l_quantity")} || ',' || {_NUMBER_SQL.format("l_extendedprice")} || ',' || {_NUMBER_SQL.format("l_discount")}
        || ',' || CASE WHEN l_tax >= 0.08::DOUBLE THEN 'n/a' ELSE {_NUMBER_SQL.format("l_tax")} END || ',' || CAST(l_partkey AS VARCHAR)
        || CASE WHEN s IS NULL THEN '' ELSE ',' || s END
        || CASE WHEN l_linenumber = 6 THEN ',' || {_NUMBER_SQL.format("l_tax")} ELSE '' END AS vals"""
