"""Sinks, backfills and streams: written under the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.fusion import G_MIN, group_mapping, group_scaling
from suite.inputs import LISTS_SQL, RAW_SQL, frames, mapping, table
from suite.registry import query
from suite.scans import frame_messages, signal_messages
from telefold.functions import listtext
from telefold.operators import fusion, mapping as maps, units
from telefold.plans import backfill
from telefold.plans.pipeline import fuse_table
from telefold.session import work_path
from telefold.sinks import tables as sinks
from telefold.sources.streams import open_files
from telefold.streaming import jobs

FUSED = ("vin", "clt_timestamp", "distance", "pressure", "ratio", "flow", "mix", "state")
FUSED_SQL = f"""CASE WHEN qa IS NOT NULL THEN qa * 1000.0::DOUBLE ELSE qn END AS distance,
    CASE WHEN pf IS NOT NULL THEN pf * 10.0::DOUBLE ELSE po * 10000.0::DOUBLE END AS pressure,
    d AS ratio, t * {G_MIN}::DOUBLE AS flow, d AS mix, s AS state"""
MONTH_SQL = "strftime(l_shipdate, '%Y-%m-01')"


def _rows(spark, sf_dir):
    """Fused rows laid out by month."""
    compiled = maps.compile_mapping(mapping(spark), "id")
    fused = fusion.fuse_frames(frames(spark, sf_dir), compiled)
    return fused.select(
        *FUSED,
        F.when(F.col("state").isNull(), "source_b").otherwise("source_a").alias("data_source"),
        F.lit("gc").alias("data_type"),
        F.concat(F.substring("clt_date", 1, 8), F.lit("01")).alias("clt_date"),
    )


def _read(spark, path):
    return sinks.read_partitions(spark, path).select(*FUSED, *sinks.LAYOUT)


WRITTEN = f"""SELECT vin, epoch(sent_at)::BIGINT AS clt_timestamp, {FUSED_SQL},
    CASE WHEN s IS NULL THEN 'source_b' ELSE 'source_a' END AS data_source, 'gc' AS data_type, {MONTH_SQL} AS clt_date"""


@query("reload_partition_twice", f"WITH {RAW_SQL} {WRITTEN} FROM raw")
def reload_partition_twice(spark, sf_dir):
    path = work_path(spark, "reload")
    rows = _rows(spark, sf_dir)
    sinks.reload_partitions(rows, path, cluster=True)
    sinks.reload_partitions(rows.where("clt_date >= '1999-01-01'"), path, cluster=True)
    return _read(spark, path)


@query(
    "delete_then_append",
    f"""WITH {RAW_SQL}, w AS ({WRITTEN} FROM raw)
    SELECT * FROM w WHERE NOT coalesce(data_source = 'source_a' AND clt_date = '1997-05-01' AND distance > 20000, false)
    UNION ALL SELECT vin, clt_timestamp, -1.0::DOUBLE, pressure, ratio, flow, mix, state, 'source_a', 'gc', '1997-05-01' FROM w WHERE clt_date = '1996-02-01'""",
)
def delete_then_append(spark, sf_dir):
    path = work_path(spark, "table")
    rows = _rows(spark, sf_dir)
    sinks.reload_partitions(rows, path, cluster=True)
    spoilt = (
        (F.col("data_source") == "source_a")
        & (F.col("clt_date").cast("string") == "1997-05-01")
        & (F.col("distance") > 20000)
    )
    new = rows.where("clt_date = '1996-02-01'").select(
        "vin", "clt_timestamp", F.lit(-1.0).alias("distance"), *FUSED[3:], F.lit("source_a").alias("data_source"),
        F.lit("gc").alias("data_type"), F.lit("1997-05-01").cast("date").alias("clt_date"),
    )
    sinks.delete_then_append(spark, path, spoilt, new)
    return _read(spark, path)


@query(
    "backfill_range",
    f"""WITH {RAW_SQL}
    SELECT ein, vin, epoch(sent_at)::BIGINT AS clt_timestamp, {FUSED_SQL},
           'source_c' AS data_source, strftime(sent_at, '%Y-%m-%d') AS clt_date
    FROM raw WHERE l_shipdate BETWEEN DATE '1997-03-01' AND DATE '1997-04-15'""",
)
def backfill_range(spark, sf_dir):
    """Six weeks in one job, then the last two days once more."""
    path = work_path(spark, "backfill")
    compiled = maps.compile_mapping(mapping(spark), "id")

    def fuse(days):
        return fuse_table(days, compiled, data_source="source_c", zone="UTC").drop("reject_reason")

    raw = frames(spark, sf_dir)
    backfill.backfill(raw, fuse, path, "1997-03-01", "1997-04-15")
    backfill.backfill(raw, fuse, path, "1997-04-14", "1997-04-15")
    return sinks.read_partitions(spark, path).select("ein", *FUSED, "data_source", "clt_date")


@query(
    "backfill_empty_day",
    f"""WITH {RAW_SQL}
    SELECT ein, vin, epoch(sent_at)::BIGINT AS clt_timestamp, {FUSED_SQL},
           'source_c' AS data_source, strftime(sent_at, '%Y-%m-%d') AS clt_date
    FROM raw WHERE l_shipdate BETWEEN DATE '1997-03-01' AND DATE '1997-04-15' AND l_shipdate <> DATE '1997-03-20'""",
)
def backfill_empty_day(spark, sf_dir):
    """A range of days once more, after one of its days has lost all frames."""
    path = work_path(spark, "backfill")
    compiled = maps.compile_mapping(mapping(spark), "id")

    def fuse(days):
        return fuse_table(days, compiled, data_source="source_c", zone="UTC").drop("reject_reason")

    raw = frames(spark, sf_dir)
    backfill.backfill(raw, fuse, path, "1997-03-01", "1997-04-15", data_source="source_c")
    backfill.backfill(raw.where("clt_date <> '1997-03-20'"), fuse, path, "1997-03-10", "1997-03-31", data_source="source_c")
    return sinks.read_partitions(spark, path).select("ein", *FUSED, "data_source", "clt_date")


def _odd_names(rows):
    """Sources whose names paths escape, or readers take for numbers."""
    odd = F.when(F.col("data_source") == "source_a", "a:b").when(F.col("mix") > 0.05, "001")
    return rows.withColumn("data_source", odd)


ODD_SQL = "CASE WHEN data_source = 'source_a' THEN 'a:b' WHEN mix > 0.05 THEN '001' END AS data_source"


@query(
    "reload_day_odd_names",
    f"""WITH {RAW_SQL}, w AS ({WRITTEN} FROM raw), o AS (SELECT * REPLACE ({ODD_SQL}) FROM w)
    SELECT * FROM o WHERE NOT coalesce(data_source = '001' AND clt_date = '1997-02-01', false)""",
)
def reload_day_odd_names(spark, sf_dir):
    """One day again with its rows, another without any."""
    path = work_path(spark, "reload")
    rows = _odd_names(_rows(spark, sf_dir))
    sinks.reload_partitions(rows, path, cluster=True)
    sinks.reload_day(rows, path, "a:b", "gc", "1997-01-01")
    sinks.reload_day(rows.limit(0), path, "001", "gc", "1997-02-01")
    return _read(spark, path)


@query(
    "delete_then_append_odd_names",
    f"""WITH {RAW_SQL}, w AS ({WRITTEN} FROM raw), o AS (SELECT * REPLACE ({ODD_SQL}) FROM w)
    SELECT * FROM o WHERE NOT coalesce(clt_date = '1997-02-01' AND data_source = '001' OR clt_date = '1997-03-01' AND data_source = 'a:b'
                                       OR clt_date = '1997-04-01' AND data_source IS NULL OR clt_date = '1997-05-01' AND ratio < 0.05::DOUBLE, false)
    UNION ALL SELECT vin, clt_timestamp, -1.0::DOUBLE, pressure, ratio, flow, mix, state, data_source, data_type, '1997-05-01'
    FROM o WHERE clt_date = '1996-02-01'""",
)
def delete_then_append_odd_names(spark, sf_dir):
    """Three partitions emptied, one thinned out and added to, under such names."""
    path = work_path(spark, "table")
    rows = _odd_names(_rows(spark, sf_dir))
    sinks.reload_partitions(rows, path, cluster=True)
    source, day = F.col("data_source"), F.col("clt_date")
    spoilt = (
        ((day == "1997-02-01") & (source == "001")) | ((day == "1997-03-01") & (source == "a:b"))
        | ((day == "1997-04-01") & source.isNull()) | ((day == "1997-05-01") & (F.col("ratio") < 0.05))
    )
    new = rows.where("clt_date = '1996-02-01'").withColumns({"distance": F.lit(-1.0), "clt_date": F.lit("1997-05-01")})
    sinks.delete_then_append(spark, path, spoilt, new)
    return _read(spark, path)


@query(
    "yesterday_default",
    "SELECT user_id, count(*) AS n FROM events WHERE day(ts) = 1 GROUP BY user_id",
)
def yesterday_default(spark, sf_dir):
    """Dates moved so that the first of a month is yesterday."""
    ev = table(spark, sf_dir, "events").withColumn("day", F.date_sub(F.current_date(), F.dayofmonth("ts")))
    return backfill.day_range(ev, "day").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "csv_at_export",
    f"""WITH {RAW_SQL} SELECT ein, vin, epoch(sent_at)::BIGINT AS clt_timestamp,
      {LISTS_SQL} FROM raw WHERE ein <> ''""",
)
def csv_at_export(spark, sf_dir):
    """Both lists whole, as the archive has them."""
    path = work_path(spark, "archive")
    rows = frames(spark, sf_dir).where("ein <> ''")
    lists = (listtext.join_list(F.col(c)).alias(c) for c in ("codes", "vals"))
    sinks.export_archive(rows.select("ein", "vin", "clt_timestamp", *lists), path)
    return spark.read.csv(path, sep="@", header=True, schema="ein string, vin string, clt_timestamp bigint, codes string, vals string")


@query(
    "table_copy",
    "SELECT event_id, value FROM events WHERE event_type = 'view' AND ts < TIMESTAMP '2024-01-20 00:00:00'",
)
def table_copy(spark, sf_dir):
    path = work_path(spark, "copy")
    ev = table(spark, sf_dir, "events")
    cutoff = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    sinks.copy_rows(ev, (F.col("event_type") == "view") & (F.col("ts") < cutoff), path)
    return spark.read.parquet(path).select("event_id", "value")


@query("sized_files", "SELECT count(*) AS n, max(event_id) AS last, true AS small FROM events")
def sized_files(spark, sf_dir):
    """No file over 1000 rows."""
    path = work_path(spark, "sized")
    sinks.write_sized(table(spark, sf_dir, "events"), path, 1000)
    got = spark.read.parquet(path)
    per_file = got.groupBy(F.input_file_name().alias("f")).agg(
        F.count(F.lit(1)).alias("c"), F.max("event_id").alias("m")
    )
    return per_file.agg(F.sum("c").alias("n"), F.max("m").alias("last"), (F.max("c") <= 1000).alias("small"))


@query("sized_rows", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def sized_rows(spark, sf_dir):
    """What is in the files of at most 1000 rows."""
    path = work_path(spark, "sized")
    sinks.write_sized(table(spark, sf_dir, "events"), path, 1000)
    return spark.read.parquet(path).select("event_id", "ts", "user_id", "event_type", "value", "props")


@query("replace_table", "SELECT c_custkey, c_name FROM customer")
def replace_table(spark, sf_dir):
    path = work_path(spark, "small")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    for _ in range(2):
        sinks.replace_table(customer, path)
    return spark.read.parquet(path)


@query(
    "stream_frames_file",
    """SELECT user_id::VARCHAR AS ein, 'V' || user_id::VARCHAR AS vin, epoch(date_trunc('second', ts))::BIGINT AS clt_timestamp,
           CASE event_type WHEN 'click' THEN value * 0.001::DOUBLE WHEN 'view' THEN value END AS speed,
           CASE event_type WHEN 'error' THEN value * 10.0::DOUBLE END AS pressure,
           strftime(ts, '%Y-%m-%d %H:%M:%S') AS clt_time, 'telemetry' AS data_source, 'gc' AS data_type,
           strftime(ts, '%Y-%m-%d') AS clt_date FROM events""",
)
def stream_frames_file(spark, sf_dir):
    """Messages as text files, taken in batches of three files."""
    source, path, checkpoint = (work_path(spark, n) for n in ("messages", "fused", "progress"))
    frame_messages(spark, sf_dir).repartition(6).write.text(source)
    run = jobs.stream_frames(
        open_files(spark, source, 3), group_mapping(spark), path, checkpoint, every=None, zone="UTC"
    )
    run.awaitTermination()
    fused = sinks.read_partitions(spark, path)
    return fused.select("ein", "vin", "clt_timestamp", "speed", "pressure", "clt_time", *sinks.LAYOUT)


@query(
    "stream_rejects",
    """SELECT 'frame' AS kind, 'unreadable message' AS reject_reason, '{"ein": ' || event_id::VARCHAR AS text FROM events WHERE event_id % 3 = 0
    UNION ALL SELECT 'list', 'unreadable message', 'junk ' || event_id::VARCHAR FROM events WHERE event_id % 5 = 0
    UNION ALL SELECT 'good frames', NULL, count(*)::VARCHAR FROM events
    UNION ALL SELECT 'good lists', NULL, count(DISTINCT (user_id, date_trunc('second', ts)))::VARCHAR FROM events""",
)
def stream_rejects(spark, sf_dir):
    """Messages of both flavours with junk among them: what can't be read is kept with its text."""
    paths = {n: work_path(spark, n) for n in ("m1", "m2", "good1", "good2", "bad1", "bad2", "c1", "c2")}
    ev = table(spark, sf_dir, "events")
    half = ev.where("event_id % 3 = 0").select(F.format_string('{"ein": %d', "event_id").alias("value"))
    junk = ev.where("event_id % 5 = 0").select(F.format_string("junk %d", "event_id").alias("value"))
    frame_messages(spark, sf_dir).select("value").union(half).write.text(paths["m1"])
    signal_messages(spark, sf_dir).union(junk).write.text(paths["m2"])
    compiled = group_mapping(spark)
    for run in (
        jobs.stream_frames(open_files(spark, paths["m1"]), compiled, paths["good1"], paths["c1"], every=None, zone="UTC", rejects=paths["bad1"]),
        jobs.stream_signals(open_files(spark, paths["m2"]), compiled, paths["good2"], paths["c2"], every=None, zone="UTC", rejects=paths["bad2"]),
    ):
        run.awaitTermination()
    bad = [
        spark.read.parquet(paths["bad1"]).select(F.lit("frame").alias("kind"), "reject_reason", "text"),
        spark.read.parquet(paths["bad2"]).select(F.lit("list").alias("kind"), "reject_reason", "text"),
    ]
    for kind, n in (("good frames", "good1"), ("good lists", "good2")):
        counted = spark.read.parquet(paths[n]).agg(F.count(F.lit(1)).cast("string").alias("text"))
        bad.append(counted.select(F.lit(kind).alias("kind"), F.lit(None).cast("string").alias("reject_reason"), "text"))
    return bad[0].union(bad[1]).union(bad[2]).union(bad[3])


@query(
    "stream_grouped_file",
    """WITH e AS (SELECT user_id::VARCHAR AS ein, epoch(date_trunc('second', ts))::BIGINT AS clt_timestamp, event_id,
                         event_type, value FROM events)
    SELECT ein, clt_timestamp, min('V' || event_id::VARCHAR) AS vin, 121.5::DOUBLE AS lng,
           arg_min(CASE event_type WHEN 'click' THEN (value * 2.0::DOUBLE + 1.0::DOUBLE) * 0.001::DOUBLE ELSE value END,
                   (event_type, value)) FILTER (WHERE event_type IN ('click', 'view')) AS speed,
           min((value + 0.5::DOUBLE) * 10.0::DOUBLE) FILTER (WHERE event_type = 'error') AS pressure,
           min(value) FILTER (WHERE event_type = 'signup') AS note,
           NULL::VARCHAR AS platname, 'source_d' AS data_source, 'gc' AS data_type, NULL::VARCHAR AS hos_mat_id,
           strftime(to_timestamp(clt_timestamp) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS clt_time,
           strftime(to_timestamp(clt_timestamp) AT TIME ZONE 'UTC', '%Y-%m-%d') AS clt_date
    FROM e GROUP BY ein, clt_timestamp""",
)
def stream_grouped_file(spark, sf_dir):
    """Lists of messages, position and signals, fused per engine and second in one batch."""
    source, path, checkpoint = (work_path(spark, n) for n in ("lists", "fused", "progress"))
    signal_messages(spark, sf_dir).write.text(source)
    position = spark.createDataFrame(
        [("lng", "deg", "lng", "deg", 9)],
        "target_name string, target_unit string, signal_name string, signal_unit string, id int",
    )
    place = units.attach_factor(position, "signal_unit", "target_unit").select(
        "target_name", "signal_name", F.lit(1).alias("priority"), F.lit(False).alias("is_text"),
        "target_unit", "signal_unit", "factor", F.lit(True).alias("convertible"),
    )
    compiled = group_mapping(spark).unionByName(place, allowMissingColumns=True)
    run = jobs.stream_signals(
        open_files(spark, source), compiled, path, checkpoint, scaling=group_scaling(spark), every=None, zone="UTC",
        data_source="source_d", data_type="gc",
    )
    run.awaitTermination()
    got = sinks.read_partitions(spark, path).withColumn("note", F.col("note").cast("double"))
    seconds = F.col("clt_timestamp").cast("bigint").alias("clt_timestamp")
    return got.select("ein", seconds, "vin", "lng", "speed", "pressure", "note", "platname", "hos_mat_id", "clt_time", *sinks.LAYOUT)


@query(
    "fused_table_by_schema",
    f"""WITH {RAW_SQL} SELECT ein, vin, 'telemetry' AS data_source, 'gc' AS data_type, epoch(sent_at)::BIGINT AS clt_timestamp,
      strftime(sent_at, '%Y-%m-%d') AS clt_date, {FUSED_SQL}, '0' AS is_delete, true AS stamped, NULL::VARCHAR AS extend_feature FROM raw""",
)
def fused_table_by_schema(spark, sf_dir):
    """Columns made from the mapping, rows of the full job written under them and read by that schema."""
    path = work_path(spark, "fused")
    rows = mapping(spark).withColumn("target_desc", F.col("target_name"))
    schema = maps.fused_schema(rows)
    fused = fuse_table(frames(spark, sf_dir), maps.compile_mapping(mapping(spark), "id"), zone="UTC")
    sinks.reload_partitions(maps.to_fused_table(fused, schema), path, cluster=True)
    got = spark.read.schema(schema).parquet(path)
    stamped = F.col("create_time").isNotNull().alias("stamped")
    return got.select("ein", *FUSED, *sinks.LAYOUT, "is_delete", stamped, "extend_feature")
