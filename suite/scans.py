"""Scans, joins and message decoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.inputs import DEVICES_SQL, LISTS_SQL, RAW_SQL, devices, raw_frames, table, text
from suite.registry import query
from telefold.functions import clock, listtext, messages, signals
from telefold.operators import enrich, mapping as maps, profile
from telefold.sources import frames as scans, metadata

SCAN = ["ein", "vin", "clt_time", "clt_timestamp", "clt_date"]
SCAN_SQL = """ein, vin, strftime(sent_at, '%Y-%m-%d %H:%M:%S') AS clt_time, epoch(sent_at)::BIGINT AS clt_timestamp,
    strftime(l_shipdate, '%Y-%m-%d') AS clt_date"""


def _scan(df, *more):
    """Keys and both lists, as text."""
    return df.select(*SCAN, *(listtext.join_list(F.col(c)).alias(c) for c in ("codes", "vals")), *more)


@query(
    "frame_scan_day",
    f"""WITH {RAW_SQL} SELECT {SCAN_SQL}, {LISTS_SQL}, CAST(5 + (s IS NOT NULL)::INTEGER + (l_linenumber > 5)::INTEGER AS INTEGER) AS n_codes
    FROM raw WHERE l_shipdate BETWEEN DATE '1997-03-01' AND DATE '1998-02-28'
      AND NOT (l_suppkey = 0 AND l_returnflag = '')""",
)
def frame_scan_day(spark, sf_dir):
    """Flavour A over a range of days."""
    df = scans.frames_a(raw_frames(spark, sf_dir), "1997-03-01", "1998-02-28")
    return _scan(df, F.size("codes").alias("n_codes"))


def _flavour_b(spark, sf_dir):
    raw = raw_frames(spark, sf_dir)
    return raw.select(
        "ein",
        F.col("deviceID").alias("vin"),
        F.col("uploadTime1").alias("clt_time"),
        F.col("params.valueM").alias("parse_value"),
        F.col("params.codeM").alias("code"),
        F.col("longitude").alias("lng"),
        F.col("latitude").alias("lat"),
        F.col("uploadDate").alias("clt_date"),
        F.when(F.col("l_linenumber") > 2, "source_b").otherwise("other").alias("data_source"),
    )


@query(
    "frame_scan_b",
    f"""WITH {RAW_SQL} SELECT {SCAN_SQL}, {LISTS_SQL}, l_discount * 100 + 100 AS lng FROM raw
    WHERE l_shipdate BETWEEN DATE '1996-01-01' AND DATE '1996-12-31' AND l_linenumber > 2 AND ein <> ''""",
)
def frame_scan_b(spark, sf_dir):
    df = scans.frames_b(_flavour_b(spark, sf_dir), "source_b", "1996-01-01", "1996-12-31")
    return _scan(df, F.col("longitude").cast("double").alias("lng"))


@query(
    "frame_scan_slice",
    f"""WITH {RAW_SQL} SELECT {SCAN_SQL}, {LISTS_SQL} FROM raw
    WHERE sent_at >= TIMESTAMP '1997-05-05 10:00:00' AND sent_at < TIMESTAMP '1997-08-05 12:00:00'""",
)
def frame_scan_slice(spark, sf_dir):
    df = scans.frames_slice(raw_frames(spark, sf_dir), "1997-05-05 10:00:00", "1997-08-05 12:00:00")
    return _scan(scans.in_time_order(df))


@query(
    "frame_scan_stream_table",
    f"""WITH {RAW_SQL} SELECT {SCAN_SQL}, {LISTS_SQL}, NULL::VARCHAR AS longitude FROM raw
    WHERE sent_at >= TIMESTAMP '1999-05-05 10:00:00' AND sent_at < TIMESTAMP '1999-08-05 12:00:00' AND ein <> ''""",
)
def frame_scan_stream_table(spark, sf_dir):
    """A slice of the table without a position."""
    raw = _flavour_b(spark, sf_dir).withColumnsRenamed({"clt_time": "create_time", "clt_date": "create_date"})
    df = scans.frames_slice(raw.drop("lng", "lat"), "1999-05-05 10:00:00", "1999-08-05 12:00:00", "stream")
    return _scan(df.where(F.col("ein") != ""), "longitude")


ACTIVE_SQL = "SELECT s_suppkey::VARCHAR FROM supplier WHERE s_acctbal > 5000"


@query(
    "frame_scan_semi",
    f"""WITH {RAW_SQL} SELECT {SCAN_SQL}, {LISTS_SQL} FROM raw
    WHERE l_shipdate BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' AND ein IN ({ACTIVE_SQL})""",
)
def frame_scan_semi(spark, sf_dir):
    """Only chosen vehicles: a semi join, not a list of literals."""
    chosen = table(spark, sf_dir, "supplier").where("s_acctbal > 5000").select(text("s_suppkey").alias("ein"))
    return _scan(scans.frames_a(raw_frames(spark, sf_dir), "1997-01-01", "1997-12-31", chosen))


@query(
    "preview",
    "SELECT least(50, count(*))::BIGINT AS n, DATE '1997-06-01' AS day FROM lineitem WHERE l_shipdate = DATE '1997-06-01'",
)
def preview(spark, sf_dir):
    few = scans.preview(raw_frames(spark, sf_dir), "uploadDate", "1997-06-01", 50)
    return few.agg(F.count(F.lit(1)).alias("n"), F.lit("1997-06-01").cast("date").alias("day"))


@query(
    "preview_rows",
    f"""WITH {RAW_SQL} SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'A' THEN '0' ELSE '' END || l_suppkey::VARCHAR AS ein, vin,
      strftime(sent_at, '%Y-%m-%d %H:%M:%S') AS clt_time, {LISTS_SQL} FROM raw WHERE l_shipdate = DATE '1997-06-01'
    ORDER BY md5(concat_ws('|', l_orderkey, l_linenumber, vin)), ein, vals LIMIT 50""",
)
def preview_rows(spark, sf_dir):
    """The rows of a preview by a hash of their ids, the same ones in every run."""
    ids = F.md5(F.concat_ws("|", "l_orderkey", "l_linenumber", "deviceID").cast("binary"))
    few = scans.preview(raw_frames(spark, sf_dir), "uploadDate", "1997-06-01", 50, ids, "ein", F.array_join("params.valueM", ","))
    lists = (listtext.join_list(F.col(f"params.{c}")).alias(name) for c, name in (("codeM", "codes"), ("valueM", "vals")))
    clt_time = F.date_format("uploadTime1", clock.WALL_FORMAT).alias("clt_time")
    return few.select("l_orderkey", "l_linenumber", "ein", F.col("deviceID").alias("vin"), clt_time, *lists)


@query(
    "archive_scan",
    f"""WITH {RAW_SQL} SELECT {SCAN_SQL},
      'SAE_Q' || l_returnflag || ',WW_P' || l_linestatus || ',DCW_D,MD1_T,ZZ_X'
        || CASE WHEN s IS NULL THEN '' ELSE ',F17_S' END || CASE WHEN l_linenumber > 5 THEN ',DCW_D' ELSE '' END AS codes
    FROM raw WHERE l_shipdate = DATE '1997-06-03'""",
)
def archive_scan(spark, sf_dir):
    raw = raw_frames(spark, sf_dir).withColumn("CreateDate", F.col("uploadDate"))
    return scans.archive_scan(raw, "1997-06-03").select(*SCAN, "codes")


@query(
    "device_latest",
    f"""WITH {DEVICES_SQL} SELECT hos_id AS ein, hos_mat_id, hos_series, type AS tbox_type FROM newest""",
)
def device_latest(spark, sf_dir):
    return enrich.device_lookup(metadata.device_scan(devices(spark, sf_dir)))


@query(
    "latest_per_key",
    """SELECT o_custkey, o_orderkey, o_orderdate::DATE AS o_orderdate, o_totalprice FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
    WHERE rn = 1""",
)
def latest_per_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"), "o_totalprice"
    )
    return enrich.latest_per_key(orders, "o_custkey", "o_orderdate")


@query(
    "device_enrich_left",
    f"""WITH {DEVICES_SQL}
    SELECT event_id, user_id::VARCHAR AS ein, n.hos_series, n.hos_mat_id
    FROM events e LEFT JOIN newest n ON e.user_id::VARCHAR = n.hos_id""",
)
def device_enrich_left(spark, sf_dir):
    """Salted, as it would be for one engine with most of the rows."""
    ev = table(spark, sf_dir, "events").select("event_id", text("user_id").alias("ein"), F.col("event_id").alias("clt_timestamp"))
    return enrich.enrich_devices(ev, devices(spark, sf_dir), salts=4).drop("clt_timestamp")


@query(
    "device_filter_inner",
    f"""WITH {DEVICES_SQL}
    SELECT event_id, user_id::VARCHAR AS ein, d.hos_mat_id
    FROM events e JOIN devices d ON e.user_id::VARCHAR = d.hos_id
    WHERE d.type = 'F' AND d.hos_series IN ('1', '1系列') AND d.vin IS NOT NULL""",
)
def device_filter_inner(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", text("user_id").alias("ein"))
    return enrich.frames_of_devices(ev, devices(spark, sf_dir), "F", "1")


@query(
    "online_vehicles",
    """WITH c AS (SELECT user_id::VARCHAR AS ein, min(ts::DATE) AS day, count(*) AS cnt FROM events GROUP BY user_id),
    f AS (SELECT s_suppkey::VARCHAR AS ein FROM supplier WHERE s_nationkey < 10)
    SELECT ein, day, cnt, 'D' AS hos_series FROM c JOIN f USING (ein)""",
)
def online_vehicles(spark, sf_dir):
    """Vehicles of one series with data, most active first."""
    ev = table(spark, sf_dir, "events").select(
        F.when(F.col("user_id") % 2 == 0, F.concat(F.lit("0"), text("user_id"))).otherwise(text("user_id")).alias("ein"),
        F.to_date("ts").alias("day"),
    )
    fleet = table(spark, sf_dir, "supplier").select(
        text("s_suppkey").alias("hos_id"),
        F.when(F.col("s_nationkey") < 5, "D系列").when(F.col("s_nationkey") < 10, "D").otherwise("H").alias("hos_series"),
    )
    return profile.top_by(enrich.online_vehicles(ev, fleet, "D", "day"), "cnt", None, "ein")


@query(
    "top_vehicles",
    """SELECT user_id, count(*) AS cnt FROM events GROUP BY user_id ORDER BY cnt DESC, user_id LIMIT 20""",
)
def top_vehicles(spark, sf_dir):
    counts = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("cnt"))
    return profile.top_by(counts, "cnt", 20, "user_id")


@query(
    "config_semi",
    """SELECT p_partkey, p_brand AS target_name FROM part
    WHERE p_brand IN (SELECT p_brand FROM part WHERE p_size = 50 AND p_type = 'ECONOMY')""",
)
def config_semi(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    new = part.select("p_partkey", F.col("p_brand").alias("target_name"))
    old = part.where("p_size = 50 AND p_type = 'ECONOMY'").select(F.col("p_brand").alias("target_name"))
    return maps.keep_targets_of(new, old)


@query(
    "catalog_chain",
    """WITH seen AS (SELECT DISTINCT l_partkey AS pid FROM lineitem)
    SELECT pid, p_name AS description, p_type AS unitname, n_name AS target_name
    FROM seen LEFT JOIN part ON pid = p_partkey LEFT JOIN supplier ON pid = s_suppkey
    LEFT JOIN nation ON s_nationkey = n_nationkey""",
)
def catalog_chain(spark, sf_dir):
    seen = profile.distinct_signals(
        table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("pid"))
    )
    joined = enrich.lookup_chain(
        seen,
        [
            (table(spark, sf_dir, "part"), "pid", "p_partkey", {"p_name": "description", "p_type": "unitname"}),
            (table(spark, sf_dir, "supplier"), "pid", "s_suppkey", {"s_nationkey": "nation"}),
            (table(spark, sf_dir, "nation"), "nation", "n_nationkey", {"n_name": "target_name"}),
        ],
    )
    return joined.drop("nation")


@query(
    "signal_catalogue",
    """WITH seen AS (SELECT DISTINCT user_id AS pid FROM (
        SELECT user_id, ts::DATE AS d, count(*) AS n FROM events GROUP BY ALL HAVING count(*) > 2))
    SELECT pid, p_name AS Description, p_type AS unitname, c_name AS "desc", c_mktsegment AS target_unit,
           NULL::VARCHAR AS app, s_name AS target_name
    FROM seen LEFT JOIN part ON pid = p_partkey LEFT JOIN customer ON pid = c_custkey
    LEFT JOIN supplier ON pid = s_suppkey""",
)
def signal_catalogue(spark, sf_dir):
    sent = table(spark, sf_dir, "events").select(F.to_date("ts").alias("d"), F.array("user_id").alias("codes"))
    census = profile.signal_census(sent, "d", more_than=2)
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("PID"), F.col("p_name").alias("Description"), F.col("p_type").alias("unitname")
    )
    synonyms = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("pid"), F.col("c_name").alias("desc"), F.col("c_mktsegment").alias("target_unit"),
        F.lit(None).cast("string").alias("app"),
    )
    names = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("pid"), F.col("s_name").alias("target_name"))
    return profile.signal_catalogue(census, part, synonyms, names)


@query(
    "first_match_lookup",
    """WITH m AS (SELECT l_partkey, l_orderkey, l_linenumber, l_quantity, row_number() OVER (
        PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_quantity) AS rn FROM lineitem)
    SELECT p_partkey, l_quantity AS first_quantity FROM part LEFT JOIN m ON p_partkey = l_partkey AND rn = 1""",
)
def first_match_lookup(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey")
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"),
        F.struct("l_orderkey", "l_linenumber", "l_quantity").alias("at"),
        F.col("l_quantity").alias("first_quantity"),
    )
    return enrich.first_match(part, lines, "p_partkey", "at", ["first_quantity"])


def frame_messages(spark, sf_dir, *kept):
    """Events as JSON messages of the first flavour: two items each."""
    item = F.struct(
        F.col("event_type").alias("signalname"), F.lit("n").alias("name"), text("value").alias("value")
    )
    other = F.struct(F.lit("ID").alias("signalname"), F.lit("i").alias("name"), text("event_id").alias("value"))
    seconds = clock.stamp_epoch(F.col("ts"))
    message = F.struct(
        F.concat(F.lit("0"), text("user_id")).alias("ein"),
        (seconds * 1000 + 250).alias("uploadTime"),
        F.concat(F.lit("V"), text("user_id")).alias("deviceID"),
        F.lit("121.5").alias("longitude"),
        F.lit("31.2").alias("latitude"),
        F.array(item, other).alias("items"),
    )
    return table(spark, sf_dir, "events").select(F.to_json(message).alias("value"), *kept)


@query(
    "json_items_decode",
    """SELECT user_id::VARCHAR AS ein, 'V' || user_id::VARCHAR AS vin, strftime(ts, '%Y-%m-%d %H:%M:%S') AS clt_time,
           strftime(ts, '%Y-%m-%d') AS clt_date, epoch(date_trunc('second', ts))::BIGINT AS clt_timestamp,
           event_type || ',ID' AS codes, value AS first_value, event_id AS second_value, '121.5' AS longitude
    FROM events""",
)
def json_items_decode(spark, sf_dir):
    df = messages.decode_frames(frame_messages(spark, sf_dir), zone="UTC")
    return df.where(F.col("corrupt").isNull()).select(
        "ein", "vin", "clt_time", "clt_date", "clt_timestamp",
        F.array_join("codes", ",").alias("codes"),
        F.col("vals")[0].cast("double").alias("first_value"),
        F.col("vals")[1].cast("bigint").alias("second_value"),
        "longitude",
    )


def signal_messages(spark, sf_dir):
    """Events as JSON lists of the second flavour: one message of two signals, no altitude."""
    pair = F.struct(F.col("event_type").alias("pid"), text("value").alias("value"))
    other = F.struct(F.lit("ID").alias("pid"), text("event_id").alias("value"))
    seconds = clock.stamp_epoch(F.col("ts"))
    message = F.struct(
        text("user_id").alias("ein"),
        F.concat(F.lit("V"), text("event_id")).alias("vin"),
        (seconds * 1000 + 999).alias("time"),
        F.lit("T1").alias("sn"),
        F.lit("121.5").alias("lng"),
        F.lit("31.2").alias("lat"),
        F.array(pair, other).alias("message"),
    )
    return table(spark, sf_dir, "events").select(F.to_json(F.array(message)).alias("value"))


@query(
    "json_array_explode",
    """WITH e AS (SELECT user_id::VARCHAR AS ein, 'V' || event_id::VARCHAR AS vin,
                         epoch(date_trunc('second', ts))::BIGINT AS clt_timestamp, event_id, event_type, value FROM events)
    SELECT ein, vin, clt_timestamp, 0 AS pos, 'lng' AS pid, 121.5::DOUBLE AS value FROM e
    UNION ALL SELECT ein, vin, clt_timestamp, 1, 'lat', 31.2::DOUBLE FROM e
    UNION ALL SELECT ein, vin, clt_timestamp, 2, 'high', NULL FROM e
    UNION ALL SELECT ein, vin, clt_timestamp, 3, event_type, value FROM e
    UNION ALL SELECT ein, vin, clt_timestamp, 4, 'ID', event_id::DOUBLE FROM e""",
)
def json_array_explode(spark, sf_dir):
    rows = messages.signal_rows(signal_messages(spark, sf_dir))
    return rows.withColumn("value", F.col("value").cast("double"))


@query(
    "json_frames_last",
    """SELECT user_id::VARCHAR AS ein, epoch(date_trunc('second', ts))::BIGINT AS clt_timestamp,
           CASE event_type WHEN 'view' THEN value WHEN 'click' THEN value * 0.001::DOUBLE END AS speed, '31.2' AS lat
    FROM events""",
)
def json_frames_last(spark, sf_dir):
    """A message list fused directly, the last signal sent winning."""
    from suite.fusion import group_mapping
    from telefold.functions.signals import pluck
    from telefold.operators.fusion import fuse_frames

    df = messages.message_frames(signal_messages(spark, sf_dir))
    df = df.withColumns({"codes": pluck(F.col("message"), "pid"), "vals": pluck(F.col("message"), "value")})
    return fuse_frames(df, group_mapping(spark), "last").select("ein", "clt_timestamp", "speed", "lat")


@query(
    "stream_static_join",
    """SELECT event_id AS pos, event_type AS pid,
           CASE event_type WHEN 'click' THEN 'speed' WHEN 'view' THEN 'speed' WHEN 'error' THEN 'pressure'
                WHEN 'signup' THEN 'note' END AS target_name,
           CASE event_type WHEN 'click' THEN 2.0::DOUBLE END AS multiplier,
           CASE event_type WHEN 'click' THEN 1.0::DOUBLE WHEN 'error' THEN 0.5::DOUBLE END AS "offset"
    FROM events""",
)
def stream_static_join(spark, sf_dir):
    from suite.fusion import group_mapping, group_scaling
    from suite.inputs import signal_events
    from telefold.operators.grouped import attach_mapping

    rows = attach_mapping(signal_events(spark, sf_dir), group_mapping(spark), group_scaling(spark))
    return rows.select("pos", "pid", "target_name", "multiplier", "offset")


@query(
    "catalogue_scan",
    """SELECT p_partkey AS PID, p_name AS Description, p_brand AS ECUName, p_type AS name, p_size::VARCHAR AS unitname FROM part""",
)
def catalogue_scan(spark, sf_dir):
    renamed = {"p_partkey": "PID", "p_name": "Description", "p_brand": "ECUName", "p_type": "name"}
    part = table(spark, sf_dir, "part").withColumnsRenamed(renamed)
    return metadata.catalogue_scan(part.withColumn("unitname", text("p_size")))


@query(
    "message_map",
    """SELECT event_id, 2 AS n, event_id::VARCHAR AS id, CASE WHEN event_type = 'click' THEN value END AS click FROM events""",
)
def message_map(spark, sf_dir):
    """A message's signals as a map; an entry without a name is left out."""
    pairs = ((F.col("event_type"), text("value")), (F.lit("ID"), text("event_id")), (F.lit(None).cast("string"), F.lit("x")))
    items = F.array(*(F.struct(pid.alias("pid"), value.alias("value")) for pid, value in pairs))
    named = signals.item_map(items, "pid", "value")
    made = table(spark, sf_dir, "events").select("event_id", named.alias("m"))
    return made.select("event_id", F.size("m").alias("n"), F.col("m")["ID"].alias("id"), F.col("m")["click"].cast("double").alias("click"))


@query(
    "null_key_groups",
    """SELECT CASE WHEN l_linenumber % 3 > 0 THEN l_returnflag END AS flag, l_linestatus, count(*) AS n, sum(l_quantity) AS quantity
    FROM lineitem GROUP BY ALL""",
)
def null_key_groups(spark, sf_dir):
    """A NULL key is a group of its own."""
    lines = table(spark, sf_dir, "lineitem")
    flag = F.when(F.col("l_linenumber") % 3 > 0, F.col("l_returnflag")).alias("flag")
    return lines.groupBy(flag, "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))
