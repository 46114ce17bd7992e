"""Tables as they are stored: by day, in the catalogue, bucketed, with counts kept; and joins with hot or many keys."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from suite.checks import KEYS, _fused
from suite.inputs import DEVICES_SQL, LISTS_SQL, RAW_SQL, devices, frames, mapping, raw_frames, table, text
from suite.registry import SQL, query
from suite.scans import ACTIVE_SQL, SCAN_SQL, _scan
from suite.writing import FUSED, FUSED_SQL, MONTH_SQL, _rows
from telefold.operators import enrich, mapping as maps, profile, quality
from telefold.session import work_path, written
from telefold.sinks import catalogue, tables as sinks
from telefold.sources import frames as scans


def _database(spark):
    """A database of its own under the shared folder."""
    name = f"db_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{work_path(spark, 'database')}'")
    return name


def run_and_count(df: DataFrame) -> dict[str, int]:
    """Runs a query and says what its file scans read: the largest number of ``files`` and of ``partitions``."""
    done = df._jdf.queryExecution()
    done.toRdd().count()
    found, open_nodes = {"files": 0, "partitions": 0}, [done.executedPlan()]
    while open_nodes:
        node = open_nodes.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            open_nodes.append(node.executedPlan())
            continue
        if kind.endswith("QueryStageExec"):
            open_nodes.append(node.plan())
        for name, metric in (("files", "numFiles"), ("partitions", "numPartitions")):
            if kind == "FileSourceScanExec" and node.metrics().contains(metric):
                found[name] = max(found[name], node.metrics().apply(metric).value())
        children = node.children()
        open_nodes += [children.apply(i) for i in range(children.size())]
    return found


def _stored_by_month(spark, sf_dir):
    """Raw frames stored by month, 84 of them; the day is the month's first."""
    path = work_path(spark, "raw")
    raw = raw_frames(spark, sf_dir).withColumn("uploadDate", F.trunc("uploadDate", "month"))
    sinks.store_raw(raw, path, "uploadDate")
    return spark.read.parquet(path)


@query(
    "frame_scan_pruned",
    f"""WITH {RAW_SQL} SELECT ein, vin, strftime(sent_at, '%Y-%m-%d %H:%M:%S') AS clt_time, epoch(sent_at)::BIGINT AS clt_timestamp,
      {MONTH_SQL} AS clt_date, {LISTS_SQL},
      (SELECT count(DISTINCT date_trunc('month', l_shipdate)) FROM lineitem WHERE l_shipdate >= DATE '1997-03-01' AND l_shipdate < DATE '1998-03-01')::INTEGER AS partitions_read
    FROM raw WHERE l_shipdate >= DATE '1997-03-01' AND l_shipdate < DATE '1998-03-01' AND NOT (l_suppkey = 0 AND l_returnflag = '')""",
)
def frame_scan_pruned(spark, sf_dir):
    """A range of days over a table stored by day: only the range's partitions are listed and read."""
    rows = _scan(scans.frames_a(_stored_by_month(spark, sf_dir), "1997-03-01", "1998-02-28"))
    return rows.withColumn("partitions_read", F.lit(run_and_count(rows)["partitions"]))


_DAYS_SQL = "SELECT DISTINCT date_trunc('month', o_orderdate)::DATE FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' AND o_totalprice > 480000"


@query(
    "frame_scan_days_of_table",
    f"""WITH {RAW_SQL} SELECT l_orderkey, l_linenumber, l_partkey, {MONTH_SQL} AS day,
      (SELECT count(DISTINCT date_trunc('month', l_shipdate)) FROM lineitem WHERE date_trunc('month', l_shipdate)::DATE IN ({_DAYS_SQL}))::INTEGER AS partitions_read
    FROM raw WHERE date_trunc('month', l_shipdate)::DATE IN ({_DAYS_SQL})""",
)
def frame_scan_days_of_table(spark, sf_dir):
    """The days come from another table; the partitions are pruned when they are known."""
    orders = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' AND o_totalprice > 480000")
    days = orders.select(F.trunc("o_orderdate", "month").alias("day"))
    found = scans.frames_of_days(_stored_by_month(spark, sf_dir), days)
    rows = found.select("l_orderkey", "l_linenumber", F.substring("deviceID", 2, 20).cast("bigint").alias("l_partkey"), text("uploadDate").alias("day"))
    return rows.withColumn("partitions_read", F.lit(run_and_count(rows)["partitions"]))


@query(
    "frame_scan_key_filter",
    f"""WITH {RAW_SQL} SELECT {SCAN_SQL}, {LISTS_SQL} FROM raw
    WHERE l_shipdate BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' AND ein IN ({ACTIVE_SQL})""",
)
def frame_scan_key_filter(spark, sf_dir):
    """Chosen vehicles as for a set beyond the broadcast limit: a Bloom filter first, then a shuffled join."""
    chosen = table(spark, sf_dir, "supplier").where("s_acctbal > 5000").select(text("s_suppkey").alias("ein"))
    sent = scans.frames_a(raw_frames(spark, sf_dir), "1997-01-01", "1997-12-31")
    return _scan(enrich.only_keys_filtered(sent, chosen.hint("merge")))


@query(
    "device_enrich_hot",
    f"""WITH {DEVICES_SQL}, e AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '1' ELSE user_id::VARCHAR END AS ein FROM events)
    SELECT event_id, ein, n.hos_series, n.hos_mat_id FROM e LEFT JOIN newest n ON e.ein = n.hos_id""",
)
def device_enrich_hot(spark, sf_dir):
    """One engine sends a third of all rows. A sketch finds it; only its rows are spread over tasks."""
    ein = F.when(F.col("event_id") % 3 == 0, F.lit("1")).otherwise(text("user_id"))
    ev = table(spark, sf_dir, "events").select("event_id", ein.alias("ein"))
    lookup = written(enrich.device_lookup(devices(spark, sf_dir)).select("ein", "hos_series", "hos_mat_id"), "devices")
    return enrich.spread_lookup_join(ev, lookup.hint("merge"), "ein", ["event_id"])


@query(
    "census_late_day",
    f"""WITH {RAW_SQL}, sent AS (
      SELECT {MONTH_SQL} AS clt_date, unnest(['SAE_Q' || l_returnflag, 'WW_P' || l_linestatus, 'DCW_D', 'MD1_T', 'ZZ_X']) AS pid FROM raw
      UNION ALL SELECT {MONTH_SQL}, 'F17_S' FROM raw WHERE s IS NOT NULL
      UNION ALL SELECT {MONTH_SQL}, 'DCW_D' FROM raw WHERE l_linenumber > 5)
    SELECT clt_date, pid, count(*) AS ct FROM sent WHERE clt_date BETWEEN '1993-01-01' AND '1997-12-01' GROUP BY ALL HAVING count(*) > 12""",
)
def census_late_day(spark, sf_dir):
    """Counts kept by day. A third of one month's frames comes late and another month was stored twice over by mistake:
    both are counted again, the other months aren't."""
    path = work_path(spark, "census")
    sent = frames(spark, sf_dir).withColumn("clt_date", F.concat(F.substring("clt_date", 1, 8), F.lit("01")))
    late = (F.col("clt_date") == "1995-03-01") & (F.col("l_orderkey") % 3 == 0)
    twice = F.when(F.col("clt_date") == "1996-05-01", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    profile.store_census(sent.where(~late).withColumn("again", F.explode(twice)), path, "1992-01-01", "1999-01-01")
    profile.store_census(sent, path, "1995-03-01", "1995-03-01")
    profile.store_census(sent, path, "1996-05-01", "1996-05-01")
    return profile.stored_census(spark, path, "1993-01-01", "1997-12-01", more_than=12)


def _described(spark):
    return mapping(spark).withColumn("target_desc", F.concat(F.lit("the "), "target_name"))


def _catalogue_table(spark, sf_dir):
    """The fused table as its DDL makes it, with rows of all months; ratios are off by one."""
    name = f"{_database(spark)}.fused"
    catalogue.make_fused_table(spark, _described(spark), name, "id")
    fused = maps.to_fused_table(_rows(spark, sf_dir), maps.fused_schema(_described(spark)))
    catalogue.append_rows(fused.withColumn("ratio", F.col("ratio") + 1), name)
    return name, fused


@query(
    "catalogue_reload",
    f"""WITH {RAW_SQL} SELECT vin, epoch(sent_at)::BIGINT AS clt_timestamp,
      {FUSED_SQL.replace('d AS ratio', "CASE WHEN year(l_shipdate) IN (1996, 1997) THEN d ELSE d + 1 END AS ratio")},
      CASE WHEN s IS NULL THEN 'source_b' ELSE 'source_a' END AS data_source, 'gc' AS data_type, {MONTH_SQL} AS clt_date, '0' AS is_delete
    FROM raw WHERE year(l_shipdate) <> 1995 AND NOT (year(l_shipdate) = 1997 AND s IS NULL AND month(l_shipdate) > 6)""",
)
def catalogue_reload(spark, sf_dir):
    """The fused table in the catalogue: appended to, two years reloaded twice (some days of one source have no rows any
    more), one year's partitions dropped."""
    name, fused = _catalogue_table(spark, sf_dir)
    gone = (F.col("data_source") == "source_b") & (F.col("clt_date") >= "1997-07-01")
    for _ in range(2):
        catalogue.reload_days(fused.where(~gone), name, "1996-01-01", "1997-12-31")
    catalogue.drop_partitions(spark, name, F.col("clt_date").startswith("1995"))
    return spark.table(name).select(*FUSED, *sinks.LAYOUT, "is_delete")


_COLUMNS = [(n, k.lower(), None, n in sinks.LAYOUT) for n, k in maps.KEY_COLUMNS]
_TARGETS = [("distance", "m"), ("pressure", "hPa"), ("ratio", "rate"), ("flow", "mg/s"), ("mix", "%"), ("state", None)]
_COLUMNS += [(n, "string" if u is None else "double", f"the {n}, unit: {u}", False) for n, u in _TARGETS]
_VALUES = ", ".join(f"('{n}', '{k}', {'NULL' if c is None else repr(c)}, {p})" for n, k, c, p in _COLUMNS)


@query(
    "catalogue_definition",
    f"""SELECT *, (SELECT count(*) FROM lineitem) AS rows_before, 0::BIGINT AS rows_emptied,
      (SELECT count(*) FROM lineitem WHERE year(l_shipdate) = 1996) AS rows_after
    FROM (VALUES {_VALUES}) AS t(name, kind, comment, is_partition)""",
)
def catalogue_definition(spark, sf_dir):
    """Types, comments and partitions as the catalogue has them after the table was emptied and filled again."""
    name, fused = _catalogue_table(spark, sf_dir)
    counts = [spark.table(name).count()]
    catalogue.empty_table(spark, name)
    counts.append(spark.table(name).count())
    catalogue.append_rows(fused.where("clt_date LIKE '1996%'"), name)
    counts.append(spark.table(name).count())
    names = ("rows_before", "rows_emptied", "rows_after")
    return catalogue.definition(spark, name).withColumns({n: F.lit(c).cast("bigint") for n, c in zip(names, counts)})


@query("value_reconcile_bucketed", SQL["value_reconcile"].replace("count(*) AS checked", "0 AS shuffles, count(*) AS checked"))
def value_reconcile_bucketed(spark, sf_dir):
    """The full reconciliation of raw and fused frames that are stored bucketed by their keys: none is shuffled."""
    raw, targets, fused = _fused(spark, sf_dir)
    spoilt = fused.withColumn("distance", F.when(F.col("ein") == "7", F.col("distance") * 1.5).otherwise(F.col("distance")))
    database, buckets = _database(spark), int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name, rows in (("raw", raw.select(*KEYS, "codes", "vals")), ("fused", spoilt)):
        catalogue.save_bucketed(rows, f"{database}.{name}", KEYS, buckets)
    checks = quality.value_checks(spark.table(f"{database}.raw").hint("merge"), spark.table(f"{database}.fused"), targets, KEYS)
    shuffles = checks._jdf.queryExecution().executedPlan().toString().count("Exchange")
    return quality.value_summary(checks).withColumn("shuffles", F.lit(shuffles))
