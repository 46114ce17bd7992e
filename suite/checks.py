"""Profiling and reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.inputs import RAW_SQL, frames, mapping, raw_frames, table
from suite.registry import query
from telefold.operators import enrich, fusion, mapping as maps, profile, quality
from telefold.session import written

BOX_SQL = """
  q AS (SELECT {by}, count(*) AS n, min({v}) AS "min", quantile_cont({v}, 0.25) AS p25, quantile_cont({v}, 0.5) AS median,
               quantile_cont({v}, 0.75) AS p75, max({v}) AS "max" FROM {t} GROUP BY {by})
  SELECT {by}, n, "min", round(p25, 6) AS p25, round(median, 6) AS median, round(p75, 6) AS p75, "max",
         min({v}) FILTER (WHERE {v} BETWEEN p25 - 1.5::DOUBLE * (p75 - p25) AND p75 + 1.5::DOUBLE * (p75 - p25)) AS whisker_low,
         max({v}) FILTER (WHERE {v} BETWEEN p25 - 1.5::DOUBLE * (p75 - p25) AND p75 + 1.5::DOUBLE * (p75 - p25)) AS whisker_high,
         count(*) FILTER (WHERE NOT {v} BETWEEN p25 - 1.5::DOUBLE * (p75 - p25) AND p75 + 1.5::DOUBLE * (p75 - p25)) AS outliers
  FROM {t} JOIN q USING ({by}) GROUP BY {by}, n, "min", p25, median, p75, "max"
"""


def _rounded(df):
    return df.withColumns({c: F.round(c, 6) for c in ("p25", "median", "p75")})


@query("box_summary", "WITH " + BOX_SQL.format(by="event_type", v="value", t="events"))
def box_summary(spark, sf_dir):
    return _rounded(profile.box_summary(table(spark, sf_dir, "events"), ["event_type"], "value"))


@query("box_summary_price", "WITH " + BOX_SQL.format(by="l_returnflag", v="l_extendedprice", t="lineitem"))
def box_summary_price(spark, sf_dir):
    """Many distinct values in three groups: the case one task could not sort."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice")
    return _rounded(profile.box_summary(lines, ["l_returnflag"], "l_extendedprice"))


CENSUS_SQL = f"""WITH {RAW_SQL}, c AS (
      SELECT l_shipdate, 'SAE_Q' || l_returnflag AS pid FROM raw UNION ALL SELECT l_shipdate, 'WW_P' || l_linestatus FROM raw
      UNION ALL SELECT l_shipdate, 'F17_S' FROM raw WHERE s IS NOT NULL
      UNION ALL SELECT l_shipdate, 'DCW_D' FROM raw UNION ALL SELECT l_shipdate, 'DCW_D' FROM raw WHERE l_linenumber > 5),
    n AS (SELECT strftime(l_shipdate, '%Y-%m-%d') AS clt_date, pid, count(*) AS ct FROM c
          WHERE pid LIKE 'SAE%' OR pid LIKE 'DCW%' OR pid LIKE 'F17%' GROUP BY ALL HAVING count(*) > 12)"""


def _census(spark, sf_dir):
    return profile.signal_census(
        frames(spark, sf_dir), "clt_date", prefixes=("SAE", "DCW", "F17"), more_than=12
    )


@query("signal_census", f"{CENSUS_SQL} SELECT clt_date, pid, ct FROM n")
def signal_census(spark, sf_dir):
    return _census(spark, sf_dir)


@query("signal_distinct", f"{CENSUS_SQL} SELECT DISTINCT pid FROM n")
def signal_distinct(spark, sf_dir):
    return profile.distinct_signals(_census(spark, sf_dir))


@query(
    "frames_per_vehicle",
    f"""WITH {RAW_SQL} SELECT ein, min(l_shipdate::DATE) AS day, count(*) AS cnt FROM raw WHERE ein <> '' GROUP BY ein""",
)
def frames_per_vehicle(spark, sf_dir):
    raw = raw_frames(spark, sf_dir).select("ein", F.col("uploadDate").alias("day"))
    return enrich.frames_per_vehicle(raw, "day")


@query(
    "volume_estimate",
    f"""WITH {RAW_SQL} SELECT count(*)::BIGINT AS frames, round(count(*) / 10000.0::DOUBLE * 21.38::DOUBLE / 1024.0::DOUBLE, 9) AS gb
    FROM raw WHERE ein <> ''""",
)
def volume_estimate(spark, sf_dir):
    counts = enrich.frames_per_vehicle(raw_frames(spark, sf_dir))
    return profile.volume_estimate(counts).withColumn("gb", F.round("gb", 9))


@query(
    "sample_n",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
    ORDER BY md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey)), l_quantity LIMIT 50""",
)
def sample_n(spark, sf_dir):
    """Fifty rows by a hash of their ids."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return profile.sample_rows(lines, 50, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], ties=["l_quantity"])


def _fused(spark, sf_dir):
    compiled = maps.compile_mapping(mapping(spark), "id")
    df = frames(spark, sf_dir).withColumn("l_partkey", F.substr("vin", F.lit(2)).cast("bigint"))
    return df, maps.read_targets(compiled), fusion.fuse_frames(df, compiled)


@query(
    "count_reconcile",
    f"""WITH {RAW_SQL}, a AS (SELECT strftime(l_shipdate, '%Y-%m-01') AS day, count(*) AS r FROM raw GROUP BY 1),
    b AS (SELECT strftime(l_shipdate, '%Y-%m-01') AS day, count(*) AS f FROM raw WHERE t IS NOT NULL GROUP BY 1)
    SELECT coalesce(a.day, b.day) AS day, coalesce(r, 0)::BIGINT AS raw_rows, coalesce(f, 0)::BIGINT AS fused_rows,
           abs(coalesce(r, 0) - coalesce(f, 0)) < 50 AS ok FROM a FULL JOIN b ON a.day = b.day""",
)
def count_reconcile(spark, sf_dir):
    raw, _, fused = _fused(spark, sf_dir)
    month = F.concat(F.substring("clt_date", 1, 8), F.lit("01"))
    return quality.reconcile_counts(
        raw.withColumn("m", month), fused.where(F.col("flow").isNotNull()).withColumn("m", month), "m", "m", 50
    )


KEYS = ["l_orderkey", "l_linenumber", "l_partkey"]


@query(
    "value_reconcile",
    f"""WITH {RAW_SQL}, f AS (
      SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, qa, qn, pf, po, d, t, l_returnflag,
             CASE WHEN l_suppkey = 7 THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END AS off FROM raw),
    j AS (SELECT r.*, g.qa AS gqa, g.qn AS gqn, g.pf AS gpf, g.po AS gpo, g.d AS gd, g.t AS gt, g.off,
                 CASE WHEN g.qa IS NOT NULL THEN g.qa * 1000 * g.off ELSE g.qn * g.off END AS fd
          FROM f r JOIN f g USING (l_orderkey, l_linenumber, l_partkey)),
    v AS (
      SELECT 'distance' AS target_name, 'SAE_QA' AS signal_name, qa * 1000 AS want, fd AS got FROM j WHERE qa IS NOT NULL
      UNION ALL SELECT 'distance', 'SAE_QN', qn, fd FROM j WHERE qn IS NOT NULL
      UNION ALL SELECT 'pressure', 'WW_PF', pf * 10, coalesce(gpf * 10, gpo * 10000) FROM j WHERE pf IS NOT NULL
      UNION ALL SELECT 'pressure', 'WW_PO', po * 10000, coalesce(gpf * 10, gpo * 10000) FROM j WHERE po IS NOT NULL
      UNION ALL SELECT 'ratio', 'DCW_D', d, gd FROM j
      UNION ALL SELECT 'mix', 'DCW_D', d, gd FROM j
      UNION ALL SELECT 'flow', 'MD1_T', t * {1000 / 60!r}::DOUBLE, gt * {1000 / 60!r}::DOUBLE FROM j),
    c AS (SELECT target_name, signal_name, CASE WHEN want IS NULL OR got IS NULL THEN want IS NULL AND got IS NULL
                 ELSE abs(got - want) <= abs(want) * 1e-6 END AS ok FROM v)
    SELECT target_name, signal_name, count(*) AS checked, count(*) FILTER (WHERE ok IS NOT TRUE) AS failed FROM c GROUP BY ALL""",
)
def value_reconcile(spark, sf_dir):
    """Every fused value against its signal; one engine's distances are spoilt on purpose."""
    raw, targets, fused = _fused(spark, sf_dir)
    engine = F.col("ein") == "7"
    spoilt = fused.withColumn("distance", F.when(engine, F.col("distance") * 1.5).otherwise(F.col("distance")))
    return quality.value_summary(quality.value_checks(raw, spoilt, targets, KEYS))


_WORKING_SQL = f"""WITH {RAW_SQL}, picked AS (
      SELECT *, CASE WHEN qa IS NOT NULL THEN qa * 1000 ELSE qn END AS distance FROM raw
      WHERE coalesce(qa * 1000, qn) > 1000 AND hour(sent_at) * 3600 + minute(sent_at) * 60 + second(sent_at) BETWEEN 28800 AND 61200
      ORDER BY md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey)), l_orderkey, l_linenumber, l_partkey, vin, distance, pf, po, d LIMIT 50)"""


def _picked(spark, sf_dir):
    """The rows a spot check reads: running engines in working hours."""
    raw, targets, fused = _fused(spark, sf_dir)
    working = quality.working_rows(fused, "distance")
    return raw, targets, profile.sample_rows(working, quality.SAMPLE_ROWS, KEYS, ties=["vin", "distance", "pressure", "ratio"])


@query("value_sample", f"{_WORKING_SQL} SELECT l_orderkey, l_linenumber, l_partkey, vin, distance FROM picked")
def value_sample(spark, sf_dir):
    return _picked(spark, sf_dir)[2].select(*KEYS, "vin", "distance")


@query(
    "value_check_sample",
    f"""{_WORKING_SQL},
    sent AS (SELECT l_orderkey, l_linenumber, l_partkey, count(*) AS n FROM raw GROUP BY ALL),
    v AS (SELECT l_orderkey, l_linenumber, l_partkey, n FROM picked JOIN sent USING (l_orderkey, l_linenumber, l_partkey))
    SELECT target_name, sum(n)::BIGINT AS checked, 0::BIGINT AS failed
    FROM v, (SELECT unnest(['distance', 'pressure', 'ratio', 'flow', 'mix']) AS target_name) GROUP BY target_name""",
)
def value_check_sample(spark, sf_dir):
    """Working rows, a sample of them, their raw frames, every value checked: only the sample's frames are joined."""
    raw, targets, picked = _picked(spark, sf_dir)
    names = [t.name for t in targets if not t.is_text]
    sample = written(picked.select(*KEYS, *names), "sample")
    checks = quality.value_summary(quality.value_checks(raw, sample, targets, KEYS))
    return checks.groupBy("target_name").agg(F.sum("checked").alias("checked"), F.sum("failed").alias("failed"))


@query(
    "max_compare",
    f"""WITH {RAW_SQL} SELECT strftime(l_shipdate, '%Y') AS year, max(qa) AS raw_max, max(coalesce(qa * 1000, qn)) AS fused_max
    FROM raw GROUP BY 1""",
)
def max_compare(spark, sf_dir):
    from telefold.functions.signals import value_at

    raw, _, fused = _fused(spark, sf_dir)
    year = F.substring("clt_date", 1, 4)
    sent = value_at(F.col("codes"), F.col("vals"), "SAE_QA").cast("double")
    return quality.compare_max(
        raw.withColumn("year", year), fused.withColumn("year", year), "year", sent, F.col("distance")
    )
