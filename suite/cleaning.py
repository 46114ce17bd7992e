"""Column helpers: ids, numbers, list texts, times, units."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.inputs import RAW_SQL, frames, table, text
from suite.registry import query
from telefold.functions import clean, clock, listtext, signals
from telefold.operators import units
from telefold.plans.backfill import with_slice


@query(
    "normalize_ids",
    """WITH t AS (
      SELECT o_orderkey, lpad(o_custkey::VARCHAR, 6, '0') AS raw, o_orderpriority,
             CASE WHEN o_orderstatus = 'F' THEN o_orderpriority || '系列' ELSE o_orderpriority END AS series
      FROM orders)
    SELECT o_orderkey, CASE WHEN raw LIKE '0%' THEN substr(raw, 2) ELSE raw END AS ein,
           regexp_replace(series, '系列$', '') AS series,
           replace(replace(lower(o_orderpriority), ' ', '_'), '-', '_') AS name,
           'source_a' AS data_source FROM t""",
)
def normalize_ids(spark, sf_dir):
    series = F.when(F.col("o_orderstatus") == "F", F.concat("o_orderpriority", F.lit("系列"))).otherwise(
        F.col("o_orderpriority")
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        clean.strip_one_zero(F.lpad(text("o_custkey"), 6, "0")).alias("ein"),
        clean.series_base(series).alias("series"),
        clean.snake_name(F.col("o_orderpriority")).alias("name"),
        F.lit("source_a").alias("data_source"),
    )


@query(
    "epoch_convert",
    """WITH t AS (SELECT event_id, ts, epoch_us(ts) // 1000 AS ms, epoch(date_trunc('second', ts))::BIGINT AS s FROM events)
    SELECT event_id, ms::BIGINT AS ms, s AS seconds,
           strftime(to_timestamp(s) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS utc_text,
           strftime(to_timestamp(s + 28800) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS shanghai_text,
           strftime(to_timestamp(s + 28800) AT TIME ZONE 'UTC', '%Y-%m-%d') AS shanghai_day,
           s - 28800 AS read_as_shanghai, s * 1000 AS stamp_ms
    FROM t""",
)
def epoch_convert(spark, sf_dir):
    wall = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    ms = clock.text_epoch(wall, zone="UTC") * 1000 + F.floor(F.expr("extract(SECOND FROM ts)") * 1000) % 1000
    s = clock.millis_to_seconds(F.col("ms"))
    return table(spark, sf_dir, "events").select("event_id", wall.alias("wall"), ms.cast("bigint").alias("ms")).select(
        "event_id",
        "ms",
        s.alias("seconds"),
        clock.epoch_text(s, zone="UTC").alias("utc_text"),
        clock.epoch_text(s, zone="Asia/Shanghai").alias("shanghai_text"),
        clock.epoch_day(s, "Asia/Shanghai").cast("string").alias("shanghai_day"),
        clock.text_epoch(F.col("wall"), zone="Asia/Shanghai").alias("read_as_shanghai"),
        F.unix_millis(clock.epoch_stamp(s)).alias("stamp_ms"),
    )


CODES_SQL = """CASE WHEN l_returnflag = 'A' THEN ['SAE_QA', 'WW_P' || l_linestatus, 'F17_S']
     ELSE ['SAE_Q' || l_returnflag, 'WW_P' || l_linestatus] END"""


def _code_lists(spark, sf_dir):
    two = F.array(F.concat(F.lit("SAE_Q"), "l_returnflag"), F.concat(F.lit("WW_P"), "l_linestatus"))
    codes = F.when(F.col("l_returnflag") == "A", F.concat(two, F.array(F.lit("F17_S")))).otherwise(two)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey", codes.alias("codes"))


@query(
    "array_text_roundtrip",
    f"""WITH t AS (SELECT l_orderkey, l_linenumber, {CODES_SQL} AS c, l_partkey FROM lineitem)
    SELECT l_orderkey, l_linenumber, array_to_string(c, ',') AS plain,
           '[''' || array_to_string(c, ''',''') || ''']' AS quoted,
           len(c)::INTEGER AS n_split, len(c)::INTEGER AS n_quoted, len(c)::INTEGER AS n_words, c[2] AS second,
           c[len(c)] AS last_literal, 0 AS n_unreadable,
           CAST(l_partkey + 1 AS BIGINT) AS total
    FROM t""",
)
def array_text_roundtrip(spark, sf_dir):
    df = _code_lists(spark, sf_dir).withColumn("plain", listtext.join_list(F.col("codes"))).withColumn(
        "quoted", listtext.quote_list(F.col("codes"))
    )
    numbers = F.concat(F.lit("[val"), text("l_partkey"), F.lit(", 1.0 ]"))
    added = F.aggregate(
        F.transform(listtext.bracket_items(numbers), clean.number), F.lit(0.0), lambda a, x: a + x
    )
    return df.select(
        "l_orderkey",
        "l_linenumber",
        "plain",
        "quoted",
        F.size(listtext.split_list(F.col("plain"))).alias("n_split"),
        F.size(listtext.quoted_items(F.col("quoted"))).alias("n_quoted"),
        F.size(listtext.word_items(F.col("quoted"))).alias("n_words"),
        F.element_at(listtext.quoted_items(F.col("quoted")), 2).alias("second"),
        F.element_at(listtext.literal_items(F.col("quoted")), -1).alias("last_literal"),
        F.size(listtext.literal_items(F.concat(F.lit("{"), "plain"))).alias("n_unreadable"),
        added.cast("bigint").alias("total"),
    )


@query(
    "safe_numbers",
    """WITH t AS (SELECT event_id, value, CASE event_type WHEN 'error' THEN 'err' WHEN 'view' THEN ' '
                         WHEN 'signup' THEN '1F' END AS odd FROM events),
    v AS (SELECT event_id, CASE WHEN odd IS NULL THEN value END AS v, odd FROM t)
    SELECT event_id, coalesce(v, -999.0::DOUBLE) AS with_default, v AS or_null,
           v::DECIMAL(20,7)::VARCHAR AS fixed, v BETWEEN 1 AND 20 AND v IS NOT NULL AS inside,
           CASE WHEN v BETWEEN 1 AND 20 THEN v ELSE -1.0::DOUBLE END AS ranged,
           coalesce(v, 0.0::DOUBLE) * 2.0::DOUBLE + 1.0::DOUBLE AS scaled, round(v, 1) AS rounded
    FROM v""",
)
def safe_numbers(spark, sf_dir):
    kind = F.col("event_type")
    odd = F.when(kind == "error", "err").when(kind == "view", " ").when(kind == "signup", "1F").otherwise(text("value"))
    v = clean.number_or_blank(F.col("t"))
    return table(spark, sf_dir, "events").select("event_id", odd.alias("t")).select(
        "event_id",
        clean.number_or(F.col("t")).alias("with_default"),
        v.alias("or_null"),
        clean.fixed_decimal(v).cast("string").alias("fixed"),
        clean.within(v, F.lit(1.0), F.lit(20.0)).alias("inside"),
        clean.ranged(v, F.lit(1.0), F.lit(20.0), F.lit(-1.0)).alias("ranged"),
        clean.scaled(clean.null_default(v, 0.0), F.lit(2.0), F.lit(1.0)).alias("scaled"),
        F.round(v, 1).alias("rounded"),
    )


@query(
    "positional_lookup",
    f"""WITH {RAW_SQL}
    SELECT l_orderkey, l_linenumber, qa::VARCHAR IS NOT NULL AS has_qa, qa AS qa,
           l_discount AS first_d, CASE WHEN l_linenumber <> 7 THEN NULL END::VARCHAR AS missing
    FROM raw""",
)
def positional_lookup(spark, sf_dir):
    """First position of a code, the way the raw tables are queried by hand."""
    df = frames(spark, sf_dir)
    qa = signals.value_at(F.col("codes"), F.col("vals"), "SAE_QA")
    return df.select(
        "l_orderkey",
        "l_linenumber",
        qa.isNotNull().alias("has_qa"),
        qa.cast("double").alias("qa"),
        signals.value_at(F.col("codes"), F.col("vals"), "DCW_D").cast("double").alias("first_d"),
        signals.value_at(F.col("codes"), F.col("vals"), "NOT_SENT").alias("missing"),
    )


@query(
    "signal_maps",
    f"""WITH {RAW_SQL}
    SELECT l_orderkey, l_linenumber, CAST(5 + (s IS NOT NULL)::INTEGER AS INTEGER) AS sent,
           CAST(2 + (s IS NOT NULL)::INTEGER AS INTEGER) AS known, d AS d, s AS state
    FROM raw""",
)
def signal_maps(spark, sf_dir):
    from telefold.session import keep_last_key

    keep_last_key(spark)
    m = signals.signal_map(F.col("codes"), F.col("vals"))
    df = frames(spark, sf_dir).select("l_orderkey", "l_linenumber", m.alias("m"))
    return df.select(
        "l_orderkey",
        "l_linenumber",
        F.size("m").alias("sent"),
        F.size(signals.only_known(F.col("m"), ["DCW_D", "MD1_T", "F17_S"])).alias("known"),
        signals.sent_number(F.col("m")["DCW_D"]).alias("d"),
        signals.sent_text(F.col("m")["F17_S"]).alias("state"),
    )


# Units tried against each other, known and unknown.
UNITS = [
    "km", "m", "cm", "mV", "V", "s", "min", "h", "kg/h", "m³/h", "m3/h", "m^3/h", "hPa", "KPA", "MPa",
    "g/min", "mg/s", "mg/hub", "mg/cyl", "mm3/st", "degC", "CA", "foo",
]
_LIST = ", ".join(f"'{u}'" for u in UNITS)
_PAIRS = f"""
  u AS (SELECT l_orderkey, l_linenumber, l_quantity, l_suppkey,
               list_extract([{_LIST}], (l_partkey % {len(UNITS)} + 1)::INTEGER) AS a,
               list_extract([{_LIST}], (l_orderkey % {len(UNITS)} + 1)::INTEGER) AS b FROM lineitem),
  scale(unit, family, size) AS (VALUES ('km','l',1e3),('m','l',1e0),('cm','l',1e-2),('mv','v',1e-3),('v','v',1e0),
    ('s','t',1e0),('min','t',6e1),('h','t',3.6e3),('hpa','p',1e0),('kpa','p',1e1),('mpa','p',1e4),
    ('g/min','m',1e3),('mg/s','m',6e1),('mg/hub','x',1e0),('mg/cyl','x',1e0),('degc','a',1e0),('ca','a',1e0),
    ('kg/h','f',0.85566),('m3/h','f',1e0),('m³/h','f',1e0),('m3/h','g',1e0),('m^3/h','g',1e0))
"""


def _unit_rows(spark, sf_dir, legacy):
    names = F.array(*[F.lit(u) for u in UNITS])

    def pick(c):
        return F.element_at(names, (F.col(c) % len(UNITS) + 1).cast("int"))

    df = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", pick("l_partkey").alias("a"), pick("l_orderkey").alias("b")
    )
    factor = units.attach_factor(df, "a", "b", legacy)
    value = F.round(F.col("l_quantity") * F.coalesce("factor", F.lit(1.0)), 4)
    return factor.select(
        "l_orderkey", "l_linenumber", "a", "b", F.round("factor", 8).alias("factor"), value.alias("value")
    )


@query(
    "unit_apply",
    f"""WITH {_PAIRS}, f AS (
      SELECT u.*, CASE WHEN lower(a) = lower(b) THEN 1.0::DOUBLE
                       WHEN lower(b) IN ('cm', 'mv') THEN NULL ELSE (
                SELECT max(x.size::DOUBLE / y.size::DOUBLE) FROM scale x JOIN scale y ON x.family = y.family
                WHERE x.unit = lower(a) AND y.unit = lower(b)) END AS f FROM u)
    SELECT l_orderkey, l_linenumber, a, b, round(f, 8) AS factor,
           round(l_quantity * coalesce(f, 1.0::DOUBLE), 4) AS value FROM f""",
)
def unit_apply(spark, sf_dir):
    return _unit_rows(spark, sf_dir, legacy=False)


@query(
    "unit_apply_legacy",
    f"""WITH {_PAIRS}, f AS (
      SELECT u.*, CASE WHEN lower(a) = lower(b) THEN 1.0::DOUBLE
                       WHEN lower(b) IN ('cm', 'mv') THEN NULL
                       WHEN lower(b) = 'm3/h' AND lower(a) IN ('kg/h', 'm³/h') THEN NULL
                       WHEN a = 'cm' AND b = 'km' THEN 1e-6::DOUBLE WHEN a = 'cm' AND b = 'm' THEN 1e-3::DOUBLE
                       WHEN a = 'g/min' AND b = 'mg/s' THEN 16.67::DOUBLE ELSE (
                SELECT max(x.size::DOUBLE / y.size::DOUBLE) FROM scale x JOIN scale y ON x.family = y.family
                WHERE x.unit = lower(a) AND y.unit = lower(b)) END AS f FROM u)
    SELECT l_orderkey, l_linenumber, a, b, round(f, 8) AS factor,
           round(l_quantity * coalesce(f, 1.0::DOUBLE), 4) AS value FROM f""",
)
def unit_apply_legacy(spark, sf_dir):
    return _unit_rows(spark, sf_dir, legacy=True)


@query(
    "date_series",
    """WITH s AS (SELECT user_id, min(ts)::DATE AS a, max(ts)::DATE AS b FROM events GROUP BY user_id),
    d AS (SELECT user_id, unnest(generate_series(a, b, INTERVAL 1 DAY))::DATE AS day FROM s),
    c AS (SELECT user_id, ts::DATE AS day, count(*) AS n FROM events GROUP BY ALL)
    SELECT d.user_id, d.day, coalesce(n, 0)::BIGINT AS events FROM d LEFT JOIN c USING (user_id, day)""",
)
def date_series(spark, sf_dir):
    """Every day of an engine's span, with its row count, empty days included."""
    ev = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"))
    spans = ev.groupBy("user_id").agg(F.min("day").alias("a"), F.max("day").alias("b"))
    days = spans.select("user_id", F.explode(clock.days_between(F.col("a"), F.col("b"))).alias("day"))
    counts = ev.groupBy("user_id", "day").agg(F.count(F.lit(1)).alias("events"))
    return days.join(counts, ["user_id", "day"], "left").na.fill(0, ["events"])


@query(
    "time_slices",
    """WITH s AS (SELECT user_id, date_trunc('second', min(ts)) AS a, date_trunc('second', max(ts)) AS b
                  FROM events GROUP BY user_id),
    p AS (SELECT user_id, unnest(generate_series(a, b, INTERVAL 3500 SECOND)) AS x FROM s
          UNION SELECT user_id, unnest(generate_series(date_trunc('day', a) + INTERVAL 1 DAY, b, INTERVAL 1 DAY)) FROM s
          UNION SELECT user_id, b FROM s),
    l AS (SELECT user_id, x, lead(x) OVER (PARTITION BY user_id ORDER BY x) AS y FROM p)
    SELECT user_id, strftime(x, '%Y-%m-%d %H:%M:%S') AS slice_start, strftime(y, '%Y-%m-%d %H:%M:%S') AS slice_end
    FROM l WHERE y IS NOT NULL""",
)
def time_slices(spark, sf_dir):
    """The slices of every engine's span: 3500 s steps, cut at midnight."""
    second = F.date_trunc("SECOND", "ts").cast("timestamp_ntz")
    spans = table(spark, sf_dir, "events").groupBy("user_id").agg(F.min(second).alias("a"), F.max(second).alias("b"))
    cut = clock.slices(spans, "a", "b", 3500)
    return cut.select(
        "user_id",
        F.date_format("slice_start", clock.WALL_FORMAT).alias("slice_start"),
        F.date_format("slice_end", clock.WALL_FORMAT).alias("slice_end"),
    )


@query(
    "slice_counts",
    """WITH t AS (SELECT ts, greatest(TIMESTAMP '2023-12-31 23:50:00' + to_seconds(
             floor(epoch(ts - TIMESTAMP '2023-12-31 23:50:00') / 3600)::BIGINT * 3600), date_trunc('day', ts)) AS s, value
      FROM events)
    SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS slice_start, count(*) AS n, round(sum(value::DECIMAL(20,4))::DOUBLE, 4) AS total
    FROM t GROUP BY ALL""",
)
def slice_counts(spark, sf_dir):
    """All slices in one job: each row names its slice, nothing loops."""
    ev = with_slice(table(spark, sf_dir, "events"), "ts", "2023-12-31 23:50:00", 7200)
    return ev.groupBy(F.date_format("slice_start", clock.WALL_FORMAT).alias("slice_start")).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum(F.col("value").cast("decimal(20,4)")).cast("double"), 4).alias("total"),
    )


@query(
    "prefix_filter",
    """SELECT p_name, count(*) AS n FROM part WHERE p_name LIKE 're%' OR p_name LIKE 'sm%' OR p_name LIKE 'ho%'
    GROUP BY p_name""",
)
def prefix_filter(spark, sf_dir):
    part = table(spark, sf_dir, "part").where(clean.starts_with_any(F.col("p_name"), ["re", "sm", "ho"]))
    return part.groupBy("p_name").agg(F.count(F.lit(1)).alias("n"))


@query(
    "clean_units",
    """SELECT p_partkey, CASE WHEN p_size % 4 IN (0, 1) THEN NULL WHEN p_size % 4 = 2 THEN NULL ELSE p_type END AS unit
    FROM part""",
)
def clean_units(spark, sf_dir):
    raw = (
        F.when(F.col("p_size") % 4 == 0, F.lit("-"))
        .when(F.col("p_size") % 4 == 1, F.lit("  "))
        .when(F.col("p_size") % 4 == 3, F.concat(F.lit(" "), "p_type"))
    )
    return table(spark, sf_dir, "part").select("p_partkey", clean.clean_unit(raw).alias("unit"))
