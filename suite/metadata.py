"""Mapping metadata, with parts standing for mapping rows: a brand is a target, its parts name signals."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.inputs import table, text
from suite.registry import query
from telefold.operators import mapping as maps, profile
from telefold.session import work_path
from telefold.sinks import tables as sinks
from telefold.sources import metadata

PACKED_SQL = """
packed AS (
  SELECT p_partkey AS id, p_brand AS target_name, p_name AS target_desc,
         CASE WHEN p_brand LIKE '%1' THEN NULL ELSE 'm' END AS target_unit,
         'S' || p_size::VARCHAR || ';T' || p_type AS signal_code,
         CASE WHEN p_brand LIKE '%1' THEN NULL WHEN p_size = 13 THEN 'km'
              WHEN p_size > 25 THEN 'km;m' ELSE 'cm;foo' END AS signal_unit,
         p_type AS hos_series
  FROM part),
flat AS (
  SELECT id, target_name, target_desc, target_unit, hos_series, 0 AS place, split_part(signal_code, ';', 1) AS signal_name,
         split_part(signal_unit, ';', 1) AS signal_unit FROM packed WHERE signal_unit IS NULL OR signal_unit LIKE '%;%'
  UNION ALL
  SELECT id, target_name, target_desc, target_unit, hos_series, 1, split_part(signal_code, ';', 2),
         split_part(signal_unit, ';', 2) FROM packed WHERE signal_unit IS NULL OR signal_unit LIKE '%;%')
"""


def packed(spark, sf_dir):
    text_target = F.col("p_brand").endswith("1")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_brand").alias("target_name"),
        F.col("p_name").alias("target_desc"),
        F.when(~text_target, "m").alias("target_unit"),
        F.concat(F.lit("S"), text("p_size"), F.lit(";T"), "p_type").alias("signal_code"),
        F.when(text_target, F.lit(None).cast("string"))
        .when(F.col("p_size") == 13, "km")
        .when(F.col("p_size") > 25, "km;m")
        .otherwise("cm;foo")
        .alias("signal_unit"),
        F.col("p_type").alias("hos_series"),
    )


@query(
    "config_unpack",
    f"""WITH {PACKED_SQL}
    SELECT id, target_name, place, signal_name, signal_unit, NULL::VARCHAR AS reason FROM flat
    UNION ALL SELECT id, target_name, 0, signal_code, signal_unit, 'signal and unit lists differ in length'
    FROM packed WHERE signal_unit = 'km'""",
)
def config_unpack(spark, sf_dir):
    return maps.unpack_mapping(packed(spark, sf_dir)).select(
        "id", "target_name", "place", "signal_name", "signal_unit", "reason"
    )


@query(
    "config_compile",
    f"""WITH {PACKED_SQL}
    SELECT target_name, signal_name, row_number() OVER (PARTITION BY target_name ORDER BY id, place)::INTEGER AS priority,
           target_unit IS NULL AS is_text,
           CASE signal_unit WHEN 'km' THEN 1000.0::DOUBLE WHEN 'm' THEN 1.0::DOUBLE WHEN 'cm' THEN 0.01::DOUBLE END AS factor,
           target_unit IS NULL OR signal_unit <> 'foo' AS convertible
    FROM flat""",
)
def config_compile(spark, sf_dir):
    flat = maps.unpack_mapping(packed(spark, sf_dir)).where(F.col("reason").isNull())
    return maps.compile_mapping(flat, ["id", "place"]).select(
        "target_name", "signal_name", "priority", "is_text", "factor", "convertible"
    )


@query(
    "config_regroup",
    f"""WITH {PACKED_SQL},
    pairs AS (SELECT target_name, signal_name, signal_unit, min(id * 10 + place) AS seen FROM flat GROUP BY ALL),
    head AS (SELECT target_name, first(target_desc ORDER BY id, place) AS target_desc,
                    first(target_unit ORDER BY id, place) AS target_unit FROM flat GROUP BY target_name)
    SELECT target_name, target_desc, target_unit, string_agg(signal_name, ';' ORDER BY seen) AS signal_code,
           string_agg(signal_unit, ';' ORDER BY seen) AS signal_unit, 'all' AS hos_series, 'gc' AS data_type
    FROM pairs JOIN head USING (target_name) GROUP BY target_name, target_desc, target_unit""",
)
def config_regroup(spark, sf_dir):
    return maps.regroup_mapping(packed(spark, sf_dir), "id", hos_series="all", data_type="gc")


@query(
    "config_validate",
    """SELECT p_brand || p_type AS target_name, max(p_size > 5) AS target_has_unit, max(p_size > 45) AS signal_has_unit
    FROM part GROUP BY ALL HAVING max(p_size > 5) <> max(p_size > 45)""",
)
def config_validate(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(
        F.concat("p_brand", "p_type").alias("target_name"),
        F.when(F.col("p_size") > 5, "m").otherwise("-").alias("target_unit"),
        F.when(F.col("p_size") > 45, "km").otherwise("").alias("signal_unit"),
    )
    return maps.mapping_faults(rows)


@query(
    "schema_from_config",
    f"""WITH {PACKED_SQL}
    SELECT target_name, min(target_desc) AS target_desc, max(target_unit) AS target_unit, max(target_unit) IS NULL AS is_text
    FROM packed GROUP BY target_name""",
)
def schema_from_config(spark, sf_dir):
    return maps.target_types(packed(spark, sf_dir))


@query(
    "sheet_mapping",
    """WITH t AS (SELECT p_partkey, p_brand AS target_name, p_name AS target_desc,
                       CASE WHEN p_brand LIKE '%1' THEN '-' ELSE 'm' END AS target_unit FROM part)
    SELECT target_name, first_value(target_desc) OVER (PARTITION BY target_name ORDER BY p_partkey) AS target_desc,
           CASE WHEN target_unit = '-' THEN NULL ELSE target_unit END AS target_unit, 'P' || p_partkey::VARCHAR AS signal_name, p_type AS signal_desc,
           CASE WHEN p_size > 10 THEN 'km' END AS signal_unit,
           CASE WHEN p_size > 10 THEN 'Float64' ELSE 'String' END AS signal_type, 'source_a' AS data_source
    FROM t JOIN part USING (p_partkey)""",
)
def sheet_mapping(spark, sf_dir):
    sheet = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("target_name"),
        F.col("p_name").alias("target_desc"),
        F.when(F.col("p_brand").endswith("1"), "-").otherwise("m").alias("target_unit"),
        F.concat(F.lit("P"), text("p_partkey")).alias("pid"),
        F.col("p_type").alias("Description"),
        F.when(F.col("p_size") > 10, "km").otherwise("").alias("unit"),
        "p_partkey",
    )
    return maps.sheet_mapping(sheet, "source_a", "p_partkey")


@query(
    "config_import",
    """SELECT p_brand AS target_name, p_name AS target_desc, p_type AS target_unit, p_partkey::VARCHAR AS signal_code,
           'km' AS signal_unit, p_size::DOUBLE AS multiplier, 0.0::DOUBLE AS "offset", 'platform_a' AS platname, 'source_c' AS data_source
    FROM part""",
)
def config_import(spark, sf_dir):
    """Sheet written as CSV with a byte-order mark, read back by its headings, appended with constants."""
    sheet, target = work_path(spark, "sheet"), work_path(spark, "mapping")
    heads = list(maps.SHEET_COLUMNS)
    columns = [F.col("p_brand"), F.col("p_name"), F.col("p_type"), text("p_partkey"), F.lit("km"), text("p_size"), F.lit("0")]
    rows = table(spark, sf_dir, "part").select(
        F.lit("x").alias("note"), *[c.alias(h) for c, h in zip(columns, heads)]
    )
    sinks.export_csv(rows, sheet, bom=True)
    read = metadata.sheet_scan(spark, sheet, heads)
    sinks.append_with(maps.import_sheet(read, platname="platform_a"), target, data_source="source_c")
    got = spark.read.parquet(target)
    return got.withColumns({c: F.col(c).cast("double") for c in ("multiplier", "offset")})


@query(
    "mapping_scan",
    f"""WITH {PACKED_SQL}
    SELECT id, target_name, signal_code AS signal_name, hos_series AS signal_type FROM packed
    WHERE hos_series = 'ECONOMY' AND target_name <> 'Brand#2'""",
)
def mapping_scan(spark, sf_dir):
    rows = packed(spark, sf_dir).withColumns(
        {
            "data_source": F.when(F.col("target_name") == "Brand#2", "source_b").otherwise("source_c"),
            "data_type": F.col("hos_series"),
            "hos_series": F.concat("hos_series", F.lit("系列")),
        }
    )
    found = metadata.mapping_scan(rows, "source_c", hos_series="ECONOMY", data_type="ECONOMY")
    return metadata.packed_as_normalised(found).select("id", "target_name", "signal_name", "signal_type")


@query(
    "scaling_scan",
    """SELECT p_partkey::VARCHAR AS pid, p_size::DOUBLE AS multiplier, p_retailprice AS "offset" FROM part
    WHERE p_type <> 'SMALL'""",
)
def scaling_scan(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(
        text("p_partkey").alias("signalcode"), F.col("p_size").alias("multiplier"),
        F.col("p_retailprice").alias("offset"), F.when(F.col("p_type") == "SMALL", 1).otherwise(0).alias("isfaultcode"),
    )
    return metadata.scaling_scan(rows)


@query(
    "split_signal_lists",
    """SELECT p_partkey, unnest([p_type, p_name]) AS pid FROM part WHERE p_size NOT IN (5, 10)""",
)
def split_signal_lists(spark, sf_dir):
    pids = (
        F.when(F.col("p_size") == 5, "/").when(F.col("p_size") != 10, F.concat_ws("、", "p_type", "p_name"))
    )
    return maps.split_rows(table(spark, sf_dir, "part").select("p_partkey", pids.alias("pids")), "pids", "pid")


ZIP_SQL = """
z AS (SELECT p_partkey, p_name AS "desc", p_brand AS pid FROM part
      UNION ALL SELECT p_partkey, p_type, 'T' || p_size::VARCHAR FROM part WHERE p_size <> 7)
"""


def _zipped(spark, sf_dir):
    second = F.when(F.col("p_size") == 7, F.lit("")).otherwise(F.concat(F.lit("T"), text("p_size")))
    rows = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat_ws(";", "p_name", "p_type", F.lit("extra")).alias("desc"),
        F.concat_ws(";", F.col("p_brand"), second).alias("pid"),
    )
    return maps.zip_rows(rows, "desc", "pid")


@query("zip_signal_lists", f"""WITH {ZIP_SQL} SELECT p_partkey, "desc", pid FROM z""")
def zip_signal_lists(spark, sf_dir):
    return _zipped(spark, sf_dir)


@query(
    "conflict_names",
    f"""WITH {ZIP_SQL}, c AS (SELECT pid, "desc", count(*) AS ct FROM z GROUP BY ALL)
    SELECT pid, "desc", ct FROM c WHERE pid IN (SELECT pid FROM c GROUP BY pid HAVING count(*) > 1)""",
)
def conflict_names(spark, sf_dir):
    return profile.name_conflicts(_zipped(spark, sf_dir))


@query(
    "synonym_group",
    """WITH m AS (SELECT p_partkey AS id, p_name AS "desc", 'T' || p_size::VARCHAR AS pid, p_type AS unitname,
                         p_brand AS signal_unit, CASE WHEN p_size > 25 THEN 'app' END AS app FROM part),
    h AS (SELECT "desc", first(unitname ORDER BY id) AS target_unit, first(app ORDER BY id) AS app FROM m GROUP BY "desc"),
    p AS (SELECT "desc", pid, last(signal_unit ORDER BY id) AS unit FROM m GROUP BY "desc", pid),
    t AS (SELECT 'T' || p_size::VARCHAR AS pid, first(p_brand ORDER BY p_partkey) AS target_name FROM part
          WHERE p_size < 40 GROUP BY 1)
    SELECT "desc", pid, target_unit, unit, app, target_name FROM p JOIN h USING ("desc") LEFT JOIN t USING (pid)""",
)
def synonym_group(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    pid = F.concat(F.lit("T"), text("p_size"))
    merged = part.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("desc"), pid.alias("pid"),
        F.col("p_type").alias("unitname"), F.col("p_brand").alias("signal_unit"),
        F.when(F.col("p_size") > 25, "app").alias("app"),
    )
    flat = part.where("p_size < 40").select(
        F.col("p_partkey").alias("id"), pid.alias("pid"), F.col("p_brand").alias("target_name")
    )
    return profile.group_synonyms(merged, flat, "id")


@query(
    "joined_values",
    """SELECT o_custkey, string_agg(o_orderpriority, ';' ORDER BY o_orderpriority) AS priorities,
           first(f ORDER BY o_orderpriority) AS first_status FROM (
      SELECT o_custkey, o_orderpriority, min(o_orderstatus) AS f FROM orders GROUP BY ALL) GROUP BY o_custkey""",
)
def joined_values(spark, sf_dir):
    """Distinct values of a group as one text, and a first value by a stated order."""
    rows = table(spark, sf_dir, "orders").withColumn("o", F.col("o_orderpriority"))
    return rows.groupBy("o_custkey").agg(
        maps.joined_values("o_orderpriority", "o").alias("priorities"),
        maps.first_value("o_orderstatus", F.struct("o_orderpriority", "o_orderstatus")).alias("first_status"),
    )


@query(
    "distinct_pairs",
    "SELECT DISTINCT p_type AS pid, p_size AS unit FROM part",
)
def distinct_pairs(spark, sf_dir):
    pairs = table(spark, sf_dir, "part").select(F.col("p_type").alias("pid"), F.col("p_size").alias("unit"))
    return pairs.dropDuplicates(["pid", "unit"])
