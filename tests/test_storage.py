"""Stored tables, key filters, hot keys and kept counts."""

from __future__ import annotations

import glob
import os
import uuid

import pandas as pd
import pytest
from pyspark.sql import functions as F

from suite import fusion as fusion_suite, inputs
from suite.storage import run_and_count
from telefold.operators import enrich, grouped, profile
from telefold.session import work_path
from telefold.sinks import catalogue, tables as sinks
from telefold.sources import frames as scans

LAID_OUT = "t double, data_source string, data_type string, clt_date string"


@pytest.fixture
def table(spark):
    name = f"db_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{work_path(spark, 'database')}'")
    spark.sql(f"CREATE TABLE {name}.t ({LAID_OUT}) USING parquet PARTITIONED BY (data_source, data_type, clt_date)")
    yield f"{name}.t"
    spark.sql(f"DROP DATABASE {name} CASCADE")


def rows_of(spark, rows):
    return spark.createDataFrame(rows, LAID_OUT)


def held(spark, name):
    return sorted((r.data_source or "", r.clt_date, r.t) for r in spark.table(name).collect())


ODD = ["a", "it's", "x=y/z%", "a:b", "back\\slash", None]


def test_partitions_with_odd_names(spark, table):
    rows = [(float(i), s, "gc", "2024-01-01") for i, s in enumerate(ODD)]
    catalogue.append_rows(rows_of(spark, rows), table)
    assert {r.data_source for r in catalogue.partitions(spark, table).collect()} == set(ODD)
    for _ in range(2):
        catalogue.replace_partitions(rows_of(spark, [(9.0, s, "gc", "2024-01-01") for s in ODD[:3]]), table)
    assert held(spark, table) == sorted((s or "", "2024-01-01", 9.0 if i < 3 else float(i)) for i, s in enumerate(ODD))
    assert catalogue.drop_partitions(spark, table, F.col("data_source") == "it's") == 1
    assert catalogue.drop_partitions(spark, table, F.col("data_source").isNull()) == 1
    assert {s for s, _, _ in held(spark, table)} == set(ODD) - {"it's", None}


def test_replacing_partitions_leaves_the_session_as_it_is(spark, table):
    before = spark.conf.getAll
    catalogue.append_rows(rows_of(spark, [(1.0, "a", "gc", "2024-01-01"), (1.0, "b", "gc", "2024-01-01")]), table)
    catalogue.replace_partitions(rows_of(spark, [(2.0, "a", "gc", "2024-01-01")]).select("clt_date", "data_type", "t", "data_source"), table)
    assert held(spark, table) == [("a", "2024-01-01", 2.0), ("b", "2024-01-01", 1.0)]
    assert spark.conf.getAll == before


def test_reloaded_days_without_rows_are_dropped(spark, table):
    days = ["2024-01-01", "2024-01-02", "2024-01-03"]
    catalogue.append_rows(rows_of(spark, [(1.0, s, "gc", d) for s in ("a", "b") for d in days]), table)
    catalogue.reload_days(rows_of(spark, [(2.0, "a", "gc", d) for d in days[1:]] + [(2.0, "b", "gc", days[0])]), table, days[0], days[1], "a")
    assert held(spark, table) == [("a", days[1], 2.0), ("a", days[2], 1.0)] + [("b", d, 1.0) for d in days]
    catalogue.reload_days(rows_of(spark, []), table, days[0], days[2])
    assert held(spark, table) == [] and catalogue.partitions(spark, table).count() == 0
    catalogue.empty_table(spark, table)
    assert spark.table(table).columns == ["t", *sinks.LAYOUT]


def test_bucketed_tables_join_without_a_shuffle(spark):
    name = f"db_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{work_path(spark, 'database')}'")
    for t in ("a", "b"):
        catalogue.save_bucketed(spark.range(1000).withColumn(t, F.col("id") * 2), f"{name}.{t}", ["id"], 6)
    both = spark.table(f"{name}.a").hint("merge").join(spark.table(f"{name}.b"), "id")
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert both.count() == 1000
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_only_asked_days_are_read(spark):
    path = work_path(spark, "raw")
    raw = spark.range(100).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 10).cast("int")).alias("uploadDate"))
    sinks.store_raw(raw, path, "uploadDate")
    stored = spark.read.parquet(path)
    few = stored.where(F.col("uploadDate").between(F.lit("2024-01-03").cast("date"), F.lit("2024-01-04").cast("date")))
    assert few.count() == 20 and run_and_count(few)["partitions"] == 2
    wanted = work_path(spark, "days")
    spark.createDataFrame([("2024-01-05", 1), ("2024-01-09", 2), ("2024-01-09", 2), ("2024-01-01", 3)], "day string, kind int").withColumn(
        "day", F.to_date("day")
    ).write.parquet(wanted)
    chosen = scans.frames_of_days(stored, spark.read.parquet(wanted).where("kind < 3"))
    assert chosen.count() == 20 and run_and_count(chosen)["partitions"] == 2


def test_a_key_filter_holds_every_key_and_few_others(spark):
    keys = spark.range(5000).select(F.col("id").cast("string").alias("ein")).union(spark.createDataFrame([(None,)], "ein string"))
    facts = spark.range(50_000).select(F.col("id").cast("string").alias("ein"), "id")
    words, bits = enrich.key_filter(keys, "ein")
    assert len(words.first().words) == bits // 64
    kept = enrich.only_keys_filtered(facts, keys.hint("merge"))
    assert sorted(r.id for r in kept.collect()) == list(range(5000))
    passed = [p for p in str(kept._jdf.queryExecution().optimizedPlan().toString()).split("\n") if "getbit" in p and "Filter" in p]
    assert passed  # the filter stands on the facts' side, below the join
    held_words = words.first().words
    may = F.lit(True)
    array = F.lit(held_words)
    for at in enrich._places(F.col("ein"), bits):
        may = may & (F.call_function("getbit", F.get(array, F.floor(at / 64).cast("int")), (at % 64).cast("int")) == 1)
    assert 5000 <= facts.where(may).count() <= 5000 + 0.05 * 45_000


def test_no_keys_no_rows(spark):
    facts = spark.range(10).select(F.col("id").cast("string").alias("ein"))
    assert enrich.only_keys_filtered(facts, facts.where("false")).count() == 0
    assert enrich.heavy_keys(facts.where("false"), "ein") == []


def test_only_hot_keys_are_spread(spark):
    """A third of the rows has one key, NULL has some; without AQE no task gets three times the median."""
    n, parts = 90_000, 12
    ein = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 100 == 1, None).otherwise((F.col("id") % 900).cast("string"))
    facts = spark.range(n).select("id", ein.alias("ein"))
    lookup = spark.range(900).select(F.col("id").cast("string").alias("ein"), F.col("id").alias("m")).union(spark.createDataFrame([("hot", -1)], "ein string, m long"))
    heavy = dict(enrich.heavy_keys(facts, "ein", parts))
    assert heavy.keys() == {"hot"} and heavy["hot"] >= 4
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        joined = enrich.spread_lookup_join(facts, lookup.hint("merge"), "ein", ["id"], parts)
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(sizes) == n and sizes[-1] < 3 * sizes[len(sizes) // 2]
    plain = facts.join(lookup, "ein", "left")
    columns = ["id", "ein", "m"]
    assert joined.columns == ["ein", "id", "m"]
    assert joined.select(columns).exceptAll(plain.select(columns)).count() == 0


def test_a_recounted_day_touches_no_other(spark):
    path = work_path(spark, "census")
    frames = spark.createDataFrame([(f"2024-01-0{d}", ["A", "B"] if d < 3 else ["A", None]) for d in (1, 2, 3)], "clt_date string, codes array<string>")
    profile.store_census(frames, path, "2024-01-01", "2024-01-03")
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/*/*.parquet")}
    more = frames.union(spark.createDataFrame([("2024-01-02", ["B", "C"]), ("2024-01-09", ["Z"])], "clt_date string, codes array<string>"))
    profile.store_census(more, path, "2024-01-02", "2024-01-02")
    after = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/*/*.parquet")}
    assert {f for f in before if before[f] == after.get(f)} == {f for f in before if "2024-01-02" not in f}
    counted = {(r.clt_date, r.pid): r.ct for r in profile.stored_census(spark, path, "2024-01-02", "2024-01-09", more_than=0).collect()}
    assert counted == {("2024-01-02", "A"): 1, ("2024-01-02", "B"): 2, ("2024-01-02", "C"): 1, ("2024-01-03", "A"): 1}
    profile.store_census(frames.where("false"), path, "2024-01-03", "2024-01-03")
    assert profile.stored_census(spark, path, "2024-01-03", "2024-01-03", more_than=0).collect() == []


def test_grouped_fusion_equals_a_pandas_group(spark, sf_dir):
    """The grouped fusion beside a plain function on each group's rows."""
    tall, mapping = inputs.signal_events(spark, sf_dir), fusion_suite.group_mapping(spark)
    fused = grouped.fuse_grouped(tall, mapping)
    rules = [(r.signal_name, r.target_name, r.priority, r.is_text, r.factor) for r in mapping.collect()]
    names = ["speed", "pressure", "note"]

    def plain(rows: pd.DataFrame) -> pd.DataFrame:
        out = {"ein": rows.ein.iloc[0], "clt_timestamp": rows.clt_timestamp.iloc[0], "vin": rows.vin.dropna().min(), **dict.fromkeys(names)}
        for name in names:
            sent = sorted((r.pos, priority, r.value, factor) for r in rows.itertuples() for s, t, priority, text, factor in rules if (s, t) == (r.pid, name))
            if sent:
                _, _, value, factor = sent[0]
                out[name] = value if name == "note" else str(float(value) * (factor if factor == factor and factor is not None else 1.0))
        return pd.DataFrame([out])

    want = tall.groupBy("ein", "clt_timestamp").applyInPandas(plain, "ein string, clt_timestamp long, vin string, speed string, pressure string, note string")
    columns = ["ein", "clt_timestamp", "vin", *names]

    def told(df):
        return sorted(tuple(None if r[c] is None else float(r[c]) if c in names else r[c] for c in columns) for r in df.collect())

    assert repr(told(fused)) == repr(told(want))
