from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F

from telefold.operators import enrich, mapping as maps, profile, quality


def test_latest_device_is_repeatable(spark):
    rows = [("e", "m1", "D", "x", "2024-01-01", "v"), ("e", "m2", "D", "x", "2024-02-01", None), ("e", "m3", "D", "x", "2024-02-01", "v")]
    ddl = "hos_id string, hos_mat_id string, hos_series string, type string, create_time string, vin string"
    for order in (rows, rows[::-1]):
        got = enrich.device_lookup(spark.createDataFrame(order, ddl)).collect()
        assert [(r.ein, r.hos_mat_id) for r in got] == [("e", "m3")]


@pytest.mark.parametrize("salts", [1, 8])
def test_enrichment_keeps_every_row_of_a_hot_engine(spark, salts):
    frames = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("e"), F.col("id"))).alias("ein"),
        F.col("id").alias("clt_timestamp"),
        F.lit("v").alias("vin"),
    )
    devices = spark.createDataFrame(
        [("hot", "m", "D", "x", "2024", "v"), ("e0", "n", "H", "x", "2024", "v")],
        "hos_id string, hos_mat_id string, hos_series string, type string, create_time string, vin string",
    )
    got = enrich.enrich_devices(frames, devices, salts)
    counts = {r.hos_series: r["count"] for r in got.groupBy("hos_series").count().collect()}
    assert counts == {"D": 2000, "H": 1, None: 999}


def test_first_match_does_not_multiply(spark):
    left = spark.createDataFrame([("a",), ("b",)], "k string")
    right = spark.createDataFrame([("a", 2, "y"), ("a", 1, None)], "k string, o int, v string")
    got = enrich.first_match(left, right, "k", "o", ["v"]).collect()
    assert sorted((r.k, r.v) for r in got) == [("a", None), ("b", None)]


@pytest.mark.parametrize("seed", range(3))
def test_quantiles_are_exact(spark, seed, monkeypatch):
    monkeypatch.setattr(profile, "RANGE_VALUES", 20)
    rng = random.Random(seed)
    data = {
        "hot": [float(rng.choice([1, 2, 2, 3])) for _ in range(400)] + [rng.random() * 1e6 for _ in range(300)],
        "one": [5.0],
        "two": [1.0, 2.0],
        "spread": [rng.gauss(0, 1) ** 5 for _ in range(999)],
    }
    rows = [(g, v) for g, vs in data.items() for v in vs] + [("one", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r for r in profile.quantiles(df, ["g"], "v", [0, 0.25, 0.5, 0.9, 1]).collect()}
    assert set(got) == set(data)
    for g, vs in data.items():
        vs = sorted(vs)
        for i, p in enumerate([0, 0.25, 0.5, 0.9, 1]):
            at = (len(vs) - 1) * p
            low = int(at)
            want = vs[low] + (vs[min(low + 1, len(vs) - 1)] - vs[low]) * (at - low)
            assert got[g][f"q{i}"] == pytest.approx(want, rel=1e-9, abs=1e-12)
        assert got[g].n == len(vs)
    assert got["spread"].q2 == pytest.approx(statistics.median(data["spread"]))


def test_box_whiskers(spark):
    df = spark.createDataFrame([("g", float(v)) for v in [1, 2, 3, 4, 100]], "g string, v double")
    r = profile.box_summary(df, ["g"], "v").first()
    assert (r.whisker_low, r.whisker_high, r.outliers, r.median) == (1.0, 4.0, 1, 3.0)


def test_unpack_keeps_broken_rows(spark):
    rows = [("t", "a;b", "km;m"), ("u", "a;b", "km"), ("w", "a;b", None), ("x", None, None)]
    df = spark.createDataFrame(rows, "target_name string, signal_code string, signal_unit string")
    got = maps.unpack_mapping(df).collect()
    assert [(r.target_name, r.place, r.signal_name, r.signal_unit, r.reason is None) for r in got] == [
        ("t", 0, "a", "km", True), ("t", 1, "b", "m", True), ("u", 0, "a;b", "km", False),
        ("w", 0, "a", None, True), ("w", 1, "b", None, True),
    ]


def test_schema_and_ddl(spark):
    df = spark.createDataFrame(
        [("speed", "km", "it's"), ("speed", "km", "it's"), ("note", "-", "text")],
        "target_name string, target_unit string, target_desc string",
    )
    schema = maps.fused_schema(df, "decimal(20,7)")
    assert schema["speed"].dataType.simpleString() == "decimal(20,7)"
    assert schema["note"].dataType.simpleString() == "string"
    assert len(schema) == len(maps.KEY_COLUMNS) + 2
    ddl = maps.fused_ddl(df, "fused_ddl_check")
    spark.sql(ddl)
    assert "speed" in spark.table("fused_ddl_check").columns
    spark.sql("DROP TABLE fused_ddl_check")


def test_value_checks_find_a_spoilt_value(spark):
    mapping = spark.createDataFrame(
        [("t", "m", "S1", "km", 1), ("z", "m", "S2", "m", 2)],
        "target_name string, target_unit string, signal_name string, signal_unit string, id int",
    )
    compiled = maps.compile_mapping(mapping, "id")
    raw = spark.createDataFrame(
        [("e", 1, ["S1", "S2"], ["2", "0"]), ("e", 2, ["S1"], ["2"])],
        "ein string, clt_timestamp int, codes array<string>, vals array<string>",
    )
    fused = spark.createDataFrame([("e", 1, 2000.0, 0.0), ("e", 2, 2001.0, None)], "ein string, clt_timestamp int, t double, z double")
    got = quality.value_checks(raw, fused, compiled).collect()
    assert sorted((r.clt_timestamp, r.target_name, r.ok) for r in got) == [(1, "t", True), (1, "z", True), (2, "t", False)]


def test_counts_show_days_of_either_side(spark):
    a = spark.createDataFrame([("2024-01-01",)] * 3 + [("2024-01-02",)], "d string")
    b = spark.createDataFrame([("2024-01-01",)] * 2 + [("2024-01-03",)] * 5, "d string")
    got = {r.day: (r.raw_rows, r.fused_rows, r.ok) for r in quality.reconcile_counts(a, b, "d", "d", 2).collect()}
    assert got == {"2024-01-01": (3, 2, True), "2024-01-02": (1, 0, True), "2024-01-03": (0, 5, False)}


def test_samples(spark):
    df = spark.range(500)
    one = [r.id for r in profile.sample_rows(df, 20, ["id"], "3").collect()]
    two = [r.id for r in profile.sample_rows(df.repartition(7), 20, ["id"], "3").collect()]
    assert one == two and len(set(one)) == 20
    assert profile.any_rows(df, 20, seed=1).count() == 20


def test_jdbc_options():
    from telefold.sources import jdbc

    assert jdbc.read_options("select 1")["query"] == "select 1"
    split = jdbc.read_options("select * from t", jdbc.Split("d", "2024-01-01", "2024-02-01", 31))
    assert split["dbtable"] == "(select * from t) q" and "query" not in split and split["numPartitions"] == "31"


def test_kafka_options():
    from telefold.sources import streams

    options = streams.kafka_options("broker:1", "topic", streams.OFFSETS_PER_TRIGGER["signals"])
    assert options["maxOffsetsPerTrigger"] == "100" and options["startingOffsets"] == "latest"
