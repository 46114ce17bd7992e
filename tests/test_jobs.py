"""Writes, backfills and streams: repeated runs must not change the result."""

from __future__ import annotations

import datetime
import glob

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from telefold.operators import mapping as maps
from telefold.plans import backfill
from telefold.plans.pipeline import fuse_table, good_rows, rejected_rows
from telefold.session import work_path
from telefold.sinks import tables as sinks
from telefold.sources.streams import open_files
from telefold.streaming import jobs


@pytest.fixture(scope="module")
def compiled(spark):
    rows = [("t", "m", "S1", "km", 1), ("u", None, "S2", None, 2)]
    return maps.compile_mapping(
        spark.createDataFrame(rows, "target_name string, target_unit string, signal_name string, signal_unit string, id int"), "id"
    )


def raw(spark, rows):
    return spark.createDataFrame(
        rows, "ein string, vin string, clt_time string, codes string, vals string, longitude string, latitude string"
    )


def test_full_job_and_rejects(spark, compiled):
    rows = [
        ("0A", "V", "2024-01-01 10:00:00", "['S1','S2']", "['1val','x']", "121.5", None),
        ("", "V", "2024-01-01 10:00:00", "['S1']", "['1']", "121.5", "31"),
        ("A", "V", "yesterday", "['S1']", "['1']", "121.5", "31"),
        ("A", "V", "2024-01-01 10:00:01", "['S1']", "['oops']", "121.5", "31"),
        ("A", "V", "2024-01-01 10:00:02", "['S9']", "['1']", "bad", "31"),
    ]
    fused = fuse_table(raw(spark, rows), compiled, form="quoted", on_bad_number="reject")
    good, bad = good_rows(fused).collect(), rejected_rows(fused).collect()
    assert len(good) + len(bad) == len(rows)
    assert sorted(r.reject_reason for r in bad) == ["no engine id", "no readable time", "unreadable number: t"]
    first = [r for r in good if r.ein == "0A"][0]
    assert (first.t, first.u, first.lng, first.lat, first.clt_date, first.clt_timestamp) == (
        1000.0, "x", 121.5, None, "2024-01-01", 1704103200,
    )
    assert [r.lng for r in good if r.ein == "A"] == [None]


@pytest.mark.parametrize("form,codes,vals", [("comma", "S1,S2", "1,x"), ("bracket", "['S1','S2']", "[1,x]"), ("words", "[S1,S2]", "[1, x]")])
def test_list_forms(spark, compiled, form, codes, vals):
    df = raw(spark, [("A", "V", "2024-01-01 10:00:00", codes, vals, None, None)])
    r = fuse_table(df, compiled, form=form).first()
    assert (r.t, r.u) == (1000.0, "x")


def day_rows(spark, days, value=1.0):
    rows = [("source_a", "gc", d, "v", i, value) for d in days for i in range(3)]
    return spark.createDataFrame(rows, "data_source string, data_type string, clt_date string, vin string, clt_timestamp int, t double")


def table(spark, path):
    return sorted((str(r.clt_date), r.clt_timestamp, r.t) for r in spark.read.parquet(path).collect())


def test_reload_is_idempotent_and_local(spark):
    path = work_path(spark, "t")
    sinks.reload_partitions(day_rows(spark, ["2024-01-01", "2024-01-02"]), path)
    before = table(spark, path)
    sinks.reload_partitions(day_rows(spark, ["2024-01-02"]), path)
    assert table(spark, path) == before
    sinks.reload_partitions(day_rows(spark, ["2024-01-02"], 7.0), path, cluster=True)
    assert [r[2] for r in table(spark, path)] == [1.0] * 3 + [7.0] * 3


def test_reloading_a_day_without_rows_empties_it(spark):
    path = work_path(spark, "t")
    sinks.append_partitions(day_rows(spark, ["2024-01-01", "2024-01-02"]), path)
    sinks.reload_day(day_rows(spark, ["2024-01-05"]), path, "source_a", "gc", "2024-01-01")
    assert {d for d, _, _ in table(spark, path)} == {"2024-01-02"}


def test_delete_then_append(spark):
    path = work_path(spark, "t")
    sinks.reload_partitions(day_rows(spark, ["2024-01-01", "2024-01-02", "2024-01-03"]), path)
    kept = day_rows(spark, ["2024-01-04"]).withColumn("t", F.lit(None).cast("double"))
    sinks.append_partitions(kept, path)
    new = day_rows(spark, ["2024-01-02"], 9.0).withColumn("clt_date", F.col("clt_date").cast("date"))
    matches = (F.col("clt_date").cast("string") != "2024-01-02") & (F.col("t") >= 1)
    sinks.delete_then_append(spark, path, matches, new)
    got = [(str(r.clt_date), r.t) for r in spark.read.parquet(path).collect()]
    assert sorted(d for d, _ in got) == ["2024-01-02"] * 6 + ["2024-01-04"] * 3
    assert sorted(t for d, t in got if d == "2024-01-02") == [1.0] * 3 + [9.0] * 3


@pytest.mark.parametrize("source", ["a:b", "001", "x=y/z%", None])
def test_odd_partition_names(spark, source):
    def rows(days, value=1.0):
        return day_rows(spark, days, value).withColumn("data_source", F.lit(source).cast("string"))

    def days(path):
        got = sinks.read_partitions(spark, path).collect()
        assert {r.data_source for r in got} <= {source, "source_a"}
        return sorted((r.data_source == source, r.clt_date, r.t) for r in got)

    path = work_path(spark, "odd")
    sinks.append_partitions(rows(["2024-01-01", "2024-01-02"]).unionByName(day_rows(spark, ["2024-01-01"])), path)
    other = [(False, "2024-01-01", 1.0)] * 3
    if source is not None:
        sinks.reload_day(rows(["2024-01-01"], 2.0), path, source, "gc", "2024-01-01")
        assert days(path) == sorted(other + [(True, "2024-01-01", 2.0)] * 3 + [(True, "2024-01-02", 1.0)] * 3)
        sinks.reload_day(rows([]), path, source, "gc", "2024-01-02")
    else:
        sinks.delete_then_append(spark, path, F.col("data_source").isNull() & (F.col("clt_date") == "2024-01-02"), rows([]))
    assert {d for mine, d, _ in days(path) if mine} == {"2024-01-01"}
    sinks.delete_then_append(spark, path, F.col("data_source").eqNullSafe(F.lit(source)), rows(["2024-01-03"], 5.0))
    assert days(path) == sorted(other + [(True, "2024-01-03", 5.0)] * 3)


def test_backfill_empties_days_without_rows(spark):
    path = work_path(spark, "t")
    days = ["2024-01-01", "2024-01-02", "2024-01-03"]
    backfill.backfill(day_rows(spark, days), lambda d: d, path, *days[::2])
    sinks.append_partitions(day_rows(spark, days).withColumn("data_source", F.lit("other")), path)
    backfill.backfill(day_rows(spark, days[1:]), lambda d: d, path, *days[:2], data_source="source_a")
    got = sinks.read_partitions(spark, path).groupBy("data_source", "clt_date").count().collect()
    assert {(r.data_source, r.clt_date) for r in got} == {("source_a", d) for d in days[1:]} | {("other", d) for d in days}


def test_backfill_equals_day_by_day(spark):
    rows = day_rows(spark, ["2024-01-01", "2024-01-02", "2024-01-03"])
    one, many = work_path(spark, "one"), work_path(spark, "many")
    backfill.backfill(rows, lambda d: d, one, "2024-01-01", "2024-01-02")
    for day in backfill.day_list("2024-01-01", "2024-01-02"):
        backfill.backfill(rows, lambda d: d, many, day)
    assert table(spark, one) == table(spark, many) and len(table(spark, one)) == 6


def test_yesterday_is_the_default(spark):
    today = datetime.date.today()
    rows = [(today - datetime.timedelta(days=i),) for i in range(4)]
    got = backfill.day_range(spark.createDataFrame(rows, "d date"), "d").collect()
    assert [r.d for r in got] == [today - datetime.timedelta(days=1)]


def test_csv_forms(spark):
    path = work_path(spark, "csv")
    df = spark.createDataFrame([("a@b", 1), ("é", 2)], "`名` string, n int")
    sinks.export_csv(df, path, bom=True)
    heads = {open(f, "rb").read(3) for f in glob.glob(path + "/part-*")}
    assert heads == {b"\xef\xbb\xbf"}
    sinks.export_archive(df, path)
    back = spark.read.csv(path, sep="@", header=True)
    assert sorted(r[0] for r in back.collect()) == ["a@b", "é"]


def test_parts_by_size(spark):
    assert sinks.in_parts(spark.range(2500), 1000).rdd.getNumPartitions() == 3


MESSAGE = '{{"ein":"E{0}","uploadTime":170000000{0}000,"deviceID":"V","longitude":"1","latitude":"2","items":[{{"signalname":"S1","value":"{0}"}}]}}'


def test_stream_restarts_where_it_stopped_and_equals_batch(spark, compiled):
    source, path, checkpoint = (work_path(spark, n) for n in ("in", "out", "cp"))
    texts = [MESSAGE.format(i) for i in range(6)]

    def run():
        query = jobs.stream_frames(open_files(spark, source, 1), compiled, path, checkpoint, every=None, zone="UTC")
        query.awaitTermination()
        return sorted(((r.ein or "", r.t) for r in spark.read.parquet(path).collect()), key=lambda p: p[0])

    def send(part):
        spark.createDataFrame([(t,) for t in part], "value string").coalesce(1).write.mode("append").text(source)

    send(texts[:3])
    assert len(run()) == 3
    send(texts[3:])
    send(["junk"])
    got = run()
    assert run() == got
    assert got == [(f"E{i}", i * 1000.0) for i in range(6)]


def test_a_repeated_batch_is_written_once(spark):
    path = work_path(spark, "out")
    write = jobs.batch_writer(lambda df: (df, None), path)
    for _ in range(2):
        write(spark.range(5), 0)
    write(spark.range(0), 1)
    assert spark.read.parquet(path).count() == 5


def test_rejects_are_lost_only_on_purpose(spark):
    for drop in (False, True):
        path = work_path(spark, "out")
        write = jobs.batch_writer(lambda df: (df.where("id < 3"), df.where("id >= 3")), path, drop_rejects=drop)
        for _ in range(2):
            write(spark.range(5), 7)
        assert spark.read.parquet(path).count() == 3
        if drop:
            assert not sinks._exists(spark, jobs.rejects_beside(path))
        else:
            assert sorted((r.id, r.batch_id) for r in spark.read.parquet(jobs.rejects_beside(path)).collect()) == [(3, 7), (4, 7)]


def test_a_batch_that_fails_between_its_writes_is_whole_after_a_restart(spark, compiled):
    """The rejects' write fails once, when the good rows are written already."""
    source, path, checkpoint = (work_path(spark, n) for n in ("in", "out", "cp"))
    lines = [(MESSAGE.format(i),) for i in range(4)] + [("junk",)]
    spark.createDataFrame(lines, "value string").coalesce(1).write.text(source)
    failed, seen, write = [], [], jobs._overwrite

    def flaky(df, levels, place):
        if place.endswith(jobs.REJECTS) and not failed:
            failed.append(place)
            raise OSError("no space left")
        write(df, levels, place)

    jobs._overwrite = flaky
    try:
        for _ in range(2):
            query = jobs.stream_frames(
                open_files(spark, source), compiled, path, checkpoint, every=None, zone="UTC", on_batch=lambda n, some: seen.append((n, some))
            )
            try:
                query.awaitTermination()
            except StreamingQueryException:
                assert spark.read.parquet(path).count() == 4 and seen == []
    finally:
        jobs._overwrite = write
    assert (len(failed), seen) == (1, [(0, True)])
    assert sorted(r.ein for r in spark.read.parquet(path).collect()) == [f"E{i}" for i in range(4)]
    assert [(r.text, r.reject_reason) for r in spark.read.parquet(jobs.rejects_beside(path)).collect()] == [("junk", "unreadable message")]


def test_a_batch_is_decoded_once_for_its_rows_and_its_rejects(spark, compiled, monkeypatch):
    plans, write = [], jobs._overwrite

    def noting(df, levels, place):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        write(df, levels, place)

    monkeypatch.setattr(jobs, "_overwrite", noting)
    good = '[{"ein":"E","vin":"V","time":1700000000000,"message":[{"pid":"S1","value":"1"}]},null,{"vin":"V"}]'
    for start, lines, rejects in (
        (jobs.stream_frames, [MESSAGE.format(1), "junk"], ["junk"]),
        (jobs.stream_signals, [good, "junk", "[]"], [good, "junk", '{"vin":"V"}']),
    ):
        source, path, checkpoint = (work_path(spark, n) for n in ("in", "out", "cp"))
        spark.createDataFrame([(t,) for t in lines], "value string").coalesce(1).write.text(source)
        start(open_files(spark, source), compiled, path, checkpoint, every=None, zone="UTC").awaitTermination()
        assert [r.t for r in spark.read.parquet(path).collect()] == [1000.0]
        assert sorted(r.text for r in spark.read.parquet(jobs.rejects_beside(path)).collect()) == sorted(rejects)
    assert len(plans) == 4
    for plan in plans:
        above, kept = plan.split("InMemoryRelation", 1)
        assert "from_json" in kept and "from_json" not in above


def test_a_batch_of_empty_lists_counts_as_one(spark, compiled):
    source, path, checkpoint = (work_path(spark, n) for n in ("in", "out", "cp"))
    spark.createDataFrame([("[]",)], "value string").coalesce(1).write.text(source)
    seen = []
    jobs.stream_signals(open_files(spark, source), compiled, path, checkpoint, every=None, on_batch=lambda n, some: seen.append((n, some))).awaitTermination()
    assert seen == [(0, True)]


def test_grouped_stream_works_inside_a_batch(spark, compiled):
    source, path, checkpoint = (work_path(spark, n) for n in ("in", "out", "cp"))
    text = '[{{"ein":"E","vin":"V","time":1700000000000,"lng":"1","lat":"2","message":[{{"pid":"{0}","value":"{1}"}}]}}]'
    for pid, value in (("S1", "1"), ("S2", "x")):
        spark.createDataFrame([(text.format(pid, value),)], "value string").coalesce(1).write.mode("append").text(source)
    for per_trigger, rows in ((1, 2), (2, 1)):
        out, cp = f"{path}{per_trigger}", f"{checkpoint}{per_trigger}"
        jobs.stream_signals(open_files(spark, source, per_trigger), compiled, out, cp, every=None).awaitTermination()
        got = spark.read.parquet(out).collect()
        assert len(got) == rows
        assert {r.t for r in got} | {None} == {1000.0, None}
