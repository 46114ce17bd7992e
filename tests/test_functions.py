from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from telefold.functions import clean, clock, listtext, messages, signals
from telefold.operators import units


def values(df):
    return [tuple(r) for r in df.collect()]


def test_ids_and_names(spark):
    df = spark.createDataFrame([("00A",), ("A0",), ("0",), ("",), (None,)], "e string")
    assert [r[0] for r in values(df.select(clean.strip_one_zero(F.col("e"))))] == ["0A", "A0", "", "", None]
    one = spark.range(1)
    row = one.select(
        clean.snake_name(F.lit("Engine Speed-Max")), clean.series_base(F.lit("D系列")), clean.series_base(F.lit("ET"))
    ).first()
    assert tuple(row) == ("engine_speed_max", "D", "ET")


def test_list_texts(spark):
    row = spark.range(1).select(
        listtext.bracket_items(F.lit("[1.0, val2,3 ]")),
        listtext.quoted_items(F.lit("['a','b c']")),
        listtext.word_items(F.lit("['S1','S2',3.5]")),
        listtext.literal_items(F.lit("['a', 'b']")),
        listtext.literal_items(F.lit("oops")),
        listtext.quote_list(F.array(F.lit("x"), F.lit("y"))),
        listtext.bracket_list(F.array(F.lit(1.5), F.lit(2.0))),
        listtext.split_list(F.lit("a,b,")),
    ).first()
    assert [list(v) if isinstance(v, list) else v for v in row] == [
        ["1.0", "2", "3"], ["a", "b c"], ["S1", "S2", "3.5"], ["a", "b"], [], "['x','y']", "[1.5,2.0]", ["a", "b", ""],
    ]


def test_positions_and_maps(spark):
    df = spark.createDataFrame(
        [(["a", "b", "a"], ["1", "2"])], "c array<string>, v array<string>"
    )
    row = df.select(
        signals.value_at(F.col("c"), F.col("v"), "a"),
        signals.value_at(F.col("c"), F.col("v"), "b"),
        signals.value_at(F.col("c"), F.col("v"), "z"),
        signals.only_known(F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2)), ["b"]),
    ).first()
    assert tuple(row) == ("1", "2", None, {"b": 2})
    items = spark.createDataFrame(
        [([("p", "1"), ("q", "2"), ("p", "3"), (None, "4")],)], "i array<struct<pid:string,value:string>>"
    )
    row = items.select(signals.item_map(F.col("i"), "pid", "value"), signals.pluck(F.col("i"), "pid")).first()
    assert row[0] == {"p": "3", "q": "2"} and row[1] == ["p", "q", "p", None]


def test_slices_match_the_documented_lists(spark):
    spans = [("2022-10-01 10:10:00", "2022-10-01 11:10:00"), ("2022-10-01 23:58:00", "2022-10-02 01:15:00"), ("2022-10-01 00:00:00", "2022-10-03 00:00:00")]
    df = spark.createDataFrame(spans, "a string, b string").select(*[F.to_timestamp_ntz(c).alias(c) for c in "ab"])
    got = [[str(x) for x in r[0]] for r in values(df.select(clock.slice_bounds(F.col("a"), F.col("b"), 1111)))]
    assert [x[11:] for x in got[0]] == ["10:10:00", "10:28:31", "10:47:02", "11:05:33", "11:10:00"]
    assert got[1] == [
        "2022-10-01 23:58:00", "2022-10-02 00:00:00", "2022-10-02 00:16:31", "2022-10-02 00:35:02",
        "2022-10-02 00:53:33", "2022-10-02 01:12:04", "2022-10-02 01:15:00",
    ]
    assert got[2][0] == "2022-10-01 00:00:00" and got[2][-1] == "2022-10-03 00:00:00" and got[2] == sorted(got[2])
    assert "2022-10-02 00:00:00" in got[2]
    assert clock.slice_step(7200) == 3600


def test_every_time_falls_in_the_slice_named_for_it(spark):
    span = spark.createDataFrame([("2022-10-01 23:10:00", "2022-10-02 03:15:00")], "a string, b string").select(
        *[F.to_timestamp_ntz(c).alias(c) for c in "ab"]
    )
    cut = clock.slices(span, "a", "b", 1000)
    times = span.select(F.explode(F.sequence("a", F.col("b") - F.expr("interval 1 second"), F.expr("interval 37 second"))).alias("t"), "a")
    named = times.withColumn("slice_start", clock.slice_of(F.col("t"), F.col("a"), 1000))
    joined = named.join(cut.select("slice_start", "slice_end"), "slice_start", "left")
    assert joined.where("slice_end is null or t < slice_start or t >= slice_end").count() == 0
    assert joined.count() == times.count()


def test_zones(spark):
    row = spark.range(1).select(
        clock.epoch_text(F.lit(1700000000), zone="Asia/Shanghai"),
        clock.text_epoch(F.lit("2023-11-15 06:13:20"), zone="Asia/Shanghai"),
        clock.millis_to_seconds(F.lit(1700000000999)),
        clock.millis_to_seconds(F.lit(-1500)),
        clock.epoch_day(F.lit(1700000000), "Asia/Shanghai").cast("string"),
        F.size(clock.days_between(F.lit("2024-02-28"), F.lit("2024-03-01"))),
        F.size(clock.days_between(F.lit("2024-03-02"), F.lit("2024-03-01"))),
    ).first()
    assert tuple(row) == ("2023-11-15 06:13:20", 1700000000, 1700000000, -1, "2023-11-15", 3, 0)


def test_messages(spark):
    a = '{"ein":"00E","uploadTime":1700000000999,"deviceID":"V","longitude":"1","latitude":"2","items":[{"signalname":"S1","name":"n","value":"3"}]}'
    df = messages.decode_frames(spark.createDataFrame([(a,), ("junk",)], "value string"), zone="UTC")
    good, bad = df.collect()
    assert (good.ein, good.clt_timestamp, good.codes, good.vals, good.corrupt) == ("0E", 1700000000, ["S1"], ["3"], None)
    assert bad.corrupt == "junk" and bad.ein is None
    b = '[{"ein":"E","vin":"V","time":"1700000000999","sn":"T","lng":"1","lat":"2","high":"4","message":[{"pid":"S1","value":"x"}]},{"ein":"F","vin":"V","time":5,"lng":"1","lat":"2"}]'
    rows = messages.signal_rows(spark.createDataFrame([(b,), ("junk",), (None,)], "value string")).collect()
    assert [(r.ein, r.pos, r.pid, r.value) for r in rows] == [
        ("E", 0, "lng", "1"), ("E", 1, "lat", "2"), ("E", 2, "high", "4"), ("E", 3, "S1", "x"),
        ("F", 0, "lng", "1"), ("F", 1, "lat", "2"), ("F", 2, "high", None),
    ]
    assert {r.clt_timestamp for r in rows} == {1700000000, 0}


def test_messages_with_any_time(spark):
    times = {
        "1700000000999": 1700000000, '"1700000000999"': 1700000000, "-1": -1, "0": 0, "3000000000000": 3000000000, '"x"': None, "null": None,
        "100000000000000000": None, "-100000000000000000": None, "1e40": None, "99999999999999999999999": None, "253402300800000": None,
        "253402200000000": 253402200000, "-62135596800000": None, "[1]": None, '{"a":1}': None, "1.5": None, "true": None, '""': None,
    }
    item = '{{"ein":"E","uploadTime":{0},"time":{0},"deviceID":"V","items":[],"message":[]}}'
    texts = spark.createDataFrame([(i, item.format(t)) for i, t in enumerate(times)], "id int, value string")
    frames = messages.decode_frames(texts, zone="Asia/Shanghai").orderBy("id").collect()
    assert [r.clt_timestamp for r in frames] == list(times.values())
    assert all((r.clt_date is None) == (r.clt_timestamp is None) and r.corrupt is None for r in frames)
    lists = texts.withColumn("value", F.format_string("[%s]", "value"))
    toward_zero = {k: 0 if k == "-1" else v for k, v in times.items()}
    got = {r.id: r.clt_timestamp for r in messages.message_frames(lists).collect()}
    assert got == {i: t for i, t in enumerate(toward_zero.values()) if t is not None}
    bad = {r.id: r.reject_reason for r in messages.rejected_messages(lists).collect()}
    assert bad == {i: "no readable time" for i, t in enumerate(times.values()) if t is None}


def test_a_bad_member_costs_only_itself(spark):
    good = '{"ein":"E","time":5,"message":[{"pid":"S","value":"1"}]}'
    texts = [
        f"[{good},7]", f'[{good},"x"]', f"[{good},null]", f"[{good},[{good}]]", f'[{good},{{"ein":"","time":5}}]', f'[{good},{{"time":5}}]',
        f'[{good},{{"ein":"F"}}]', "junk", None, "[]", f"[{good}", good,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, value string")
    assert sorted(r.id for r in messages.message_frames(df).collect()) == [0, 1, 2, 3, 4, 5, 6, 11]
    bad = {r.id: (r.reject_reason, r.text) for r in messages.rejected_messages(df).collect()}
    unreadable = "unreadable message"
    assert bad == {
        0: (unreadable, "7"), 1: (unreadable, "x"), 2: (unreadable, f"[{good},null]"), 3: (unreadable, f"[{good}]"),
        4: ("no engine id", '{"ein":"","time":"5"}'), 5: ("no engine id", '{"time":"5"}'), 6: ("no readable time", '{"ein":"F"}'),
        7: (unreadable, "junk"), 8: (unreadable, None), 10: (unreadable, f"[{good}"),
    }


def test_feature_text(spark):
    texts = ['{"extend":{"type":"calculate","formula":"{a}"}}', '{"extend":{"type":"other","formula":"{a}"}}', "x", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(messages.feature_formula(F.col("t")))
    assert [r[0] for r in df.collect()] == ["{a}", None, None, None]


@pytest.mark.parametrize("legacy", [False, True])
def test_unit_pairs_invert(spark, legacy):
    table = {(r.from_unit, r.to_unit): r.factor for r in units.unit_table(spark, legacy).collect()}
    for (a, b), f in table.items():
        if (b, a) in table and not (legacy and "mg/s" in (a, b)):
            assert abs(f * table[(b, a)] - 1) < 1e-12
    assert table[("cm", "m")] == (1e-3 if legacy else 1e-2)
    assert (("kg/h", "m3/h") in table) is not legacy
    assert ("m", "cm") not in table and ("v", "mv") not in table


def test_attach_factor(spark):
    rows = [("kPa", "HPA"), ("foo", "FOO"), ("foo", "m"), (None, "m"), ("m", None)]
    got = units.attach_factor(spark.createDataFrame(rows, "a string, b string"), "a", "b").collect()
    assert {(r.a, r.b): r.factor for r in got} == {
        ("kPa", "HPA"): 10.0, ("foo", "FOO"): 1.0, ("foo", "m"): None, (None, "m"): None, ("m", None): None,
    }


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_epoch_of_a_stamp(spark, zone):
    texts = ["1969-12-31 23:59:59.5", "0001-01-01 00:00:00.1", "9999-12-31 23:59:59.999999", "2024-03-10 02:30:00.999999", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t").cast("timestamp_ntz").alias("ts"))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = values(df.select(clock.stamp_epoch(F.col("ts")), clock.text_epoch(F.date_format("ts", clock.WALL_FORMAT), zone="UTC")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [a for a, _ in got] == [-1, -62135596800, 253402300799, 1710037800, None] and type(got[0][0]) is int
    # the text of a time that the session's zone leaves out is another
    assert [a == b for a, b in got] == [True, True, True, zone == "UTC", True]
