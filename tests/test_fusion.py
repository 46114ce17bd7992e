"""The edge cases of fusion, one literal frame each."""

from __future__ import annotations

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from suite.fusion import wide_frames
from telefold.functions.clean import number
from telefold.operators import fusion, grouped, mapping as maps

MAPPING = [
    ("t", "m", "S1", "km", 0.0, 100.0, -1.0, 1),
    ("t", "m", "S2", "m", 0.0, 100.0, -2.0, 2),
    ("u", None, "S3", None, None, None, None, 3),
    ("w", "m", "S4", "foo", None, None, None, 4),
]
MAPPING_DDL = "target_name string, target_unit string, signal_name string, signal_unit string, min_val double, max_val double, default_val double, id int"
FRAMES = [
    ("first present", ["S2"], ["5"]),
    ("priority", ["S2", "S1"], ["5", "1"]),
    ("duplicate", ["S1", "S1"], ["1", "2"]),
    ("unequal", ["S1", "S2"], ["7"]),
    ("more values", ["S1"], ["7", "8"]),
    ("out then in", ["S1", "S2"], ["999", "5"]),
    ("all out", ["S1", "S2"], ["999", "888"]),
    ("bad", ["S1"], ["abc"]),
    ("hex", ["S1"], ["1F"]),
    ("last duplicate out", ["S1", "S1"], ["5", "999"]),
    ("null code", [None, "S3"], ["1", 'x"y\\z']),
    ("marked text", ["S3"], ["#1d"]),
    ("null lists", None, None),
    ("null values", ["S1"], None),
    ("empty", [], []),
    ("unknown", ["S9"], ["1"]),
    ("unknown unit", ["S4"], ["3"]),
    ("sent null", ["S1", "S2"], [None, "4"]),
    ("blank", ["S1", "S2"], ["", "4"]),
]
EXPECTED = {
    "first": {
        "first present": (5.0, None, None), "priority": (1000.0, None, None), "duplicate": (2000.0, None, None),
        "unequal": (7000.0, None, None), "more values": (7000.0, None, None), "out then in": (999000.0, None, None),
        "all out": (999000.0, None, None), "bad": (None, None, None), "hex": (None, None, None),
        "last duplicate out": (999000.0, None, None), "null code": (None, 'x"y\\z', None),
        "marked text": (None, "#1d", None), "null lists": (None, None, None), "null values": (None, None, None),
        "empty": (None, None, None), "unknown": (None, None, None), "unknown unit": (None, None, 3.0),
        "sent null": (None, None, None), "blank": (None, None, None),
    },
    "valid": {
        "first present": (5.0, None, None), "priority": (1000.0, None, None), "duplicate": (2000.0, None, None),
        "unequal": (7000.0, None, None), "more values": (7000.0, None, None), "out then in": (5.0, None, None),
        "all out": (-2.0, None, None), "bad": (-1.0, None, None), "hex": (-1.0, None, None),
        "last duplicate out": (-1.0, None, None), "null code": (None, 'x"y\\z', None),
        "marked text": (None, "#1d", None), "null lists": (None, None, None), "null values": (None, None, None),
        "empty": (None, None, None), "unknown": (None, None, None), "unknown unit": (None, None, 3.0),
        "sent null": (4.0, None, None), "blank": (4.0, None, None),
    },
    "last": {
        "first present": (5.0, None, None), "priority": (5.0, None, None), "duplicate": (2000.0, None, None),
        "unequal": (7000.0, None, None), "more values": (7000.0, None, None), "out then in": (5.0, None, None),
        "all out": (888.0, None, None), "bad": (None, None, None), "hex": (None, None, None),
        "last duplicate out": (999000.0, None, None), "null code": (None, 'x"y\\z', None),
        "marked text": (None, "#1d", None), "null lists": (None, None, None), "null values": (None, None, None),
        "empty": (None, None, None), "unknown": (None, None, None), "unknown unit": (None, None, 3.0),
        "sent null": (4.0, None, None), "blank": (4.0, None, None),
    },
}


@pytest.fixture(scope="module")
def compiled(spark):
    return maps.compile_mapping(spark.createDataFrame(MAPPING, MAPPING_DDL), "id")


@pytest.fixture(scope="module")
def frames(spark):
    return spark.createDataFrame(FRAMES, "id string, codes array<string>, vals array<string>")


@pytest.mark.parametrize("looked_up", [64, 0])
@pytest.mark.parametrize("rule", list(EXPECTED))
def test_rules(frames, compiled, rule, looked_up, monkeypatch):
    """The same by map lookup and by struct."""
    monkeypatch.setattr(fusion, "LOOKED_UP", looked_up)
    got = {r.id: (r.t, r.u, r.w) for r in fusion.fuse_frames(frames, compiled, rule).collect()}
    assert got == EXPECTED[rule]


def test_bad_number_options(frames, compiled):
    default = {r.id: r.t for r in fusion.fuse_frames(frames, compiled, on_bad_number="default").collect()}
    assert default["bad"] == -999.0 and default["sent null"] is None and default["duplicate"] == 2000.0
    rows = fusion.fuse_frames(frames, compiled, on_bad_number="reject").collect()
    assert {r.id: r.bad_targets for r in rows if r.bad_targets} == {"bad": ["t"], "hex": ["t"], "blank": ["t"]}
    assert all(r.t is None for r in rows if r.bad_targets)


def test_first_of_duplicates(frames, compiled):
    got = {r.id: r.t for r in fusion.fuse_frames(frames, compiled, duplicates="first").collect()}
    assert got["duplicate"] == 1000.0


def test_decimal_does_not_fail_on_overflow(spark, compiled):
    df = spark.createDataFrame([(["S1"], ["1e30"]), (["S1"], ["0.5"])], "codes array<string>, vals array<string>")
    got = [r.t for r in fusion.fuse_frames(df, compiled, number_type="decimal(20,7)").collect()]
    assert got[0] is None and float(got[1]) == 500.0


def test_one_row_per_frame_and_no_shuffle(frames, compiled):
    fused = fusion.fuse_frames(frames, maps.read_targets(compiled))
    assert fused.count() == len(FRAMES)
    plan = fused._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_filter_on_a_target_does_not_copy_the_rekeying(frames, compiled, monkeypatch):
    plan = _filtered_plan(frames, compiled)
    assert plan.count("map_from_arrays") == 1
    monkeypatch.setattr(fusion, "LOOKED_UP", 0)
    plan = _filtered_plan(frames, compiled)
    assert plan.count("map_from_arrays") == 1 and plan.count("from_json") == 1


def test_few_codes_are_looked_up_once_and_no_lambda_makes_keys(frames, compiled):
    plan = fusion.fuse_frames(frames, maps.read_targets(compiled))._jdf.queryExecution().optimizedPlan().toString()
    assert "transform_keys" not in plan and plan.count("map_from_arrays") == 1 and plan.count("element_at") == 4


@pytest.mark.parametrize("duplicates", ["first", "last"])
@pytest.mark.parametrize("rule", list(EXPECTED))
def test_places_of_few_codes_hold_what_the_map_does(spark, compiled, rule, duplicates, monkeypatch):
    codes, values = (None, "", "S1", "S2", "S3", "s1"), (None, "", "1", "2d", "#3", "#", "\u0000", "x")
    dealt = random.Random(7)
    rows = [(i, [dealt.choice(codes) for _ in range(dealt.randrange(6))], [dealt.choice(values) for _ in range(dealt.randrange(6))]) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, codes array<string>, vals array<string>")
    placed, looked_up = [], []
    for most, found in ((fusion.COMPILED, placed), (0, looked_up)):
        monkeypatch.setattr(fusion, "COMPILED", most)
        found += sorted(fusion.fuse_frames(df, compiled, rule, duplicates=duplicates).collect())
    assert placed == looked_up and len(placed) == 300


def test_code_that_is_empty_is_sent_by_null(spark):
    rows = [("t", None, "", "-", None, None, None, 1)]
    targets = maps.read_targets(maps.compile_mapping(spark.createDataFrame(rows, MAPPING_DDL), "id"))
    df = spark.createDataFrame([([None, "a"], ["1", "2"]), (["a", ""], ["1", "2"])], "codes array<string>, vals array<string>")
    assert sorted(r.t for r in fusion.fuse_frames(df, targets).collect()) == ["1", "2"]


def _filtered_plan(frames, compiled):
    fused = fusion.fuse_frames(frames, maps.read_targets(compiled)).where("t > 1 and w is null")
    return fused._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("others", [0, 100])
def test_codes_differing_in_case(spark, others):
    rows = [("t", "m", "s1", "m", None, None, None, 1), ("t", "m", "S1", "m", None, None, None, 2)]
    rows += [(f"o{i}", "m", f"o{i}", "m", None, None, None, 3) for i in range(others)]
    targets = maps.read_targets(maps.compile_mapping(spark.createDataFrame(rows, MAPPING_DDL), "id"))
    df = spark.createDataFrame([(["S1", "o5"], ["1", "7"]), (["S1", "s1"], ["1", "2"])], "codes array<string>, vals array<string>")
    fused = fusion.fuse_frames(df, targets)
    assert sorted(r.t for r in fused.collect()) == [1.0, 2.0]
    if others:
        assert {r.o5 for r in fused.collect()} == {7.0, None}


def test_tall_forms_agree_with_the_frame_form(frames, compiled):
    tall = fusion.explode_signals(frames, ["id"]).withColumn("pos", F.lit(1))
    again = fusion.fuse_frames(grouped.gather_frames(tall, compiled, ["id"], ["pos"]), compiled)
    want = {k: v for k, v in EXPECTED["first"].items() if any(f[0] == k and f[1] and f[2] for f in FRAMES)}
    assert {r.id: (r.t, r.u, r.w) for r in again.collect()} == want


def test_grouped_takes_the_first_arrival(spark, compiled):
    rows = [
        ("e", 1, 3, "S1", "1", "late"), ("e", 1, 2, "S2", "5", None), ("e", 1, 1, "S9", "0", None),
        ("f", 1, 1, "S9", "0", "only"), ("g", 1, 1, "S1", "x", "v"), ("g", 1, 2, "S3", "text", "v"),
    ]
    tall = spark.createDataFrame(rows, "ein string, clt_timestamp int, pos int, pid string, value string, vin string")
    scaling = spark.createDataFrame([("S2", 2.0, 1.0)], "pid string, multiplier double, offset double")
    got = {r.ein: (r.vin, r.t, r.u) for r in grouped.fuse_grouped(tall, compiled, scaling=scaling).collect()}
    assert got == {"e": ("late", 11.0, None), "f": ("only", None, None), "g": ("v", None, "text")}


def test_grouped_combines_before_its_shuffles(spark, compiled):
    tall = spark.range(100).selectExpr(
        "'e' AS ein", "1 AS clt_timestamp", "id AS pos", "'S1' AS pid", "string(id) AS value", "'v' AS vin"
    )
    plan = grouped.fuse_grouped(tall, compiled)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_min_by") == 1 and "partial_min(" in plan


def test_rows_that_add_nothing_are_left_out_before_the_sort(spark, compiled, monkeypatch):
    """Frames of three rows; the mapping names a platform for a code without a target, whose row is kept."""
    rows = [(e, 1, 10 * f + p, pid, "2", None if f == 0 else f"v{f}") for e in "abc" for f in range(3) for p, pid in enumerate(("lng", "X", {"a": "S1", "b": "P"}.get(e)))]
    tall = spark.createDataFrame(rows, "ein string, clt_timestamp int, pos int, pid string, value string, vin string")
    named = compiled.withColumn("platname", F.lit(None).cast("string")).unionByName(
        spark.createDataFrame([("P", "p")], "signal_name string, platname string"), allowMissingColumns=True
    )
    whole = dict(ids=("vin", "platname"), targets=maps.list_targets(compiled))
    less = grouped.fuse_grouped(tall, named, opening=F.col("pos") % 10 == 0, **whole)
    want = sorted(map(repr, grouped.fuse_grouped(tall, named, **whole).collect()))
    assert {(r.ein, r.vin, r.platname, r.t) for r in less.collect()} == {("a", "v1", None, 2.0 * 1000), ("b", "v1", "p", None), ("c", "v1", None, None)}
    assert sorted(map(repr, less.collect())) == want
    monkeypatch.setattr(grouped, "LOOKED_UP", 0)
    many = grouped.fuse_grouped(tall, named, **whole)
    assert "from_json" in many._jdf.queryExecution().optimizedPlan().toString() and "from_json" not in less._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(repr, many.collect())) == want


def test_metadata_of_known_size(spark, compiled):
    found = maps.sized(spark.range(3))
    assert found.count() == 3 and found.inputFiles()
    assert [(t.name, t.is_text) for t in maps.list_targets(compiled)] == [("t", False), ("u", True), ("w", False)]


def test_series_use_their_own_mapping(spark):
    one = [("t", "m", "S1", "km", None, None, None, 1)]
    two = [("t", "m", "S1", "cm", None, None, None, 1), ("u", None, "S3", None, None, None, None, 2)]
    mappings = {
        name: maps.compile_mapping(spark.createDataFrame(rows, MAPPING_DDL), "id")
        for name, rows in (("D", one), ("H系列", two))
    }
    df = spark.createDataFrame(
        [("D系列", ["S1", "S3"], ["1", "a"]), ("H", ["S1", "S3"], ["1", "a"]), ("X", ["S1"], ["1"])],
        "hos_series string, codes array<string>, vals array<string>",
    )
    got = {r.hos_series: (r.t, r.u) for r in fusion.fuse_by_series(df, mappings).collect()}
    assert got == {"D系列": (1000.0, None), "H": (0.01, "a"), "X": (None, None)}


CODES = ["S1", "S2", "S4", "S9"]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(CODES), st.sampled_from(["1", "50", "400", "x", ""])), max_size=4, unique_by=lambda p: p[0]), st.integers(0, 99))
def test_order_of_distinct_signals_does_not_matter(spark, compiled, pairs, seed):
    mixed = list(pairs)
    random.Random(seed).shuffle(mixed)
    rows = [([c for c, _ in p], [v for _, v in p]) for p in (pairs, mixed)]
    df = spark.createDataFrame(rows, "codes array<string>, vals array<string>")
    for rule in EXPECTED:
        a, b = fusion.fuse_frames(df, compiled, rule).collect()
        assert a == b


def test_number_reading(spark):
    texts = ["1", " 2.5 ", "1e3", "-3", "", " ", "abc", "1F", "2d", "0x1", None, "1,5"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(number(F.col("t")).alias("n"))
    got = [r.n for r in df.collect()]
    assert got[:4] == [1.0, 2.5, 1000.0, -3.0] and all(v is None for v in got[4:])


def test_formula(spark):
    from telefold.functions.formula import compile_formula, formula_value, operands

    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (None, 1.0), (8.0, 0.001)], "a double, b double")
    text = "{a} / ({b} * (273 + {a}))"
    assert operands(text) == ["a", "b"]
    value = formula_value(text, F.col, 0.0, 1.0, -999.0)
    got = [r.v for r in df.select(value.alias("v")).collect()]
    assert math.isclose(got[0], 1 / (2 * 274)) and got[1:] == [-999.0, -999.0, -999.0]
    half = df.select(compile_formula("-{a} ** 2 + 3 - -1", F.col).alias("v")).first().v
    assert half == 3.0
    for text in ("__import__('os')", "{a}.real", "{a} if {b} else 1", "{a} +", "'x'", "{a} // 2", "v0 + v9"):
        with pytest.raises((ValueError, IndexError)):
            compile_formula(text, F.col)


def test_formula_must_read_known_targets(frames, spark):
    rows = [("t", "m", "S1", "m", None, None, -9.0, '{"extend":{"type":"calculate","formula":"{nope} + 1"}}', 1)]
    ddl = MAPPING_DDL.replace("id int", "extend_feature string, id int")
    compiled = maps.compile_mapping(spark.createDataFrame(rows, ddl), "id")
    with pytest.raises(ValueError, match="nope"):
        fusion.fuse_frames(frames, compiled, formulas=True)


def test_many_codes_are_placed_without_json(spark):
    """Seventy codes: repeated ones, lists that are NULL, empty or of unequal length, NULL codes and values, texts that
    the JVM would take for numbers; each of them as the frame's map would give it."""
    rows = [(f"t{i}", "m", f"c{i}", "m", i) for i in range(68)] + [("blank", "m", "", "m", 68), ("word", None, "w", None, 69)]
    compiled = maps.compile_mapping(
        spark.createDataFrame(rows, "target_name string, target_unit string, signal_name string, signal_unit string, id int"), "id"
    )
    sent = spark.createDataFrame(
        [
            (1, ["c3", "x", "c67", "c3"], ["1", "2", "7.5", "4"]),
            (2, None, ["1"]),
            (3, [], []),
            (4, ["c1", "c2", "w"], ["5", None]),
            (5, [None, "w", "c0"], ["8", "#12f", "20d"]),
            (6, ["w", "c5"], ["7d", " 3 "]),
        ],
        "id int, codes array<string>, vals array<string>",
    )
    for duplicates, third in (("last", 4.0), ("first", 1.0)):
        fused = fusion.fuse_frames(sent, compiled, duplicates=duplicates)
        got = {r.id: {k: v for k, v in r.asDict().items() if v is not None and k != "id"} for r in fused.collect()}
        assert got == {1: {"t3": third, "t67": 7.5}, 2: {}, 3: {}, 4: {"t1": 5.0}, 5: {"blank": 8.0, "word": "#12f"}, 6: {"word": "7d", "t5": 3.0}}
        plan = fused.where("t3 > 1 AND t5 > 2 AND t67 > 3")._jdf.queryExecution().optimizedPlan().toString()
        assert "from_json" not in plan and plan.count("place(") == 1


ODD_VALUES = (
    "1", "-2.5", "", None, "\u0000", "x", "1F", "20d", "inf", "-Infinity", "+nan", "NaN", "-NaN", " 3 ", "\t4\n", "+5", "1e400", "1e-400", "0x1p3", "0x1p3 d",
    "1e", ".", "-.5e1", "7.", "1e+2", "2024-01-01", "#3", "8\u001f", "\u001f", "1d ", "INFINITY", "-0", "1,5", "٣", "9" * 120, "é", "1_0",
)


@pytest.mark.parametrize("bad", ["null", "default", "reject"])
@pytest.mark.parametrize("duplicates", ["first", "last"])
def test_numbers_of_many_codes_are_picked_as_the_map_gives_them(spark, bad, duplicates, monkeypatch):
    """A code feeds up to three targets, a target has up to three codes; members hold the mark that ends members."""
    codes = [f"c{i}" for i in range(70)] + ["", "\u001f", "c\u001f1"]
    rows = [(f"t{i}", "m", codes[(i + 5 * k) % 73], "km" if k else "m", k) for i in range(73) for k in range(1 + i % 3)]
    rows += [("again", "m", "c1", "m", 0), ("word", None, "c2", None, 0), ("word", None, "\u001f", None, 1)]
    targets = maps.read_targets(
        maps.compile_mapping(spark.createDataFrame(rows, "target_name string, target_unit string, signal_name string, signal_unit string, id int"), "id")
    )
    dealt = random.Random(3)
    sent = [(i, [dealt.choice([None, "other", *codes]) for _ in range(dealt.randrange(40))], [dealt.choice(ODD_VALUES if i % 3 else ("1", "2.5", "-3e2")) for _ in range(dealt.randrange(40))]) for i in range(240)]
    sent += [(240, None, ["1"]), (241, ["c1"], None), (242, [], []), (243, ["c1", "c2"], ["1", "8\u001f"])]
    frames = spark.createDataFrame(sent, "id int, codes array<string>, vals array<string>")
    for some in (targets, [t for t in targets if not t.is_text]):
        picked = fusion.fuse_frames(frames, some, on_bad_number=bad, duplicates=duplicates)
        assert picked._jdf.queryExecution().optimizedPlan().toString().count("pick(") == 1
        with monkeypatch.context() as m:
            m.setattr(fusion, "READ_AS_JSON", 1000)
            read = sorted(fusion.fuse_frames(frames, some, on_bad_number=bad, duplicates=duplicates).collect(), key=lambda r: r.id)
        assert [repr(r) for r in sorted(picked.collect(), key=lambda r: r.id)] == [repr(r) for r in read] and len(read) == 244


def test_numbers_of_many_codes_come_as_numbers(spark):
    """Not as one text for each code, each to be read for each target."""
    rows = [(f"t{i}", "m", f"c{i}", "m", i) for i in range(70)]
    targets = maps.read_targets(
        maps.compile_mapping(spark.createDataFrame(rows, "target_name string, target_unit string, signal_name string, signal_unit string, id int"), "id")
    )
    frames = spark.createDataFrame([(["c1"], ["4"])], "codes array<string>, vals array<string>")
    fused = fusion.fuse_frames(frames, targets)
    plan = fused.where("t1 > 3 AND t5 IS NULL")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("pick(") == 1 and "place(" not in plan and "try_cast" not in plan.lower()
    assert [(r.t1, r.t2) for r in fused.collect()] == [(4.0, None)]


def test_values_of_wide_frames(spark, tmp_path):
    bases = [0, 1, 885, 886, 999, 1000, 123456, -1, -57, -114, -115, -900, -998, -999, -1000, -1001, -1113, -2000, -98765]
    keys = spark.createDataFrame([(0, i, b, 1) for i, b in enumerate(bases)] + [(0, 99, None, 1)], "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long")
    keys.write.parquet(str(tmp_path / "lineitem.parquet"))
    got = {r.l_linenumber: r.vals for r in wide_frames(spark, str(tmp_path)).collect()}
    values = F.transform(F.sequence(F.col("l_partkey") + 1, F.col("l_partkey") + 114), lambda x: (x % 1000 / F.lit(10.0)).cast("string"))
    want = {r.l_linenumber: r.v or [None] * 114 for r in keys.select("l_linenumber", values.alias("v")).collect()}
    assert got == want
