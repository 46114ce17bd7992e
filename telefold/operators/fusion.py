"""Fusion of frames: from two parallel lists to one column per target.

A frame is one row, so fusion needs no shuffle: the row's lists are re-keyed by code and every target
is a CASE over its signals. The job stays map-only whatever the data's size, and a vehicle that sends a
third of all frames is just many rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from telefold.functions.clean import BAD_NUMBER, series_base
from telefold.functions.formula import formula_value, operands
from telefold.functions.signals import (
    HANDED,
    SENT_NULL,
    handed,
    kept_value,
    picker,
    placer,
    plain_map,
    quoted,
    sent_number_sql,
    sent_text,
    sent_text_sql,
    signal_map,
)
from telefold.operators.mapping import Signal, Target, read_targets
from telefold.session import keep_last_key

RULES = ("first", "valid", "last")
INF = float("inf")

#: Up to that many codes, looking each one up in the map is cheaper than placing all of them.
LOOKED_UP = 64

#: Up to that many codes, each one is looked up once, in compiled projections, and read by its place. More would make a
#: method that the JVM doesn't compile.
COMPILED = 8

#: Beyond that many codes they are placed over Arrow batches, in Python workers; up to it by reading the map as JSON. Where
#: executors have no pyarrow it can be raised.
READ_AS_JSON = 64


def sent_key(code: str) -> str:
    return code.encode().hex().upper()


def _wanted(targets: list[Target]) -> list[str]:
    return sorted({s.code for t in targets for s in t.signals})


def _batched(wanted: list[str]) -> bool:
    return len(wanted) > max(LOOKED_UP, READ_AS_JSON)


def _compiled(wanted: list[str]) -> bool:
    return len(wanted) <= min(LOOKED_UP, COMPILED)


def sent_at(targets: list[Target]) -> dict[str, str]:
    """For each code that targets read, the SQL expression of what was sent of it, or NULL, over ``with_signals``."""
    wanted = _wanted(targets)
    if _batched(wanted) or _compiled(wanted):
        return {c: f"_signals[{i}]" for i, c in enumerate(wanted)}
    return {c: f"_signals[{quoted(sent_key(c))}]" for c in wanted}


def with_signals(frames: DataFrame, kept: list, targets: list[Target], codes: str, values: str, first: bool = False) -> DataFrame:
    """The ``kept`` columns and ``_signals``, which ``sent_at`` reads.

    Very few codes are looked up once each in the frame's map and placed into a list with one place per code, in
    projections that Spark compiles. A few more are looked up wherever they are read, which scans the map; more are
    placed once into a struct with one field per code, by reading the map as JSON under that schema. Keys and fields are the codes' bytes in hexadecimal, so both tell codes apart that differ only in case.
    Many are placed into a list batch by batch of frames (``signals.placer``), without a map or JSON text.

    The column goes through a one-element generator. A filter or a second use of a target above it then
    reads the finished column; through a plain projection the optimizer would copy the whole re-keying
    into the filter, once per code.
    """
    wanted = _wanted(targets)
    if _batched(wanted):
        sent = placer(wanted, first)(F.col(codes).cast("array<string>"), F.col(values).cast("array<string>"))
    elif _compiled(wanted):
        frames = frames.select(*kept, plain_map(F.col(codes), F.col(values), first).alias("_signals_map"))
        kept, found = frames.columns[:-1], F.col("_signals_map")
        looked_up = [F.element_at(found, F.lit(c)).alias(f"_signals_{i}") for i, c in enumerate(wanted)]
        # the lambda keeps this projection out of the compiled method of those above it, which must stay short
        frames = frames.select(*kept, *looked_up, F.map_filter(found, lambda _, value: value.isNull()).alias("_signals_null"))
        places = [kept_value(F.col(f"_signals_{i}"), F.map_contains_key("_signals_null", F.lit(c))) for i, c in enumerate(wanted)]
        frames = frames.select(*kept, F.array(*places).cast("array<string>").alias("_signals_placed"))
        sent = F.col("_signals_placed")
    else:
        sent = F.transform_keys(signal_map(F.col(codes), F.col(values), first), lambda code, _: F.hex(code))
        if len(wanted) > LOOKED_UP:
            schema = T.StructType([T.StructField(sent_key(c), T.StringType()) for c in wanted])
            sent = F.from_json(F.to_json(sent), schema)
    return frames.select(*kept, F.explode_outer(F.array(sent)).alias("_signals"))


def with_numbers(frames: DataFrame, kept: list, targets: list[Target], codes: str, values: str, first: bool, bad: float | None) -> tuple[DataFrame, dict[str, str]]:
    """The ``kept`` columns and ``_signals``, and for each target the SQL expression of its value under the rule ``first`` over it.

    For many codes: numbers are picked and read batch by batch of frames (``signals.picker``), one for each target instead of
    a text for each code; what text targets read is placed as ``with_signals`` does.
    """
    numeric, texts = [t for t in targets if not t.is_text], [t for t in targets if t.is_text]
    frames = handed(frames, kept, codes, values, bool(texts))
    sent, numbers = picker([[(s.code, s.factor) for s in t.signals] for t in numeric], first, bad)(*HANDED), "_signals"
    if texts:
        sent, numbers = F.struct(sent.alias("numbers"), placer(_wanted(texts), first)("_codes", "_values").alias("texts")), "_signals.numbers"
    at = {c: f"_signals.texts[{i}]" for i, c in enumerate(_wanted(texts))}
    found = {t.name: f"{numbers}[{i}]" for i, t in enumerate(numeric)}
    found |= {t.name: _case(_first_present(t, at, bad)) for t in texts}
    return frames.select(*kept, F.explode_outer(F.array(sent)).alias("_signals")), found


# A target is one SQL CASE. With hundreds of targets this builds the plan in a fraction of the time that
# many small Column calls take, which counts when a stream builds it for every batch.

def _double(value: float | None) -> str:
    if value is None:
        return "CAST(NULL AS DOUBLE)"
    return f"CAST('{value}' AS DOUBLE)" if value != value or value in (INF, -INF) else f"{float(value)!r}D"


def _read(sent: str) -> str:
    return sent_number_sql(sent)


def _converted(signal: Signal, sent: str) -> str:
    value = _read(sent)
    return value if signal.factor in (None, 1.0) else f"{value} * {_double(signal.factor)}"


def _first_present(target: Target, sent: dict[str, str], bad: float | None) -> list[tuple[str, str]]:
    branches = []
    for s in target.signals:
        at = sent[s.code]
        if target.is_text:
            value = sent_text_sql(at)
        elif bad is None:
            value = _converted(s, at)
        else:
            value = f"IF({at} <> {quoted(SENT_NULL)}, coalesce({_converted(s, at)}, {_double(bad)}), NULL)"
        branches.append((f"{at} IS NOT NULL", value))
    return branches


def _first_valid(target: Target, sent: dict[str, str]) -> list[tuple[str, str]]:
    if target.is_text:
        return _first_present(target, sent, None)
    branches = []
    for s in target.signals:
        at = sent[s.code]
        bounds = [f"{_read(at)} >= {_double(s.low)}"] if s.low is not None else []
        bounds += [f"{_read(at)} <= {_double(s.high)}"] if s.high is not None else []
        branches.append((" AND ".join(bounds) or f"{_read(at)} IS NOT NULL", _converted(s, at)))
    defaults = [(f"{sent[s.code]} IS NOT NULL", _double(s.default)) for s in reversed(target.signals)]
    return branches + defaults


def _last_present(target: Target, sent: dict[str, str]) -> list[tuple[str, str]]:
    branches = []
    for s in reversed(target.signals):
        at = sent[s.code]
        if target.is_text:
            branches.append((f"{at} IS NOT NULL", sent_text_sql(at)))
        else:
            branches.append((f"{at} NOT IN ('', {quoted(SENT_NULL)})", _converted(s, at)))
    return branches


def _case(branches: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN {test} THEN {value}" for test, value in branches) + " END"


def fuse_frames(
    frames: DataFrame,
    mapping: DataFrame | list[Target],
    rule: str = "first",
    codes: str = "codes",
    values: str = "vals",
    on_bad_number: str = "null",
    duplicates: str = "last",
    round_to: int | None = None,
    number_type: str = "double",
    formulas: bool = False,
) -> DataFrame:
    """One output row per frame: its other columns, then one column per target.

    ``rule``: ``first`` present signal in priority order; ``valid``: the first whose raw value is in
    range, else the default of the last one sent; ``last`` present signal.
    ``on_bad_number`` (rule ``first``): ``null``, ``default`` (-999), or ``reject``, which adds
    ``bad_targets``, the targets whose chosen signal could not be read.
    ``duplicates``: which value of a code sent twice counts.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    if on_bad_number not in ("null", "default", "reject"):
        raise ValueError("on_bad_number must be null, default or reject")
    targets = mapping if isinstance(mapping, list) else read_targets(mapping)
    return _fuse(
        frames, [(None, targets)], rule, codes, values, on_bad_number, duplicates, round_to, number_type, formulas
    )


def fuse_by_series(
    frames: DataFrame,
    mappings: dict[str, DataFrame | list[Target]],
    series: str = "hos_series",
    rule: str = "first",
    codes: str = "codes",
    values: str = "vals",
    on_bad_number: str = "null",
    duplicates: str = "last",
    round_to: int | None = None,
    number_type: str = "double",
    formulas: bool = False,
) -> DataFrame:
    """Frames of several vehicle series in one pass, each fused by its own series' mapping.

    Frames of a series without a mapping get no values; a target only other series have is NULL.
    """
    variants = [
        (
            series_base(F.col(series)) == name.removesuffix("系列"),
            m if isinstance(m, list) else read_targets(m),
        )
        for name, m in mappings.items()
    ]
    return _fuse(
        frames, variants, rule, codes, values, on_bad_number, duplicates, round_to, number_type, formulas
    )


def _fuse(
    frames: DataFrame,
    variants: list[tuple[Column | None, list[Target]]],
    rule: str,
    codes: str,
    values: str,
    on_bad_number: str,
    duplicates: str,
    round_to: int | None,
    number_type: str,
    formulas: bool,
) -> DataFrame:
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    if on_bad_number not in ("null", "default", "reject"):
        raise ValueError("on_bad_number must be null, default or reject")
    keep_last_key(frames.sparkSession)
    everything = [t for _, targets in variants for t in targets]
    texts = {t.name: t.is_text for t in everything}
    if any(texts[t.name] != t.is_text for t in everything):
        raise ValueError("a target must have a unit in all series or in none")
    kept = [c for c in frames.columns if c not in (codes, values)]
    # A series test may read any input column, so it is settled before the lists are re-keyed.
    tests = {f"_is{i}": test for i, (test, _) in enumerate(variants) if test is not None}
    first = duplicates == "first"
    columns = [*kept, *[t.alias(n) for n, t in tests.items()]]
    bad = {"default": BAD_NUMBER, "reject": float("nan")}.get(on_bad_number)
    picked: dict[str, str] = {}
    if rule == "first" and not tests and not all(texts.values()) and _batched(_wanted(everything)):
        keyed, picked = with_numbers(frames, columns, everything, codes, values, first, bad)
    else:
        keyed = with_signals(frames, columns, everything, codes, values, first)
        sent = sent_at(everything)

    def fused(t: Target) -> str:
        if picked:
            return picked[t.name]
        if rule == "first":
            return _case(_first_present(t, sent, bad))
        return _case(_first_valid(t, sent) if rule == "valid" else _last_present(t, sent))

    def value(name: str) -> Column:
        mine = [(i, test, t) for i, (test, targets) in enumerate(variants) for t in targets if t.name == name]
        if mine[0][1] is None:
            return F.expr(fused(mine[0][2]))
        return F.expr(_case([(f"_is{i}", fused(t)) for i, _, t in mine]))

    wide = keyed.select(*kept, *tests, *[value(n).alias(n) for n in texts])
    numeric = [n for n, is_text in texts.items() if not is_text]
    if on_bad_number == "reject" and rule == "first":
        flags = F.filter(
            F.array(*[F.when(F.isnan(F.col(f"`{n}`")), F.lit(n)) for n in numeric]),
            lambda x: x.isNotNull(),
        )
        wide = wide.withColumn("bad_targets", flags).withColumns(
            {n: F.nanvl(F.col(f"`{n}`"), F.lit(None).cast("double")) for n in numeric}
        )
    if round_to is not None:
        wide = wide.withColumns({n: F.round(F.col(f"`{n}`"), round_to) for n in numeric})
    if formulas:
        for i, (test, targets) in enumerate(variants):
            wide = add_formulas(wide, targets, None if test is None else F.col(f"_is{i}"))
    if number_type != "double":
        wide = wide.withColumns({n: F.col(f"`{n}`").try_cast(number_type) for n in numeric})
    return wide.drop(*tests)


def add_formulas(fused: DataFrame, targets: list[Target], only: Column | None = None) -> DataFrame:
    """Sets formula targets from the fused ones. A formula reads fused values, never other formulas."""
    made = {}
    for t in targets:
        if t.formula is None:
            continue
        missing = [n for n in operands(t.formula) if n not in fused.columns]
        if missing:
            raise ValueError(f"formula of {t.name} reads unknown targets {missing}")
        value = formula_value(
            t.formula, lambda n: F.col(f"`{n}`").cast("double"), t.low, t.high, t.default
        )
        made[t.name] = value if only is None else F.when(only, value).otherwise(F.col(f"`{t.name}`"))
    return fused.withColumns(made) if made else fused


def explode_signals(frames: DataFrame, keys: list[str], codes: str = "codes", values: str = "vals") -> DataFrame:
    """Tall form ``keys, pid, value``, one row per code a frame sent (its last value)."""
    keep_last_key(frames.sparkSession)
    signals = signal_map(F.col(codes), F.col(values))
    return (
        frames.select(*keys, F.explode(signals).alias("pid", "value"))
        .where(F.col("pid") != "")
        .withColumn("value", sent_text(F.col("value")))
    )
