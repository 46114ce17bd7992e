"""Mapping metadata: which signals feed which target, in which units, with which limits."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from telefold.functions.clean import clean_unit
from telefold.functions.messages import feature_formula
from telefold.operators.units import attach_factor
from telefold.session import written

#: Targets copied from the frame itself, never from a signal.
FRAME_TARGETS = ("lng", "lat")

# Headings of the mapping sheet and the columns they become.
SHEET_COLUMNS: dict[str, str] = {
    "目标英文字段": "target_name",
    "目标中文名": "target_desc",
    "目标单位": "target_unit",
    "信号": "signal_code",
    "单位": "signal_unit",
    "精度(*系数)": "multiplier",
    "偏移量(±数值)": "offset",
}

# Key columns of the fused table, with SQL types.
KEY_COLUMNS: list[tuple[str, str]] = [
    ("vin", "STRING"),
    ("ein", "STRING"),
    ("data_source", "STRING"),
    ("data_type", "STRING"),
    ("clt_timestamp", "BIGINT"),
    ("clt_time", "STRING"),
    ("clt_date", "STRING"),
    ("hos_series", "STRING"),
    ("hos_mat_id", "STRING"),
    ("extend_feature", "STRING"),
    ("is_delete", "STRING"),
    ("create_time", "TIMESTAMP"),
    ("update_time", "TIMESTAMP"),
    ("lng", "DOUBLE"),
    ("lat", "DOUBLE"),
    ("high", "DOUBLE"),
]


# ---------------------------------------------------------------- unpacking

def unpack_mapping(df: DataFrame, code: str = "signal_code", unit: str = "signal_unit") -> DataFrame:
    """Packed ``S1;S2`` / ``km;m`` lists to one row per signal.

    Adds ``signal_name``, ``signal_unit``, ``place`` (0-based) and ``reason``: a row whose two lists
    differ in length is kept, whole and unexploded, with a reason.
    """
    codes, units = F.split(code, ";"), F.split(unit, ";")
    fits = F.col(unit).isNull() | (F.size(codes) == F.size(units))
    no_unit = F.transform(codes, lambda _: F.lit(None).cast("string"))
    pairs = F.arrays_zip(codes.alias("code"), F.coalesce(units, no_unit).alias("unit"))
    broken = F.array(F.struct(F.col(code).alias("code"), F.col(unit).alias("unit")))
    kept = [c for c in df.columns if c not in (code, unit)]
    return (
        df.where(F.col(code).isNotNull())
        .withColumn("_fits", fits)
        .select(*kept, "_fits", F.posexplode(F.when(F.col("_fits"), pairs).otherwise(broken)).alias("place", "_p"))
        .select(
            *kept,
            "place",
            F.col("_p").getField("code").alias("signal_name"),
            F.col("_p").getField("unit").alias("signal_unit"),
            F.when(~F.col("_fits"), F.lit("signal and unit lists differ in length")).alias("reason"),
        )
    )


def split_rows(df: DataFrame, packed: str, name: str, separator: str = "、") -> DataFrame:
    """One row per member of a separated list; NULL and ``/`` mean "no signal" and give no row."""
    kept = [c for c in df.columns if c != packed]
    return df.where(F.col(packed).isNotNull() & (F.col(packed) != "/")).select(
        *kept, F.explode(F.split(packed, separator)).alias(name)
    )


def zip_rows(df: DataFrame, left: str, right: str, separator: str = ";") -> DataFrame:
    """Two parallel lists to rows, cut to the shorter one; rows with a blank right member go."""
    a, b = F.split(left, separator), F.split(right, separator)
    n = F.least(F.size(a), F.size(b))
    kept = [c for c in df.columns if c not in (left, right)]
    pairs = F.arrays_zip(F.slice(a, F.lit(1), n).alias("a"), F.slice(b, F.lit(1), n).alias("b"))
    return (
        df.where(F.col(left).isNotNull() & F.col(right).isNotNull())
        .select(*kept, F.explode(pairs).alias("_p"))
        .select(*kept, F.col("_p").getField("a").alias(left), F.col("_p").getField("b").alias(right))
        .where(F.col(right) != "")
    )


# ---------------------------------------------------------------- compiling

_OPTIONAL = {
    "min_val": "double",
    "max_val": "double",
    "default_val": "double",
    "extend_feature": "string",
    "signal_type": "string",
}


def compile_mapping(df: DataFrame, order: str | list[str] | None = None, legacy: bool = False) -> DataFrame:
    """Normalised mapping rows with priority, conversion factor, type and formula attached.

    ``order`` gives the configured order of a target's signals (a row id, or ``place`` of an unpacked
    list); without it signals go by name. A signal without a way to convert is passed through and has
    ``convertible`` false.
    """
    for name, kind in _OPTIONAL.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(kind))
    by = [order] if isinstance(order, str) else list(order or ["signal_name"])
    rank = Window.partitionBy("target_name").orderBy(*by)
    cleaned = (
        df.where(F.col("signal_name").isNotNull() & ~F.col("target_name").isin(*FRAME_TARGETS))
        .withColumn("target_unit", clean_unit(F.col("target_unit")))
        .withColumn("signal_unit", clean_unit(F.col("signal_unit")))
        .withColumn("priority", F.row_number().over(rank))
    )
    return attach_factor(cleaned, "signal_unit", "target_unit", legacy).select(
        "target_name",
        "signal_name",
        "priority",
        F.col("target_unit").isNull().alias("is_text"),
        "target_unit",
        "signal_unit",
        "factor",
        (F.col("target_unit").isNull() | F.col("factor").isNotNull()).alias("convertible"),
        F.col("min_val").cast("double").alias("min_val"),
        F.col("max_val").cast("double").alias("max_val"),
        F.col("default_val").cast("double").alias("default_val"),
        feature_formula(F.col("extend_feature")).alias("formula"),
    )


@dataclass(frozen=True)
class Signal:
    code: str
    factor: float | None
    low: float | None = None
    high: float | None = None
    default: float | None = None


@dataclass
class Target:
    name: str
    is_text: bool
    signals: list[Signal] = field(default_factory=list)
    formula: str | None = None
    low: float | None = None
    high: float | None = None
    default: float | None = None


def read_targets(compiled: DataFrame) -> list[Target]:
    """The compiled mapping on the driver, by target name: it becomes the columns of a projection."""
    rows = compiled.collect()
    targets: dict[str, Target] = {}
    for r in sorted(rows, key=lambda r: (r.target_name, r.priority)):
        t = targets.setdefault(r.target_name, Target(r.target_name, r.is_text))
        t.signals.append(Signal(r.signal_name, r.factor, r.min_val, r.max_val, r.default_val))
        if r.formula is not None:
            t.formula, t.low, t.high, t.default = r.formula, r.min_val, r.max_val, r.default_val
    return list(targets.values())


def sized(df: DataFrame) -> DataFrame:
    """A metadata table written once: the planner then knows its size and broadcasts it under its limit.

    A database table has no size estimate, so the planner alone would shuffle the signals by code.
    """
    return written(df, "metadata")


def list_targets(compiled: DataFrame) -> list[Target]:
    """Names and types of the targets only, for a mapping of any length."""
    rows = compiled.select("target_name", "is_text").distinct().collect()
    return [Target(r.target_name, r.is_text) for r in sorted(rows, key=lambda r: r.target_name)]


# ---------------------------------------------------------------- regrouping and checking

def _has_unit(unit: str) -> Column:
    return clean_unit(F.col(unit)).isNotNull()


def mapping_faults(df: DataFrame) -> DataFrame:
    """Targets where only one of target unit and signal units is given."""
    return (
        df.groupBy("target_name")
        .agg(
            F.max(_has_unit("target_unit")).alias("target_has_unit"),
            F.max(_has_unit("signal_unit")).alias("signal_has_unit"),
        )
        .where(F.col("target_has_unit") != F.col("signal_has_unit"))
    )


def first_value(column: str | Column, order: str | Column) -> Column:
    """First value of a group by a stated order."""
    return F.min_by(column, order)


def joined_values(value: str, order: str, separator: str = ";") -> Column:
    """Non-NULL values of a group as one text, ordered; equal (order, value) pairs appear once."""
    pairs = F.array_sort(F.collect_set(F.when(F.col(value).isNotNull(), F.struct(order, value))))
    return F.nullif(F.array_join(F.transform(pairs, lambda p: p.getField(value)), separator), F.lit(""))


def regroup_mapping(df: DataFrame, order: str, **constants: str) -> DataFrame:
    """All series' packed mappings as one: distinct (signal, unit) pairs per target, packed again.

    ``order`` is the column that says which mapping row came first.
    """
    flat = unpack_mapping(df).where(F.col("reason").isNull())
    stamp = F.struct(F.col(order), F.col("place"))
    pairs = flat.groupBy("target_name", "signal_name", "signal_unit").agg(
        F.min(stamp).alias("seen"),
        F.min_by("target_desc", stamp).alias("target_desc"),
        F.min_by("target_unit", stamp).alias("target_unit"),
    )
    packed = pairs.groupBy("target_name").agg(
        F.min_by("target_desc", "seen").alias("target_desc"),
        F.min_by("target_unit", "seen").alias("target_unit"),
        joined_values("signal_name", "seen").alias("signal_code"),
        joined_values("signal_unit", "seen").alias("signal_unit"),
    )
    return packed.withColumns({k: F.lit(v) for k, v in constants.items()})


def import_sheet(df: DataFrame, **constants: str) -> DataFrame:
    """The mapping sheet's seven columns under their table names, with constant columns added."""
    named = df.select(*SHEET_COLUMNS).withColumnsRenamed(SHEET_COLUMNS)
    return named.withColumns({k: F.lit(v) for k, v in constants.items()})


# ---------------------------------------------------------------- schema from metadata

def target_types(df: DataFrame, order: str | None = None) -> DataFrame:
    """``target_name, target_desc, target_unit, is_text``: numeric if it has a unit, else text. The description is that
    of the first row by ``order``; without one, the first by name."""
    desc = "target_desc" if "target_desc" in df.columns else "target_name"
    return df.groupBy("target_name").agg(
        F.min_by(desc, order or desc).alias("target_desc"),
        F.array_join(F.array_sort(F.collect_set(clean_unit(F.col("target_unit")))), ";").alias("_unit"),
    ).select(
        "target_name",
        "target_desc",
        F.nullif("_unit", F.lit("")).alias("target_unit"),
        (F.col("_unit") == "").alias("is_text"),
    )


def _types_on_driver(df: DataFrame, order: str | None = None) -> list:
    """One row per target: the columns of the table."""
    return sorted(target_types(df, order).collect(), key=lambda r: r.target_name)


def to_fused_table(fused: DataFrame, schema: T.StructType) -> DataFrame:
    """Fused rows under the table's schema: ``is_delete`` 0 and ``create_time`` now unless they are there, other missing
    columns NULL, the rest cast."""
    made = {"is_delete": F.lit("0"), "create_time": F.current_timestamp()}

    def column(name: str) -> Column:
        return F.col(f"`{name}`") if name in fused.columns else made.get(name, F.lit(None))

    return fused.select(*(column(f.name).cast(f.dataType).alias(f.name) for f in schema))


def fused_schema(df: DataFrame, number: str = "double") -> T.StructType:
    """Schema of the fused table; ``number`` is the type of targets with a unit."""
    fields = [f"{name} {kind}" for name, kind in KEY_COLUMNS]
    fields += [f"`{r.target_name}` {'string' if r.is_text else number}" for r in _types_on_driver(df)]
    return T.StructType.fromDDL(", ".join(fields))


def fused_ddl(df: DataFrame, table: str, location: str | None = None, order: str | None = None) -> str:
    """``CREATE TABLE`` for the fused table, partitioned as it is written; ``order`` says whose description counts."""
    def quoted(text: str | None) -> str:
        return "'" + (text or "").replace("\\", "\\\\").replace("'", "\\'") + "'"

    lines = [f"  {name} {kind}" for name, kind in KEY_COLUMNS]
    for r in _types_on_driver(df, order):
        kind = "STRING" if r.is_text else "DOUBLE"
        note = f"{r.target_desc}, unit: {r.target_unit}"
        lines.append(f"  `{r.target_name}` {kind} COMMENT {quoted(note)}")
    where = f"\nLOCATION {quoted(location)}" if location else ""
    return (
        f"CREATE TABLE {table} (\n" + ",\n".join(lines) + "\n) USING parquet\n"
        "PARTITIONED BY (data_source, data_type, clt_date)" + where
    )


def sheet_mapping(df: DataFrame, data_source: str, order: str | None = None) -> DataFrame:
    """A signal sheet (``target_name, target_desc, target_unit, pid, Description, unit``) as mapping rows, each with its
    target's first description by ``order``."""
    types = target_types(df, order).select("target_name", F.col("target_unit").alias("_unit"), F.col("target_desc").alias("_desc"))
    return df.join(types, "target_name").select(
        "target_name",
        F.col("_desc").alias("target_desc"),
        F.col("_unit").alias("target_unit"),
        F.col("pid").alias("signal_name"),
        F.col("Description").alias("signal_desc"),
        clean_unit(F.col("unit")).alias("signal_unit"),
        F.when(_has_unit("unit"), F.lit("Float64")).otherwise(F.lit("String")).alias("signal_type"),
        F.lit(data_source).alias("data_source"),
    )


def keep_targets_of(mapping: DataFrame, other: DataFrame) -> DataFrame:
    """The mapping rows whose target also occurs in another mapping."""
    return mapping.join(other.select("target_name"), "target_name", "left_semi")


