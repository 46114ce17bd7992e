"""Census and profiling of signals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from telefold.functions.clean import starts_with_any
from telefold.session import written

# Measured size of 10,000 raw frames, and the divisor to the next unit.
SIZE_PER_10K = 21.38
SIZE_UNIT = 1024

#: Distinct values that one task of a box summary sorts, about; the number of ranges follows from the count.
RANGE_VALUES = 100_000

#: A value's range is found among every so-many-th bound first, then among the bounds in between.
COARSE = 16


def signal_census(
    frames: DataFrame, date: str, codes: str = "codes", prefixes: Sequence[str] = (), more_than: int = 100
) -> DataFrame:
    """``date, pid, ct``: how often each code was sent per day, where more than a threshold."""
    sent = frames.select(date, F.explode(codes).alias("pid"))
    if prefixes:
        sent = sent.where(starts_with_any(F.col("pid"), prefixes))
    return (
        sent.where(F.col("pid").isNotNull())
        .groupBy(date, "pid")
        .agg(F.count(F.lit(1)).alias("ct"))
        .where(F.col("ct") > more_than)
    )


def store_census(
    frames: DataFrame, path: str, first: str, last: str, date: str = "clt_date", codes: str = "codes", prefixes: Sequence[str] = ()
) -> None:
    """Counts the codes of the days ``first`` to ``last`` and keeps ``date, pid, ct`` by day under ``path``.

    Days counted before stay as they are unless they are in the range; those are replaced, also by nothing. So a day that
    comes late or again costs the count of that day, not of all.
    """
    from telefold.sinks.tables import reload_between

    days = frames.where(F.col(date).cast("string").between(first, last))
    counts = signal_census(days, date, codes, prefixes, more_than=0).withColumn(date, F.col(date).cast("string"))
    reload_between(counts, path, date, first, last)


def stored_census(spark: SparkSession, path: str, first: str, last: str, date: str = "clt_date", more_than: int = 100) -> DataFrame:
    """The census of a span from the stored counts: ``date, pid, ct`` where more than a threshold. Only the span's days
    are read."""
    from telefold.sinks.tables import read_partitions

    return read_partitions(spark, path, [date]).where(F.col(date).between(first, last) & (F.col("ct") > more_than)).select(date, "pid", "ct")


def distinct_signals(census: DataFrame) -> DataFrame:
    return census.select("pid").distinct()


def signal_catalogue(
    census: DataFrame, catalogue: DataFrame, synonyms: DataFrame, names: DataFrame
) -> DataFrame:
    """Every signal seen, with its description, unit, meaning and target."""
    from telefold.operators.enrich import lookup_chain

    return lookup_chain(
        distinct_signals(census),
        [
            (catalogue, "pid", "PID", {"Description": "Description", "unitname": "unitname"}),
            (synonyms, "pid", "pid", {"desc": "desc", "target_unit": "target_unit", "app": "app"}),
            (names, "pid", "pid", {"target_name": "target_name"}),
        ],
    )


def name_conflicts(df: DataFrame, key: str = "pid", name: str = "desc") -> DataFrame:
    """``key, name, ct`` of keys that carry more than one name."""
    counts = df.groupBy(key, name).agg(F.count(F.lit(1)).alias("ct"))
    several = counts.groupBy(key).agg(F.count(F.lit(1)).alias("names")).where(F.col("names") > 1)
    return counts.join(several.select(key), key, "left_semi")


def group_synonyms(merged: DataFrame, flat: DataFrame, order: str) -> DataFrame:
    """Signals of one meaning: ``desc, pid`` with the meaning's unit and use and the signal's target.

    ``merged`` has ``desc, pid, app, unitname, signal_unit`` (one row per match), ``flat`` has
    ``pid, target_name``; ``order`` says in both which row came first. A signal's unit is that of its
    last match, the meaning's unit and use are those of its first row.
    """
    from telefold.operators.enrich import first_match

    first = merged.groupBy("desc").agg(F.min(F.struct(order, "unitname", "app")).alias("_f"))
    pairs = merged.groupBy("desc", "pid").agg(F.max(F.struct(order, "signal_unit")).alias("_l"))
    joined = pairs.join(first, "desc").select(
        "desc",
        "pid",
        F.col("_f").getField("unitname").alias("target_unit"),
        F.col("_l").getField("signal_unit").alias("unit"),
        F.col("_f").getField("app").alias("app"),
    )
    return first_match(joined, flat, "pid", order, ["target_name"])


def volume_estimate(counts: DataFrame, cnt: str = "cnt") -> DataFrame:
    """Expected memory of that many raw frames, in GB."""
    return counts.agg(F.sum(cnt).alias("frames")).select(
        "frames",
        (F.col("frames") / F.lit(10000) * F.lit(SIZE_PER_10K) / F.lit(SIZE_UNIT)).alias("gb"),
    )


def top_by(df: DataFrame, column: str, n: int | None = None, *ties: str) -> DataFrame:
    """Rows by a column, largest first; ``ties`` make the cut repeatable."""
    ordered = df.orderBy(F.desc(column), *ties)
    return ordered if n is None else ordered.limit(n)


def sample_rows(df: DataFrame, n: int, by: Sequence[str], seed: str = "", ties: Sequence[str] = ()) -> DataFrame:
    """A repeatable random choice of ``n`` rows, ordered by the MD5 of their ids joined by ``|``, a seed before them;
    ``ties`` order rows with equal ids."""
    ids = F.concat_ws("|", *([F.lit(seed)] if seed else []), *(F.col(c).cast("string") for c in by))
    return df.orderBy(F.md5(ids.cast("binary")), *by, *ties).limit(n)


def any_rows(df: DataFrame, n: int, seed: int | None = None) -> DataFrame:
    """A random choice of ``n`` rows."""
    return df.orderBy(F.rand(seed)).limit(n)


def counted_values(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """``by, _v, _c``: how often each value occurs per group; written, for it is read several times."""
    by = list(by)
    if not by:
        raise ValueError("name at least one grouping column; a constant will do")
    counted = (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    return written(counted, "counted")


def quantiles(df: DataFrame, by: Sequence[str], value: str, at: Sequence[float]) -> DataFrame:
    """Exact interpolated quantiles per group, as columns ``q0, q1, …``, with ``n``."""
    return counted_quantiles(counted_values(df, by, value), by, at)


def counted_quantiles(counted: DataFrame, by: Sequence[str], at: Sequence[float]) -> DataFrame:
    """Quantiles of counted values. Built for a group that holds most of the rows.

    Approximate quantiles of the distinct values cut each group into ranges of similar size; the few range
    totals say which ranges hold a wanted rank, two per quantile at most, and only those are sorted, each by
    its own task. The cuts and the totals (one row per group and range) are written aside, so building the
    result runs jobs.
    """
    by = list(by)
    parts = COARSE * (counted.count() // (RANGE_VALUES * COARSE) + 1)
    cuts = [i / parts for i in range(1, parts)]
    bounds = counted.groupBy(*by).agg(
        F.percentile_approx("_v", cuts, 20 * parts).alias("_cuts"), F.sum("_c").alias("n")
    )
    coarse = F.array(*[F.get("_cuts", F.lit(i)) for i in range(COARSE - 1, parts - 1, COARSE)])
    bounds = written(bounds.withColumn("_coarse", coarse), "bounds")
    rough = F.size(F.filter("_coarse", lambda cut: cut < F.col("_v"))) * COARSE
    fine = F.filter(F.slice("_cuts", F.col("_rough") + 1, F.lit(COARSE)), lambda cut: cut < F.col("_v"))
    placed = (
        counted.join(bounds, by)
        .withColumn("_rough", rough)
        .select(*by, "n", "_v", "_c", (F.col("_rough") + F.size(fine)).alias("_part"))
    )
    totals = placed.groupBy(*by, "_part").agg(F.sum("_c").alias("_t"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("_before", F.coalesce(F.sum("_t").over(before), F.lit(0))).join(bounds.select(*by, "n"), by)
    ranks = [edge((F.col("n") - 1) * F.lit(float(p))) for p in at for edge in (F.floor, F.ceil)]
    holds = F.exists(F.array(*ranks), lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_t")))
    offsets = written(offsets.where(holds).select(*by, "_part", "_before"), "offsets")
    running = Window.partitionBy(*by, "_part").orderBy("_v")
    last = F.col("_before") + F.sum("_c").over(running) - 1
    ranked = placed.join(offsets, [*by, "_part"]).withColumn("_last", last).withColumn(
        "_first", F.col("_last") - F.col("_c") + 1
    )
    pieces = []
    for i, p in enumerate(at):
        where = (F.col("n") - 1) * F.lit(float(p))
        low, high = F.floor(where), F.ceil(where)
        for name, rank in ((f"_l{i}", low), (f"_h{i}", high)):
            hit = (F.col("_first") <= rank) & (F.col("_last") >= rank)
            pieces.append(F.max(F.when(hit, F.col("_v"))).alias(name))
    found = ranked.groupBy(*by).agg(F.max("n").alias("n"), *pieces)
    columns = []
    for i, p in enumerate(at):
        where = (F.col("n") - 1) * F.lit(float(p))
        share = where - F.floor(where)
        low, high = F.col(f"_l{i}"), F.col(f"_h{i}")
        columns.append((low + (high - low) * share).alias(f"q{i}"))
    return found.select(*by, "n", *columns)


def box_summary(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Numbers of a box plot per group: count, minimum, quartiles, maximum, whiskers, outliers."""
    by = list(by)
    counted = counted_values(df, by, value)
    q = counted_quantiles(counted, by, (0.0, 0.25, 0.5, 0.75, 1.0)).withColumnsRenamed(
        {"q0": "min", "q1": "p25", "q2": "median", "q3": "p75", "q4": "max"}
    )
    reach = 1.5 * (F.col("p75") - F.col("p25"))
    fenced = written(q.withColumn("_low", F.col("p25") - reach).withColumn("_high", F.col("p75") + reach), "boxes")
    v = F.col("_v")
    inside = (v >= F.col("_low")) & (v <= F.col("_high"))
    return counted.join(fenced, by).groupBy(*by, "n", "min", "p25", "median", "p75", "max").agg(
        F.min(F.when(inside, v)).alias("whisker_low"),
        F.max(F.when(inside, v)).alias("whisker_high"),
        F.sum(F.when(inside, 0).otherwise(F.col("_c"))).alias("outliers"),
    )
