"""Joins: device enrichment, filters by devices, lookups.

No join carries a broadcast hint on a table that grows with the fleet: Spark broadcasts a side only
under ``spark.sql.autoBroadcastJoinThreshold``, and beyond it adaptive execution splits skewed shuffle
partitions. ``salts`` spreads one hot key over several tasks where that is not enough.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from telefold.functions.clean import series_base, strip_one_zero
from telefold.session import written


def latest_per_key(df: DataFrame, key: str, stamp: str) -> DataFrame:
    """The newest row of every key. Equal stamps are decided by the other columns, so a rerun agrees.

    An aggregate, not a window: rows of a hot key are combined before the shuffle.
    """
    others = [c for c in df.columns if c not in (key, stamp)]
    row = F.struct(stamp, *others)
    best = df.groupBy(key).agg(F.max(row).alias("_r"))
    return best.select(*[F.col(key) if c == key else F.col("_r").getField(c).alias(c) for c in df.columns])


def device_lookup(devices: DataFrame) -> DataFrame:
    """``ein, hos_mat_id, hos_series, tbox_type`` with one row per engine, the newest."""
    newest = latest_per_key(
        devices.select("hos_id", "hos_mat_id", "hos_series", "type", "create_time"), "hos_id", "create_time"
    )
    return newest.select(
        F.col("hos_id").alias("ein"), "hos_mat_id", "hos_series", F.col("type").alias("tbox_type")
    )


def lookup_join(
    facts: DataFrame, lookup: DataFrame, key: str, salts: int = 1, salt_by: Sequence[str] = ()
) -> DataFrame:
    """Left join to a lookup with one row per key. With ``salts`` the rows of each key go to that many
    tasks, by a hash of the ``salt_by`` columns, and the lookup is repeated as often."""
    if salts <= 1:
        return facts.join(lookup, key, "left")
    if not salt_by:
        raise ValueError("salt_by must name columns that vary within a key")
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(*salt_by), F.lit(salts)).cast("int"))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [key, "_salt"], "left").drop("_salt")


#: Keys a sketch follows, how many of the most frequent it names at most, and parts for each even share of a heavy key:
#: several, since parts are dealt by hash and some meet in one task.
TRACKED_KEYS, NAMED_KEYS, FINER = 10_000, 200, 6


def heavy_keys(facts: DataFrame, key: str, parts: int | None = None) -> list[tuple[object, int]]:
    """Keys with more rows than an even share of ``parts`` (the session's shuffle partitions), and into how many parts
    each goes: FINER for each share. A sketch of bounded size finds them in one pass over the key's column.

    The sketch's counts are estimates, so a key near the limit may be missed or named; that changes tasks, never rows.
    """
    parts = parts or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    top = F.expr(f"approx_top_k(`{key}`, {min(NAMED_KEYS, max(parts, 1))}, {TRACKED_KEYS})")
    rows, found = facts.agg(F.count(F.lit(1)), top).first()
    share = max(1, rows // parts)
    return [(x.item, -(-FINER * x["count"] // share)) for x in found or [] if x.item is not None and x["count"] > share]


def spread_lookup_join(facts: DataFrame, lookup: DataFrame, key: str, by: Sequence[str], parts: int | None = None) -> DataFrame:
    """Left join to a lookup with one row per key. Only the rows of heavy keys are spread, by a hash of ``by``; only their lookup rows are repeated."""
    heavy = heavy_keys(facts, key, parts)
    if not heavy:
        return lookup_join(facts, lookup, key)
    ways = F.create_map(*(x for k, n in heavy for x in (F.lit(k).cast(facts.schema[key].dataType), F.lit(n))))
    split = F.coalesce(F.try_element_at(ways, F.col(key)), F.lit(1))
    spread = facts.withColumn("_part", F.pmod(F.xxhash64(*by), split).cast("int"))
    copies = lookup.withColumn("_part", F.explode(F.sequence(F.lit(0), split - 1)))
    return spread.join(copies, [key, "_part"], "left").drop("_part")


def enrich_devices(frames: DataFrame, devices: DataFrame, salts: int = 1) -> DataFrame:
    """Adds ``hos_series`` and ``hos_mat_id`` by ``ein``; NULL for an unknown engine.

    The lookup, one row per engine, is written first: its size is known before the frames are read, so they
    are shuffled only if it is beyond the broadcast limit.
    """
    found = written(device_lookup(devices).select("ein", "hos_series", "hos_mat_id"), "devices")
    by = [c for c in ("clt_timestamp", "vin") if c in frames.columns]
    return lookup_join(frames, found, "ein", salts, by)


def _of_series(column: str, series: str) -> Column:
    """Either spelling of a series, as a list of literals a scan can filter on."""
    base = series.removesuffix("系列")
    return F.col(column).isin(base, base + "系列")


def frames_of_devices(
    frames: DataFrame, devices: DataFrame, device_type: str, series: str | None = None
) -> DataFrame:
    """Frames of devices of one type (and series) that have a vehicle id; adds ``hos_mat_id``."""
    chosen = devices.where((F.col("type") == device_type) & F.col("vin").isNotNull())
    if series is not None:
        chosen = chosen.where(_of_series("hos_series", series))
    return frames.join(chosen.select(F.col("hos_id").alias("ein"), "hos_mat_id"), "ein")


def frames_per_vehicle(raw: DataFrame, date: str = "uploadDate") -> DataFrame:
    """``ein, uploadDate, cnt`` of vehicles that sent something; ids normalised, blank ones left out."""
    return (
        raw.withColumn("ein", strip_one_zero(F.col("ein")))
        .where(F.col("ein") != "")
        .groupBy("ein")
        .agg(F.min(date).alias(date), F.count(F.lit(1)).alias("cnt"))
        .where(F.col("cnt") > 0)
    )


def online_vehicles(raw: DataFrame, devices: DataFrame, series: str, date: str = "uploadDate") -> DataFrame:
    """Vehicles of one series that sent frames, with their counts."""
    fleet = devices.where(_of_series("hos_series", series)).select(
        F.col("hos_id").alias("ein"), series_base(F.col("hos_series")).alias("hos_series")
    )
    return frames_per_vehicle(raw, date).join(fleet, "ein")


def only_keys(df: DataFrame, keys: DataFrame, key: str = "ein") -> DataFrame:
    """Rows whose key occurs in another table."""
    return df.join(keys.select(key), key, "left_semi")


#: Bits of a key filter for each key, the places each key sets, and the most bits a filter has.
BITS_PER_KEY, PLACES, MOST_BITS = 10, 3, 1 << 27


def _places(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits)) for i in range(PLACES)]


def key_filter(keys: DataFrame, key: str) -> tuple[DataFrame, int]:
    """A Bloom filter of a key column: one row with ``words array<bigint>``, and its number of bits.

    Bits are set by ``bit_or`` on words of 64, combined before the shuffle; the size follows the number of keys up to
    MOST_BITS (16 MB), beyond which the filter only lets more through.
    """
    count = keys.agg(F.approx_count_distinct(key)).first()[0]
    bits = min(MOST_BITS, max(64, 1 << (count * BITS_PER_KEY).bit_length()))
    places = keys.where(F.col(key).isNotNull()).select(F.explode(F.array(*_places(F.col(key), bits))).alias("at"))
    words = places.groupBy(F.expr("at div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("bits"))
    dense = keys.sparkSession.range(bits // 64).withColumnRenamed("id", "word").join(words, "word", "left")
    pairs = F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0)).alias("bits"))))
    return written(dense.agg(F.transform(pairs, lambda p: p["bits"]).alias("words")), "filter"), bits


def only_keys_filtered(df: DataFrame, keys: DataFrame, key: str = "ein") -> DataFrame:
    """``only_keys`` for key sets beyond the broadcast limit: a Bloom filter of the keys drops rows where they are read,
    so those of other keys are hardly shuffled; the join decides on the rest."""
    words, bits = key_filter(keys, key)
    held = words.scalar()
    may = F.lit(True)
    for at in _places(F.col(key), bits):
        word = F.get(held, F.floor(at / 64).cast("int"))
        may = may & (F.call_function("getbit", word, (at % 64).cast("int")) == 1)
    return only_keys(df.where(may), keys, key)


def first_match(df: DataFrame, matches: DataFrame, key: str, order: str, columns: Sequence[str]) -> DataFrame:
    """Left join to the first matching row by ``order``; several matches do not multiply rows."""
    row = F.struct(F.col(order).alias("_o"), *columns)
    best = matches.groupBy(key).agg(F.min(row).alias("_r"))
    best = best.select(key, *[F.col("_r").getField(c).alias(c) for c in columns])
    return df.join(best, key, "left")


def lookup_chain(df: DataFrame, steps: Sequence[tuple[DataFrame, str, str, dict[str, str]]]) -> DataFrame:
    """Left joins one after the other: ``(table, key here, key there, {column there: name here})``."""
    for table, here, there, columns in steps:
        side = table.select(
            F.col(there).alias("_k"), *[F.col(c).alias(name) for c, name in columns.items()]
        )
        df = df.join(side, F.col(here) == F.col("_k"), "left").drop("_k")
    return df
