"""JSON messages of the two stream flavours, decoded with built-in expressions.

Decoding is total: whatever a message holds, it gives a row or a reject with a reason, and its neighbours are read. A time
counts if it is a whole number of milliseconds in the years 1 to 9999, as a JSON number or as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from telefold.functions import clean, clock, signals

FRAME_SCHEMA = (
    "ein string, uploadTime string, deviceID string, longitude string, latitude string, "
    "items array<struct<signalname:string,name:string,value:string>>, _corrupt string"
)
MEMBER_SCHEMA = (
    "struct<ein:string,vin:string,time:string,sn:string,lng:string,lat:string,high:string,"
    "message:array<struct<pid:string,value:string>>,_corrupt:string>"
)
SIGNAL_SCHEMA = f"array<{MEMBER_SCHEMA}>"
FEATURE_SCHEMA = "extend struct<type:string,formula:string>"
CORRUPT = {"columnNameOfCorruptRecord": "_corrupt"}
POSITION_SIGNALS = ("lng", "lat", "high")


def feature_formula(feature: Column) -> Column:
    """The formula of a "calculate" option text, else NULL."""
    extend = F.from_json(feature, FEATURE_SCHEMA).getField("extend")
    return F.when(extend.getField("type") == "calculate", extend.getField("formula"))


def decode_frames(df: DataFrame, text: str = "value", zone: str | None = None) -> DataFrame:
    """One message, one frame. An unreadable message stays as a row with its text in ``corrupt``; one without a readable
    time has NULL for it."""
    m = F.from_json(F.col(text), FRAME_SCHEMA, CORRUPT)
    d = F.col("_m")
    seconds = clock.readable(F.expr("floor(try_cast(_m.uploadTime AS bigint) / 1000)"))
    kept = [c for c in df.columns if c != text]
    return df.withColumn("_m", m).select(
        *kept,
        clean.strip_one_zero(d.ein).alias("ein"),
        d.deviceID.alias("vin"),
        clock.epoch_text(seconds, zone=zone).alias("clt_time"),
        clock.epoch_text(seconds, "yyyy-MM-dd", zone).alias("clt_date"),
        seconds.alias("clt_timestamp"),
        d.longitude.alias("longitude"),
        d.latitude.alias("latitude"),
        signals.pluck(d.items, "signalname").alias("codes"),
        signals.pluck(d.items, "value").alias("vals"),
        d.getField("_corrupt").alias("corrupt"),
    )


def _members(text: Column) -> Column:
    """The members of a list. If one of them is no message, they are read one by one and that one has its text in
    ``_corrupt``."""
    whole = F.from_json(text, SIGNAL_SCHEMA, CORRUPT)
    each = F.transform(F.from_json(text, "array<string>"), lambda x: F.from_json(x, MEMBER_SCHEMA, CORRUPT))
    return F.coalesce(whole, each)


def _seconds(member: Column) -> Column:
    return clock.text_millis_to_seconds(member.getField("time"))


def _reason(member: Column) -> Column:
    """Why a member can't be a frame; NULL if it can."""
    return (
        F.when(member.isNull() | member.getField("_corrupt").isNotNull(), "unreadable message")
        .when(F.coalesce(member.getField("ein"), F.lit("")) == "", "no engine id")
        .when(_seconds(member).isNull(), "no readable time")
    )


def read_members(df: DataFrame, text: str = "value") -> DataFrame:
    """The members of each text's list, one row each, with ``_place`` in the list, ``_reason`` why it can't be a frame (NULL if
    it can) and ``_rejected``, its text if it can't. An empty list is a row without a place. ``frames_of`` and ``rejects_of``
    divide them."""
    kept = [c for c in df.columns if c != text]
    members, d = F.col("_members"), F.col("_d")
    # a text that is no list is one NULL member
    one = F.array(F.lit(None).cast(MEMBER_SCHEMA))
    # only such a member has no text of its own; a text is not copied beside each member of its list
    needed = members.isNull() | F.exists(members, lambda m: m.isNull())
    lists = df.select(*kept, F.col(text).alias("_text"), _members(F.col(text)).alias("_members"))
    each = lists.select(*kept, F.when(needed, F.col("_text")).alias("_text"), F.posexplode_outer(F.coalesce(members, one)).alias("_place", "_d"))
    marked = each.withColumn("_reason", F.when(F.col("_place").isNotNull(), _reason(d)))
    own = F.coalesce(F.col("_d._corrupt"), F.to_json("_d"), F.col("_text"))
    return marked.select(
        *kept,
        "_place",
        "_reason",
        F.when(F.col("_reason").isNotNull(), own).alias("_rejected"),
        d.ein.alias("ein"),
        d.vin.alias("vin"),
        _seconds(d).alias("clt_timestamp"),
        d.lng.alias("lng"),
        d.lat.alias("lat"),
        d.high.alias("high"),
        F.coalesce(d.message, F.array().cast("array<struct<pid:string,value:string>>")).alias("message"),
    )


def frames_of(members: DataFrame) -> DataFrame:
    """The members that are frames."""
    good = F.col("_place").isNotNull() & F.col("_reason").isNull()
    return members.where(good).drop("_place", "_reason", "_rejected")


def rejects_of(members: DataFrame, *kept: str) -> DataFrame:
    """The members that aren't, as ``text`` and ``reject_reason``."""
    bad = members.where(F.col("_reason").isNotNull())
    return bad.select(*kept, F.col("_rejected").alias("text"), F.col("_reason").alias("reject_reason"))


def message_frames(df: DataFrame, text: str = "value") -> DataFrame:
    """A JSON list of messages, one frame per member, position kept as plain columns. Members without an engine's id or a
    readable time aren't frames; ``rejected_messages`` has them."""
    return frames_of(read_members(df, text))


def signal_rows(df: DataFrame, text: str = "value") -> DataFrame:
    """Tall form: the position as pseudo-signals ``lng, lat, high``, then every signal sent.

    ``pos`` is the place inside the message, so "first" stays defined after a shuffle.
    """
    return frame_signals(message_frames(df, text))


def frame_signals(frames: DataFrame) -> DataFrame:
    """``signal_rows`` of frames as ``message_frames`` gives them."""
    kept = [c for c in frames.columns if c not in (*POSITION_SIGNALS, "message")]
    place = F.array(
        *[F.struct(F.lit(n).alias("pid"), F.col(n).alias("value")) for n in POSITION_SIGNALS]
    )
    tall = frames.select(*kept, F.posexplode(F.concat(place, F.col("message"))).alias("pos", "_s"))
    return tall.select(*kept, "pos", F.col("_s").pid.alias("pid"), F.col("_s").value.alias("value"))


def rejected_messages(df: DataFrame, text: str = "value") -> DataFrame:
    """What ``message_frames`` has nothing of: texts that are no list of messages, and members of a list without an
    engine's id or a readable time, each as ``text`` with a ``reject_reason``. An empty list has nothing to reject."""
    return rejects_of(read_members(df, text), *[c for c in df.columns if c != text])
