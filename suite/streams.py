"""Streams that meet bad messages, failures, intervals and empty batches."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from suite.fusion import group_mapping
from suite.inputs import table
from suite.registry import query
from suite.scans import frame_messages
from telefold.session import work_path
from telefold.sinks import tables as sinks
from telefold.sources.streams import open_files
from telefold.streaming import jobs

#: Times as they stand in a message, by event_id % 10, and the second they mean. The last two messages have no engine's id.
TIMES = [
    ("1700000000250", 1700000000), ('"1700000000250"', 1700000000), ("-86400000", -86400), ("3000000000000", 3000000000),
    ("100000000000000000", None), ('"x"', None), ("null", None), ("253402300800000", None), ("5000", 5), ("6000", 6),
]
IDS = "CASE event_id % 10 WHEN 8 THEN 'null' WHEN 9 THEN '\"\"' ELSE concat('\"O', event_id, '\"') END"
_TIME = "CASE event_id % 10 " + " ".join(f"WHEN {i} THEN '{t}'" for i, (t, _) in enumerate(TIMES)) + " END"
_SECOND = "CASE event_id % 10 " + " ".join(f"WHEN {i} THEN {s}" for i, (_, s) in enumerate(TIMES[:8]) if s is not None) + " END"
_FRAME = f"""concat('{{"ein":', {IDS}, ',"uploadTime":', {_TIME}, ',"deviceID":"V","items":[{{"signalname":"view","name":"n","value":"', event_id, '"}}]}}')"""
_MEMBER = f"""concat('{{"ein":', {IDS}, ',"vin":"V","time":', {_TIME}, ',"message":[{{"pid":"view","value":"', event_id, '"}}]}}')"""
_GOOD = """concat('{"ein":"G', event_id, '","vin":"V","time":7000,"message":[{"pid":"view","value":"', event_id, '"}]}')"""
#: A member's text as a reject has it: the time as text, no field that is missing
_KEPT = f"""concat('{{', CASE event_id % 10 WHEN 8 THEN '' WHEN 9 THEN '"ein":"",' ELSE concat('"ein":"O', event_id, '",') END, '"vin":"V",',
    CASE event_id % 10 WHEN 6 THEN '' ELSE concat('"time":"', replace({_TIME}, '"', ''), '",') END, '"message":[{{"pid":"view","value":"', event_id, '"}}]}}')"""
_REASON = "CASE WHEN event_id % 10 >= 8 THEN 'no engine id' ELSE 'no readable time' END"


@query(
    "stream_bad_messages",
    f"""SELECT 'frame' AS kind, concat('O', event_id) AS ein, {_SECOND}::BIGINT AS clt_timestamp, event_id::DOUBLE AS speed, NULL::VARCHAR AS text,
           NULL::VARCHAR AS reject_reason FROM events WHERE event_id % 10 < 4
    UNION ALL SELECT 'frame', NULL, NULL, NULL, {_FRAME}, {_REASON} FROM events WHERE event_id % 10 >= 4
    UNION ALL SELECT 'list', concat('G', event_id), 7, event_id::DOUBLE, NULL, NULL FROM events
    UNION ALL SELECT 'list', concat('O', event_id), {_SECOND}::BIGINT, event_id::DOUBLE, NULL, NULL FROM events WHERE event_id % 10 < 4
    UNION ALL SELECT 'list', NULL, NULL, NULL, {_KEPT}, {_REASON} FROM events WHERE event_id % 10 >= 4
    UNION ALL SELECT 'list', NULL, NULL, NULL, event_id::VARCHAR, 'unreadable message' FROM events WHERE event_id % 7 = 0""",
)
def stream_bad_messages(spark, sf_dir):
    """Both flavours with times out of range, negative, as text, missing and unreadable, and ids that are missing: each bad
    message is a reject of its own and costs no other. Rejects lie beside the table."""
    names = ("m1", "m2", "t1", "t2", "c1", "c2")
    paths = {n: work_path(spark, n) for n in names}
    events = table(spark, sf_dir, "events")
    events.select(F.expr(_FRAME).alias("value")).write.text(paths["m1"])
    number = F.expr("CASE WHEN event_id % 7 = 0 THEN concat(',', event_id) ELSE '' END")
    lists = F.concat(F.lit("["), F.expr(_GOOD), F.lit(","), F.expr(_MEMBER), number, F.lit("]"))
    events.select(lists.alias("value")).write.text(paths["m2"])
    compiled = group_mapping(spark)
    for run in (
        jobs.stream_frames(open_files(spark, paths["m1"]), compiled, paths["t1"], paths["c1"], every=None, zone="UTC"),
        jobs.stream_signals(open_files(spark, paths["m2"]), compiled, paths["t2"], paths["c2"], every=None, zone="UTC"),
    ):
        run.awaitTermination()
    none = F.lit(None).cast("string")
    parts = []
    for kind, n in (("frame", "t1"), ("list", "t2")):
        good = sinks.read_partitions(spark, paths[n], (*sinks.LAYOUT, "batch_id"))
        parts.append(good.select(F.lit(kind).alias("kind"), "ein", "clt_timestamp", "speed", none.alias("text"), none.alias("reject_reason")))
        bad = spark.read.parquet(jobs.rejects_beside(paths[n]))
        parts.append(bad.select(F.lit(kind), none, F.lit(None).cast("bigint"), F.lit(None).cast("double"), "text", "reject_reason"))
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


FRAMES_SQL = """SELECT user_id::VARCHAR AS ein, epoch(date_trunc('second', ts))::BIGINT AS clt_timestamp,
       CASE event_type WHEN 'click' THEN value * 0.001::DOUBLE WHEN 'view' THEN value END AS speed,
       CASE event_type WHEN 'error' THEN value * 10.0::DOUBLE END AS pressure"""


class _FailsOnce:
    """Notes the batches that are written; raises once, after one of them and before Spark counts it as done."""

    def __init__(self, at: int | None = None):
        self.at, self.seen = at, []

    def __call__(self, batch_id: int, some: bool) -> None:
        self.seen.append((batch_id, some))
        if batch_id == self.at:
            self.at = None
            raise OSError("failed after the write")


@query(
    "stream_replayed_batch",
    f"""{FRAMES_SQL}, CASE WHEN event_id % 4 < 3 THEN event_id % 4 ELSE 3 END AS batch_id, '0 1 1 2 3' AS batches FROM events""",
)
def stream_replayed_batch(spark, sf_dir):
    """Four files, one a batch. The second batch fails when its rows are written; more messages come, the job is started
    again and the same batch is run again from the same messages. Each row is there once."""
    source, path, checkpoint = (work_path(spark, n) for n in ("messages", "fused", "progress"))
    messages = frame_messages(spark, sf_dir, "event_id")

    def send(n):
        messages.where(F.col("event_id") % 4 == n).select("value").coalesce(1).write.mode("append").text(source)

    send(0)
    noted = _FailsOnce(at=1)

    def start():
        return jobs.stream_frames(open_files(spark, source, 1), group_mapping(spark), path, checkpoint, every=None, zone="UTC", on_batch=noted)

    start().awaitTermination()
    send(1)
    try:
        start().awaitTermination()
    except StreamingQueryException:
        send(2)
    start().awaitTermination()
    send(3)
    start().awaitTermination()
    fused = sinks.read_partitions(spark, path, sinks.LAYOUT)
    batches = " ".join(str(n) for n, some in noted.seen if some)
    return fused.select("ein", "clt_timestamp", "speed", "pressure", F.col("batch_id").cast("bigint").alias("batch_id"), F.lit(batches).alias("batches"))


@query(
    "stream_interval_batches",
    f"""{FRAMES_SQL}, CASE WHEN event_id % 2 = 0 THEN 0 ELSE 2 END::BIGINT AS batch_id, '0 2' AS batches, '1' AS empty_batches FROM events""",
)
def stream_interval_batches(spark, sf_dir):
    """One running job, triggered by interval: a batch, an empty one that writes nothing, and another, then stopped."""
    source, path, checkpoint = (work_path(spark, n) for n in ("messages", "fused", "progress"))
    messages = frame_messages(spark, sf_dir, "event_id")
    noted = _FailsOnce()

    def send(df):
        df.select("value").coalesce(1).write.mode("append").text(source)

    send(messages.where("event_id % 2 = 0"))
    run = jobs.stream_frames(
        open_files(spark, source), group_mapping(spark), path, checkpoint, every="200 milliseconds", zone="UTC", on_batch=noted
    )
    try:
        run.processAllAvailable()
        send(messages.where("event_id IS NULL").union(spark.createDataFrame([], messages.schema)))
        run.processAllAvailable()
        send(messages.where("event_id % 2 = 1"))
        run.processAllAvailable()
    finally:
        run.stop()
    fused = sinks.read_partitions(spark, path, sinks.LAYOUT)
    told = [" ".join(str(n) for n, some in noted.seen if some == wanted) for wanted in (True, False)]
    return fused.select(
        "ein", "clt_timestamp", "speed", "pressure", F.col("batch_id").cast("bigint").alias("batch_id"),
        F.lit(told[0]).alias("batches"), F.lit(told[1]).alias("empty_batches"),
    )
