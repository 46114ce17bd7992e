"""Micro-batch fusion of both message flavours.

Good rows go to ``path`` by source, type, date and batch, so readers can prune by date; what can't be used goes to the
rejects with its text and a reason, beside the table unless another place is named. A batch that is run again, because it
failed after its write or the job was stopped, overwrites its own rows and rejects, so a restart from the checkpoint neither
loses nor repeats any. Parts of one frame that arrive in different batches stay separate rows, as fusion works inside a
batch. Mapping and device lookup are read once, when the job starts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from telefold.functions import clock
from telefold.functions.messages import decode_frames, frame_signals, frames_of, read_members, rejects_of
from telefold.operators.enrich import device_lookup, lookup_join
from telefold.operators.grouped import fuse_grouped
from telefold.operators.mapping import list_targets, read_targets, sized
from telefold.plans.pipeline import fuse_table, good_rows, rejected_rows
from telefold.session import keep_last_key
from telefold.sinks.tables import LAYOUT

FRAME_TRIGGER = "60 seconds"
SIGNAL_TRIGGER = "5 seconds"


#: What is added to a table's path for its rejects.
REJECTS = "_rejects"


def rejects_beside(path: str) -> str:
    return path.rstrip("/") + REJECTS


def _overwrite(df: DataFrame, levels: Sequence[str], path: str) -> None:
    df.write.partitionBy(*levels).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def batch_writer(
    fuse: Callable[[DataFrame], tuple[DataFrame, DataFrame | None]],
    path: str,
    rejects: str | None = None,
    drop_rejects: bool = False,
    on_batch: Callable[[int, bool], None] | None = None,
    decode: Callable[[DataFrame], DataFrame] | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: skips empty batches, otherwise writes the fused batch, and its rejects apart.

    ``decode`` is done once for both and its result is what ``fuse`` gets; it gives no row only where there is no message.

    Rejects go to ``rejects``, else beside the table; only ``drop_rejects`` loses them. The batch is kept while it is
    read more than once. A column of LAYOUT that ``fuse`` doesn't give is no level. ``on_batch`` is told each batch's id
    and whether it held rows, once they are written and before Spark counts the batch as done; if it raises, the job
    ends and the batch is run again at the next start.
    """
    place = rejects or rejects_beside(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = (batch if decode is None else decode(batch)).persist()
        try:
            some = not batch.isEmpty()
            if some:
                good, bad = fuse(batch)
                levels = [c for c in LAYOUT if c in good.columns]
                _overwrite(good.withColumn("batch_id", F.lit(batch_id)), [*levels, "batch_id"], path)
                if bad is not None and not drop_rejects:
                    _overwrite(bad.withColumn("batch_id", F.lit(batch_id)), ["batch_id"], place)
        finally:
            batch.unpersist()
        if on_batch is not None:
            on_batch(batch_id, some)

    return write


def _start(stream: DataFrame, write, checkpoint: str, every: str | None) -> StreamingQuery:
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def stream_frames(
    messages: DataFrame,
    mapping: DataFrame,
    path: str,
    checkpoint: str,
    devices: DataFrame | None = None,
    every: str | None = FRAME_TRIGGER,
    zone: str | None = None,
    rejects: str | None = None,
    drop_rejects: bool = False,
    on_batch: Callable[[int, bool], None] | None = None,
    **options,
) -> StreamingQuery:
    """One message per frame (``value`` column of JSON text). ``every=None`` takes what is there and ends, an interval
    runs until it is stopped. Rejects are rows of ``reject_reason, text, ein, clt_time``."""
    keep_last_key(messages.sparkSession)
    targets = read_targets(mapping)
    lookup = None if devices is None else sized(device_lookup(devices).select("ein", "hos_series", "hos_mat_id"))

    def decode(batch: DataFrame) -> DataFrame:
        frames = decode_frames(batch.select("value", F.col("value").alias("text")), zone=zone)
        fused = fuse_table(frames, targets, zone=zone, carry=["corrupt", "text"], **options)
        return fused.withColumn("text", F.when(F.col("reject_reason").isNotNull(), F.col("text"))).drop("corrupt")

    def divide(fused: DataFrame) -> tuple[DataFrame, DataFrame]:
        good = good_rows(fused).drop("text")
        bad = rejected_rows(fused).select("reject_reason", "text", "ein", "clt_time")
        return good if lookup is None else lookup_join(good, lookup, "ein"), bad

    return _start(messages, batch_writer(divide, path, rejects, drop_rejects, on_batch, decode), checkpoint, every)


#: Columns of a fused signal row that come from the mapping or a constant.
SIGNAL_IDS = ("platname", "data_source", "data_type", "hos_mat_id")


def stream_signals(
    messages: DataFrame,
    mapping: DataFrame,
    path: str,
    checkpoint: str,
    scaling: DataFrame | None = None,
    every: str | None = SIGNAL_TRIGGER,
    ids: Sequence[str] = ("vin",),
    zone: str | None = None,
    rejects: str | None = None,
    drop_rejects: bool = False,
    on_batch: Callable[[int, bool], None] | None = None,
    **constants: str,
) -> StreamingQuery:
    """Messages as lists of frames, fused per engine and second inside each batch.

    Rows carry ``vin``, ``clt_time``, ``clt_date`` and SIGNAL_IDS, from the mapping's columns of that name, else
    from ``constants``, else NULL. A text that is no list of messages is a reject, and so is each message without an
    engine's id or a readable time: ``reject_reason, text``.
    """
    keep_last_key(messages.sparkSession)
    targets = list_targets(mapping)
    ids = [*ids, *(c for c in SIGNAL_IDS if c in mapping.columns and c not in ids)]
    mapping = sized(mapping)
    scaling = None if scaling is None else sized(scaling)
    order = [c for c in ("partition", "offset") if c in messages.columns] + ["pos"]

    def fuse(members: DataFrame) -> tuple[DataFrame, DataFrame]:
        tall = frame_signals(frames_of(members))
        # a frame's first row is that of its longitude
        fused = fuse_grouped(tall, mapping, order=order, ids=ids, scaling=scaling, targets=targets, opening=F.col("pos") == 0)
        fixed = {c: F.lit(constants.get(c)).cast("string") for c in SIGNAL_IDS if c not in ids}
        seconds = F.col("clt_timestamp").cast("bigint")
        fixed |= {"clt_time": clock.epoch_text(seconds, zone=zone), "clt_date": clock.epoch_text(seconds, "yyyy-MM-dd", zone)}
        return fused.withColumns(fixed), rejects_of(members)

    return _start(messages, batch_writer(fuse, path, rejects, drop_rejects, on_batch, read_members), checkpoint, every)
