"""Stream sources. Broker addresses and topics come from the caller's options."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Read settings of the two stream jobs, per trigger.
KAFKA_DEFAULTS: dict[str, str] = {"startingOffsets": "latest", "failOnDataLoss": "false"}
OFFSETS_PER_TRIGGER = {"frames": 1_000_000, "signals": 100}


def kafka_options(servers: str, topic: str, per_trigger: int, **more: str) -> dict[str, str]:
    return {
        **KAFKA_DEFAULTS,
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "maxOffsetsPerTrigger": str(per_trigger),
        **more,
    }


def open_kafka(spark: SparkSession, **options: str) -> DataFrame:
    """Messages as text in ``value``, with ``partition`` and ``offset``."""
    stream = spark.readStream.format("kafka").options(**options).load()
    return stream.selectExpr("CAST(value AS STRING) AS value", "partition", "offset")


def open_files(spark: SparkSession, path: str, per_trigger: int | None = None) -> DataFrame:
    """Messages as lines of text files in a folder; ``per_trigger`` limits the files of one batch."""
    reader = spark.readStream.format("text")
    if per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.load(path)
