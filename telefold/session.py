"""Session settings the operators rely on, and the shared folder for written stages."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "telefold", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and the clock pinned to UTC."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def keep_last_key(spark: SparkSession) -> None:
    """A code sent twice in one frame keeps its last value; Spark's default is to fail on it."""
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; a temporary one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_folder(context.applicationId)


@functools.cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"telefold-{application}-")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one written stage."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """A small result written once and read back: its lineage is cut and the planner knows its true size,
    so it is broadcast only if it is under the session's limit."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
