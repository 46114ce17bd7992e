"""Gives the executors this package where it isn't installed on them."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Sends the package's sources to every executor through Spark, once for each application."""
    _ship(spark, spark.sparkContext.applicationId)


@functools.cache
def _ship(spark: SparkSession, application: str) -> None:
    package = Path(__file__).resolve().parents[1]
    archive = os.path.join(tempfile.mkdtemp(), f"{package.name}-{application}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive)
