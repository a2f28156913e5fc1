"""Sends the package to the executors of a session, so that tasks can import it wherever the driver found it."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Adds a zip of the package to the session's Python files, once for each Spark application."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = os.path.dirname(os.path.abspath(__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="spark-"), "tidewright.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
            for folder, _, names in os.walk(package):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        out.write(full, os.path.join("tidewright", os.path.relpath(full, package)))
        context.addPyFile(path)
        _SHIPPED.add(context.applicationId)
    return spark
