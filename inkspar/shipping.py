"""Sends the package to the executors' Python workers."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_PACKAGE = Path(__file__).resolve().parent
#: Rows of an Arrow batch unless the session names another number than Spark's own: texts can be long, and a batch is held whole on both sides.
BATCH_ROWS, _BATCH_KEY, _BATCH_DEFAULT = "2000", "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def ship(spark: SparkSession) -> None:
    """Adds the package to the job's Python files, once for each application, and bounds Arrow batches."""
    context = spark.sparkContext
    if spark.conf.get(_BATCH_KEY) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_KEY, BATCH_ROWS)
    if getattr(context, "_inkspar_shipped", False):
        return
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='inkspar-ship-')}/{_PACKAGE.name}", "zip", _PACKAGE.parent, _PACKAGE.name)
    context.addPyFile(archive)
    context._inkspar_shipped = True


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run
