"""Cutting the lineage of iterative operators in the folder that driver and executors share."""

from __future__ import annotations

import tempfile

import uuid

from pyspark.sql import DataFrame, SparkSession


def _home(spark: SparkSession) -> str:
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not context._jsc.sc().getCheckpointDir().isDefined():
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="inkspar-checkpoint-"))
    return context._jsc.sc().getCheckpointDir().get().rstrip("/")


def fresh(spark: SparkSession, name: str) -> str:
    """A new folder's address in the folder that driver and executors share."""
    return f"{_home(spark)}/inkspar/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """The rows, checkpointed in spark.checkpoint.dir; only where that is unset on a local master a folder of this process is used, and on a cluster that is an error."""
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(_home(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written as Parquet to a fresh folder and read from there: made once for several readers, each of which takes only the columns that it needs."""
    folder = fresh(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
