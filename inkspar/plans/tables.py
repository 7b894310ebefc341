"""Access to the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(spark: SparkSession, sf_dir: str, name: str, key: str, task_rows: int) -> DataFrame:
    """A table dealt out by its key, about task_rows rows a task, for Python work that takes long for each row. Files are split by bytes, and few bytes can hold millions of rows,
    which one task would read; the number of tasks grows with the rows, which are counted in the files' footers."""
    rows = table(spark, sf_dir, name)
    return rows.repartition(max(1, -(-rows.count() // task_rows)), key)
