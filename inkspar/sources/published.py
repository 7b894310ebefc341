"""Tables of which readers see one whole version at a time: versions are staged beside each other, and one atomic pointer says which holds.

A version is a Parquet folder of its own. ``publish`` writes it, then moves the pointer by making the file of the next number, which the file system refuses
where that number is there; so of two that began from the same version one fails, and a job that dies before leaves nothing that a reader sees.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


class Moved(RuntimeError):
    """Another version was published meanwhile."""


def _context(spark: SparkSession, root: str):
    """The JVM's file context of root, and a maker of paths below it."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    base = hadoop.Path(root)
    context = hadoop.FileContext.getFileContext(base.toUri(), spark._jsc.hadoopConfiguration()) if base.toUri().getScheme() else hadoop.FileContext.getFileContext(spark._jsc.hadoopConfiguration())
    return context, lambda name: hadoop.Path(f"{root.rstrip('/')}/{name}")


def number(spark: SparkSession, root: str) -> int:
    """The number of the version that holds, 0 before the first."""
    context, at = _context(spark, root)
    if not context.util().exists(at("pointer")):
        return 0
    return max((int(s.getPath().getName()) for s in context.util().listStatus(at("pointer")) if s.getPath().getName().isdigit()), default=0)


def _version(spark: SparkSession, root: str, seen: int) -> str:
    context, at = _context(spark, root)
    stream = context.open(at(f"pointer/{seen:010d}"))
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def read(spark: SparkSession, root: str, schema: str, seen: int | None = None) -> DataFrame:
    """The rows of the version that holds, or of version ``seen``; none before the first."""
    seen = number(spark, root) if seen is None else seen
    if not seen:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root.rstrip('/')}/versions/{_version(spark, root, seen)}")


def publish(df: DataFrame, root: str, seen: int) -> int:
    """Makes df the table's next version, the one after ``seen``; raises Moved where that is there already."""
    spark, name = df.sparkSession, uuid.uuid4().hex
    df.write.parquet(f"{root.rstrip('/')}/versions/{name}")
    context, at = _context(spark, root)
    hadoop = spark._jvm.org.apache.hadoop.fs
    context.mkdir(at("pointer"), hadoop.permission.FsPermission.getDirDefault(), True)
    part, final = at(f"pointer/.{name}"), at(f"pointer/{seen + 1:010d}")
    flags = spark._jvm.java.util.EnumSet.of(hadoop.CreateFlag.CREATE)
    stream = context.create(part, flags, spark._sc._gateway.new_array(hadoop.Options.CreateOpts, 0))
    stream.write(name.encode())
    stream.close()
    try:
        context.rename(part, final, spark._sc._gateway.new_array(hadoop.Options.Rename, 0))
    except Exception as error:
        if "FileAlreadyExists" not in str(error):
            raise
        for left in (part, at(f"versions/{name}")):
            context.delete(left, True)
        raise Moved(f"version {seen + 1} of {root} is there") from error
    return seen + 1
