"""What the operators share: the shared folder, tables that cut lineage, range buckets."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is the one named by ``spark.checkpoint.dir``. Only where that is unset on a local master (tests) a folder
    of this process is made; on a cluster that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        kept = spark.sparkContext._jsc.sc().getCheckpointDir()
        if kept.isDefined():
            named = kept.get()
        else:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            named = "file://" + tempfile.mkdtemp(prefix="inkspar-")
            spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/inkspar/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{_own_dir(spark)}/{name}-{uuid.uuid4().hex}"


def clear(spark: SparkSession) -> None:
    """Deletes the tables and files that this application's operators have left in the shared folder; results that still read them can't be used after."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, as a Parquet table in the shared folder: lineage ends there, and a lost executor costs no more than a read."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_ONLY: dict = {}


def only(key: tuple, make: Callable):
    """What make returns, kept in this worker process under key until another key is asked for.

    Workers are used again from stage to stage, so tables that operators build there would add up otherwise.
    """
    if key not in _ONLY:
        release()
        _ONLY[key] = make()
    return _ONLY[key]


def release(trim: bool = False) -> None:
    """Lets go of what only() keeps: for tasks that need memory and none of it. If anything was kept, or with ``trim``, behind work that took much, memory that isn't used any more goes back to the system."""
    if not _ONLY and not trim:
        return
    _ONLY.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give_back is not None:
        give_back(0)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def range_bounds(df: DataFrame, key: str, n: int) -> list[int]:
    """At most n - 1 increasing bounds that cut the values of an integer key into ranges of about equal counts."""
    if n < 2:
        return []
    found = df.select(F.percentile_approx(key, [i / n for i in range(1, n)], max(10_000, 4 * n)).alias("b")).first()["b"]
    return sorted(set(found or []))


def range_bucket(key: Column, bounds: list[int]) -> Column:
    """The number of bounds at or below key (null: 0), found in two steps of about sqrt(n) comparisons each."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    coarse, fine = F.array(*[F.lit(b) for b in bounds[step::step]]), F.array(*[F.lit(b) for b in bounds])
    if len(bounds) <= step:
        return F.coalesce(F.size(F.filter(fine, lambda b: b <= key)), F.lit(0))
    at = F.size(F.filter(coarse, lambda b: b <= key)) * step
    return F.when(key.isNull(), F.lit(0)).otherwise(at + F.size(F.filter(F.slice(fine, at + 1, F.lit(step)), lambda b: b <= key)))


def frequent_floor(counts: DataFrame, n_col: str, most: int) -> int:
    """The least count such that at most ``most`` rows have it or more.

    Rows are counted in bands of counts, 32 to each doubling, so the driver gets a few hundred rows
    however many there are, and no task sorts them.
    """
    band = F.floor(F.log2(n_col) * 32)
    bands = counts.filter(F.col(n_col) > 0).groupBy(band.alias("band")).agg(F.count("*").alias("rows"), F.min(n_col).alias("least"))
    total, floor = 0, None
    for r in sorted(bands.collect(), key=lambda r: -r["band"]):
        total += r["rows"]
        if total > most:
            break
        floor = r["least"]
    return floor if floor is not None else (1 << 62)


def text_key(text: Column) -> Column:
    """Two hashes of a text, by which its rows are found again without Python."""
    return F.struct(F.xxhash64(text, F.isnull(text)).alias("a"), F.xxhash64(F.lit("b"), text).alias("b"))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have in any case: name, or name with as many "_" as it takes."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
