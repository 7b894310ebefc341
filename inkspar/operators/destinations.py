"""Destinations of an export, checked before anything is written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normal(path: Column) -> Column:
    """A path without repeated, trailing or ``.`` steps. A step ``..`` could lead anywhere and makes it null."""
    steps = F.filter(F.split(path, "/"), lambda s: (s != "") & (s != "."))
    lead = F.when(F.startswith(path, F.lit("/")), "/").otherwise("")
    return F.when(~F.array_contains(steps, ".."), F.concat(lead, F.array_join(steps, "/")))


def overlaps(destinations: DataFrame, key: str, path: str) -> DataFrame:
    """(key, other, kind): pairs of destinations that are equal (other is the greater key), or of which the one of ``key`` lies inside the other's.

    Every path is spelled out as the folders above it, and these are joined to the paths by equality: a trie without a tree. No two rows are compared that don't overlap,
    and equal paths are first reduced to the least key, so that many of one make as many rows and not their square. Null paths and such with ``..`` overlap nothing.
    """
    rows = destinations.select(F.col(key).alias("key"), normal(F.col(path)).alias("path")).filter("path IS NOT NULL")
    # The root and the empty path, the folder that relative paths start from, are above all of their kind.
    steps = F.split(F.regexp_replace("path", "^/", ""), "/")
    lead = F.when(F.startswith("path", F.lit("/")), "/").otherwise("")
    above = F.transform(F.sequence(F.lit(0), F.size(steps) - 1), lambda n: F.concat(lead, F.array_join(F.slice(steps, F.lit(1), n), "/")))
    first = rows.groupBy("path").agg(F.min("key").alias("other"))
    inside = rows.filter("path NOT IN ('', '/')").select("key", F.explode(above).alias("path")).join(first, "path").select("key", "other", F.lit("inside").alias("kind"))
    equal = rows.join(first, "path").filter(F.col("key") != F.col("other")).select(F.col("other").alias("key"), F.col("key").alias("other"), F.lit("equal").alias("kind"))
    return inside.unionByName(equal).select(F.col("key").alias(key), "other", "kind")
