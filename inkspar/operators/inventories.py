"""Inventories rebuilt from index lines, and held against stored ones capture by capture."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What an inventory says of a capture, beside its label, address and place in the label's list (newest first, from 0).
FIELDS = ["timestamp", "original", "digest", "warc_offset", "warc_length"]


def compared(rebuilt: DataFrame, stored: DataFrame, fields: list[str] = FIELDS) -> DataFrame:
    """(label, archive_url, outcome): equal, missing (not stored), unexpected (not in the index), repeated (stored twice), or the first field that differs."""
    a = rebuilt.select("label", "archive_url", F.struct(*fields).alias("a"))
    b = stored.groupBy("label", "archive_url").agg(F.min(F.struct(*fields)).alias("b"), F.count("*").alias("n"))
    outcome = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "unexpected").when(F.col("n") > 1, "repeated")
    for f in fields:
        outcome = outcome.when(~F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}")), f)
    return a.join(b, ["label", "archive_url"], "full").select("label", "archive_url", outcome.otherwise("equal").alias("outcome"))


def out_of_order(stored: DataFrame) -> DataFrame:
    """(label, position): places of stored lists that aren't newer than the next place, or have no place before them.

    Neighbours meet by an equality join, so no label's list is in one task.
    """
    rank = F.struct("timestamp", "original")
    here = stored.select("label", "position", rank.alias("here"))
    before = stored.select("label", (F.col("position") + 1).alias("position"), rank.alias("before"))
    return here.join(before, ["label", "position"], "left").filter((F.col("position") > 0) & ~F.coalesce(F.col("before") > F.col("here"), F.lit(False))).select("label", "position").distinct()


def totals(lines: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """One row: index_rows (the header aside), capture_count, label_count."""
    counted = rebuilt.agg(F.count("*").alias("capture_count"), F.count_distinct("label").alias("label_count"))
    return lines.agg((F.count("*") - 1).alias("index_rows")).crossJoin(F.broadcast(counted))


def verdict(rows: DataFrame, disorder: DataFrame, stated: Column, found: Column) -> DataFrame:
    """One row (captures, wrong, disordered, counts_agree, verified) of what compared and out_of_order give, and structs of counts."""
    one = rows.agg(F.count("*").alias("captures"), F.count_if(F.col("outcome") != "equal").alias("wrong"))
    other = disorder.agg(F.count("*").alias("disordered"))
    return one.crossJoin(F.broadcast(other)).withColumn("counts_agree", stated == found).withColumn("verified", (F.col("wrong") == 0) & (F.col("disordered") == 0) & F.col("counts_agree"))
