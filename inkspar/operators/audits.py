"""Audits as reports: rows of checks that fail, outcomes by key, and the flags that follow from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkspar.functions.urls import quoted, replay_parts
from inkspar.operators.normalize import violations


def reextracted(stored: DataFrame, extracted: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, outcome): equal, missing (not extracted), unexpected (not stored), or the first field that differs."""
    a, b = stored.select(key, F.struct(*fields).alias("__a")), extracted.select(key, F.struct(*fields).alias("__b"))
    start = F.when(F.col("__b").isNull(), "missing").when(F.col("__a").isNull(), "unexpected")
    outcome = reduce(lambda found, f: found.when(~F.col(f"__a.{f}").eqNullSafe(F.col(f"__b.{f}")), f), fields, start).otherwise("equal")
    return a.join(b, key, "full").select(key, outcome.alias("outcome"))


def report(checks: list[tuple[str, DataFrame]]) -> DataFrame:
    """(check_name, n_bad)."""
    return violations(checks).withColumnRenamed("n_rows", "n_bad")


def summary(rows: DataFrame, by: str, outcome: str = "outcome") -> DataFrame:
    """(by, checked, failed, complete) of rows with an outcome; complete is the conjunction that gates an export."""
    return rows.groupBy(by).agg(F.count("*").alias("checked"), F.count_if(F.col(outcome) != "equal").alias("failed"), F.bool_and(F.col(outcome) == "equal").alias("complete"))


def inventory_outcome(ids: Column, stated: Column) -> Column:
    """equal, or what a saved inventory's list breaks: its stated count, uniqueness or ascending order."""
    return F.when(F.size(ids) != stated, "count").when(F.size(F.array_distinct(ids)) != F.size(ids), "repeated").when(F.array_sort(ids) != ids, "order").otherwise("equal")


def replay_agrees(replay: Column, timestamp: Column, original: Column) -> Column:
    """Whether a replay address holds the stamp and the original, as it is or quoted."""
    found = replay_parts(replay)
    return F.coalesce((found["timestamp"] == timestamp) & ((found["original"] == original) | (found["original"] == quoted(original))), F.lit(False))
