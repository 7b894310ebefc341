"""Streaming forms: captures as they arrive, with bounded state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def counts_by_window(events: DataFrame, time: str, kind: str, width: str = "1 hour", lateness: str = "10 minutes") -> DataFrame:
    """(window_start, kind, n): rows of each kind by time window; later ones than the watermark allows are left out."""
    found = events.withWatermark(time, lateness).groupBy(F.window(time, width).alias("w"), kind).agg(F.count("*").alias("n"))
    return found.select(F.col("w.start").alias("window_start"), kind, "n")


def first_of_revision(captures: DataFrame, time: str, lateness: str = "1 day") -> DataFrame:
    """The first row of each (label, digest) within the watermark: what is new enough to be parsed."""
    return captures.withWatermark(time, lateness).dropDuplicatesWithinWatermark(["label", "digest"])


def newest_by_label(captures: DataFrame) -> DataFrame:
    """(label, timestamp, original) of each label's newest capture; for update or complete output."""
    return captures.groupBy("label").agg(F.max(F.struct("timestamp", "original")).alias("m")).select("label", "m.timestamp", "m.original")
