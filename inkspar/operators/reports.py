"""Reports of what a write wrote, gathered while it runs: no second scan, and no rows at the driver but one of numbers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

#: Outcomes of captures.
STATUSES = ("parsed", "excluded", "review_required", "failed", "pending")


def observed_write(df: DataFrame, write: Callable[[DataFrame], None], **metrics: Column) -> dict:
    """Runs write(df) and returns the metrics, aggregates over the rows that it wrote. A write that fails gives no report but its error."""
    seen = Observation()
    write(df.observe(seen, *[m.alias(n) for n, m in metrics.items()]))
    return seen.get


def crawl_metrics(status: Column) -> dict[str, Column]:
    """Numbers of rows of each status, of all, and whether nothing is left to do."""
    counts = {s: F.count_if(status == s) for s in STATUSES}
    return counts | {"rows": F.count(F.lit(1)), "unknown": F.count_if(~F.coalesce(status.isin(*STATUSES), F.lit(False))), "complete": F.coalesce(F.bool_and(F.coalesce(status.isin("parsed", "excluded"), F.lit(False))), F.lit(False))}


def request_metrics(sent: Column, bytes_: Column, failed: Column) -> dict[str, Column]:
    """Numbers of requests and failures, bytes, and the times of the first and last."""
    return {"requests": F.count(F.lit(1)), "bytes": F.coalesce(F.sum(bytes_), F.lit(0)), "failures": F.count_if(failed), "first_at": F.min(sent), "last_at": F.max(sent)}


def coverage_metrics(indexed: Column, captured: Column) -> dict[str, Column]:
    """Numbers of labels that are indexed, captured, both, and whether the collection is covered."""
    return {"indexed": F.count_if(indexed), "captured": F.count_if(captured), "pending": F.count_if(indexed & ~captured), "unexpected": F.count_if(captured & ~indexed), "covered": F.coalesce(F.bool_and(captured | ~indexed), F.lit(False))}


def one_row(df: DataFrame, **parts: dict) -> DataFrame:
    """The reports as one nested row: a struct for each part, its fields of the types of their values, whole numbers as longs."""
    literal = lambda v: F.lit(v).cast("long") if isinstance(v, int) and not isinstance(v, bool) else F.lit(v)
    return df.sparkSession.range(1).select(*[F.struct(*[literal(v).alias(n) for n, v in part.items()]).alias(name) for name, part in parts.items()])
