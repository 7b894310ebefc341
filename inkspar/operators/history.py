"""What held at a time: as-of joins with histories, and records held against the inventory and states of their time and of now."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkspar.operators import shared
from inkspar.operators.gates import PARSED

#: Time ranges that an as-of join is cut into.
RANGES = 64


def as_of(left: DataFrame, right: DataFrame, by: str, at: str, since: str, fields: list[str], ranges: int = RANGES) -> DataFrame:
    """left with the fields of the last row of right, of the same key, that began at or before ``at``; null fields where there is none.

    Times are whole numbers. They are cut into ranges of about equal numbers of rows, and a key's rows of one range are sorted by themselves; a last row of each
    range is carried to the following ones, so of a key with most of all rows no task gets more than a range. Of rows of right that began at one time that with the
    greatest fields holds. Rows of left that repeat stay as often; those with a null key or time get null fields.
    left is read three times, so one that takes work should be stored before.
    """
    taken = set(left.columns)
    if taken & set(fields):
        raise ValueError("left has columns that are named as the fields")
    cuts = left.select(F.col(at).alias("t")).unionByName(right.select(F.col(since).alias("t"))).agg(F.percentile_approx("t", [i / ranges for i in range(1, ranges)], 10_000).alias("c")).first()["c"] or []
    bounds = F.array(*[F.lit(c).cast("long") for c in sorted(set(cuts))]) if cuts else F.array().cast("array<long>")
    bucket = F.size(F.filter(bounds, lambda b: b <= F.col("__t")))
    value = F.struct(*fields)
    rows = left.select(F.col(by).alias("__by"), F.col(at).cast("long").alias("__t"), F.lit(1).alias("__kind"), F.struct(*left.columns).alias("__left"), F.lit(None).cast(right.select(value.alias("v")).schema["v"].dataType).alias("__value"))
    known = right.select(F.col(by).alias("__by"), F.col(since).cast("long").alias("__t"), F.lit(0).alias("__kind"), F.lit(None).cast(rows.schema["__left"].dataType).alias("__left"), value.alias("__value")).filter("__by IS NOT NULL AND __t IS NOT NULL")
    both = rows.unionByName(known).withColumn("__range", bucket)
    last = both.groupBy("__by", "__range").agg(F.max(F.when(F.col("__kind") == 0, F.struct("__t", "__value"))).alias("__last"))
    carried = last.select("__by", "__range", F.last("__last", ignorenulls=True).over(Window.partitionBy("__by").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)).alias("__carry"))
    order = Window.partitionBy("__by", "__range").orderBy("__t", "__kind", "__value").rowsBetween(Window.unboundedPreceding, 0)
    within = both.withColumn("__found", F.last("__value", ignorenulls=True).over(order)).filter("__kind = 1")
    # a null key has nothing to be carried; plain keys are those that the rows are dealt out by already
    joined = within.join(carried, ["__by", "__range"], "left").withColumn("__held", F.coalesce("__found", F.col("__carry")["__value"]))
    timed = F.col("__left")[at].isNotNull() & F.col("__left")[by].isNotNull()
    return joined.select(*[F.col("__left")[c].alias(c) for c in left.columns], *[F.when(timed, F.col("__held")[f]).alias(f) for f in fields])


def observations(records: DataFrame, captures: DataFrame, inventories: DataFrame, states: DataFrame, key: str) -> DataFrame:
    """records with outcome: latest or earlier, or what keeps them from being exported as such.

    records: key, label, timestamp, original, archive_url, digest, latest_indexed_timestamp, record_sha256, selection_reason, checked_at;
    captures, the inventory of now: label, timestamp, original, archive_url, digest; inventories: label, seen_at, newest (timestamp); states: key, stated_at,
    status, stated_sha256. A record is bound to the newest capture that the inventory of its check knew; where that of now knows another, the choice has to be made again.
    """
    records = shared.stored(records, "observed")
    newest = captures.groupBy("label").agg(F.max("timestamp").alias("__now"))
    listed = captures.select("label", "timestamp", "original", "archive_url", "digest").distinct().withColumn("__listed", F.lit(True))
    then = shared.stored(as_of(records, inventories, "label", "checked_at", "seen_at", ["newest"]), "bound")
    stated = as_of(then, states, key, "checked_at", "stated_at", ["status", "stated_sha256"])
    joined = stated.join(newest, "label", "left").join(listed, ["label", "timestamp", "original", "archive_url", "digest"], "left")
    outcome = (
        F.when(F.col("__now").isNull(), "unknown label").when(F.col("__listed").isNull(), "unknown capture")
        .when(~F.col("latest_indexed_timestamp").eqNullSafe(F.col("newest")), "not bound to the inventory of its time")
        .when(~F.col("newest").eqNullSafe(F.col("__now")), "changed inventory")
        .when(F.col("status").isNull(), "no state").when((F.col("status") != PARSED) | ~F.col("stated_sha256").eqNullSafe(F.col("record_sha256")), "another state")
        .when(F.col("timestamp") == F.col("__now"), "latest").when(F.trim(F.coalesce("selection_reason", F.lit(""))) == "", "no reason").otherwise("earlier")
    )
    return joined.withColumn("outcome", outcome).select(*records.columns, "outcome")
