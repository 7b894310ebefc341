"""Joins, gates, sets and differences of archive tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def joined_state(records: DataFrame, states: DataFrame, key: str, compare: list[str]) -> DataFrame:
    """records with outcome: exportable, no state, the state's own status where it isn't parsed, or what differs.

    states has the key, status, and the columns to compare.
    """
    other = states.select(key, F.col("status").alias("__status"), *[F.col(c).alias(f"__{c}") for c in compare], F.lit(True).alias("__there"))
    differs = reduce(lambda found, c: found.when(~F.col(c).eqNullSafe(F.col(f"__{c}")), f"{c} differs"), compare, F.when(F.col("__there").isNull(), "no state").when(~F.col("__status").eqNullSafe(F.lit("parsed")), F.coalesce("__status", F.lit("no status"))))
    joined = records.join(other, key, "left").withColumn("outcome", differs.otherwise("exportable"))
    return joined.drop("__status", "__there", *[f"__{c}" for c in compare])


def membership(category: Column, verified: Column, decision: Column, kinds: tuple[str, ...] = ("grammar", "lesson")) -> Column:
    """Struct (status, reason): parsed if the category, a verified current id or a reviewed decision admits the entry; a reviewed exclusion excludes; an unknown category waits for review."""
    return (
        F.when(F.coalesce(category.isin(*kinds), F.lit(False)), F.struct(F.lit("parsed").alias("status"), F.lit("category").alias("reason")))
        .when(F.coalesce(verified, F.lit(False)), F.struct(F.lit("parsed").alias("status"), F.lit("verified current id").alias("reason")))
        .when(F.coalesce(decision == "include", F.lit(False)), F.struct(F.lit("parsed").alias("status"), F.lit("reviewed").alias("reason")))
        .when(F.coalesce(decision == "exclude", F.lit(False)) | category.isNotNull(), F.struct(F.lit("excluded").alias("status"), F.lit("outside the collection").alias("reason")))
        .otherwise(F.struct(F.lit("review_required").alias("status"), F.lit("no category").alias("reason")))
    )


def first_wins(parts: list[DataFrame], key: str, within: Column, first_part_last_wins: bool = False) -> DataFrame:
    """One row for each key, from the earliest part that has it; within orders rows of one part (the last wins in the first part if asked)."""
    tagged = [p.withColumn("__part", F.lit(i)).withColumn("__order", within if i or not first_part_last_wins else -within) for i, p in enumerate(parts)]
    order = Window.partitionBy(key).orderBy("__part", "__order")
    return reduce(DataFrame.unionByName, tagged).withColumn("__n", F.row_number().over(order)).filter("__n = 1").drop("__n", "__part", "__order")


def differences(old: DataFrame, new: DataFrame, keys: list[str], content: str) -> DataFrame:
    """keys and change: added, removed, updated or unchanged, by one full outer join."""
    a = old.select(*keys, F.struct(F.col(content).alias("v")).alias("__old"))
    b = new.select(*keys, F.struct(F.col(content).alias("v")).alias("__new"))
    change = F.when(F.col("__old").isNull(), "added").when(F.col("__new").isNull(), "removed").when(F.col("__old.v").eqNullSafe(F.col("__new.v")), "unchanged").otherwise("updated")
    return a.join(b, keys, "full").select(*keys, change.alias("change"))


def zipped(left: DataFrame, right: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Positional pairing: keys, left_value, right_value and side (both, left only, right only)."""
    a, b = left.select(*keys, F.struct(F.col(value)).alias("__l")), right.select(*keys, F.struct(F.col(value)).alias("__r"))
    side = F.when(F.col("__r").isNull(), "left only").when(F.col("__l").isNull(), "right only").otherwise("both")
    return a.join(b, keys, "full").select(*keys, F.col(f"__l.{value}").alias("left_value"), F.col(f"__r.{value}").alias("right_value"), side.alias("side"))


def missing(wanted: DataFrame, present: DataFrame, key: str) -> DataFrame:
    return wanted.select(key).distinct().join(present.select(key).distinct(), key, "left_anti")


def selected(df: DataFrame, key: str, chosen: DataFrame) -> DataFrame:
    """The rows whose key is chosen; a chosen key without a row is an error."""
    unknown = [r[0] for r in missing(chosen, df, key).limit(5).collect()]
    if unknown:
        raise ValueError(f"not in the inventory: {unknown}")
    return df.join(chosen.select(key).distinct(), key, "left_semi")


def closure(edges: DataFrame, starts: DataFrame, source: str = "source", target: str = "target") -> DataFrame:
    """(node, depth) of everything that can be reached from the starts, each at its least depth.

    One step is one join of the newly found with the edges; each step is cut from the last by a checkpoint
    in the shared folder.
    """
    from inkspar.operators.shared import cut

    found = cut(starts.select(F.col(starts.columns[0]).alias("node")).distinct().withColumn("depth", F.lit(0)))
    fresh = found
    depth = 0
    while not fresh.isEmpty():
        depth += 1
        reached = fresh.join(edges, F.col("node") == F.col(source)).select(F.col(target).alias("node")).distinct()
        fresh = cut(reached.join(found, "node", "left_anti").withColumn("depth", F.lit(depth)))
        # so that the plan of all steps together stays short
        found = found.unionByName(fresh) if depth % 8 else cut(found.unionByName(fresh))
    return found


def failure_runs(attempts: DataFrame, by: str, order: str, failed: Column, limit: int = 3) -> DataFrame:
    """attempts with streak (failures in a row up to here) and stopped (some streak before or here reached the limit)."""
    w = Window.partitionBy(by).orderBy(order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    bad = F.coalesce(failed, F.lit(False))
    runs = attempts.withColumn("__run", F.sum(F.when(bad, 0).otherwise(1)).over(upto)).withColumn("__bad", bad.cast("int"))
    streak = F.sum("__bad").over(Window.partitionBy(by, "__run").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    counted = runs.withColumn("streak", streak)
    return counted.withColumn("stopped", F.max("streak").over(upto) >= limit).drop("__run", "__bad")


def page_gaps(pages: DataFrame, by: str, page: str) -> DataFrame:
    """Each page with problem: gap (not one behind the page before), repeated, or null."""
    before = F.lag(page).over(Window.partitionBy(by).orderBy(page))
    problem = F.when(F.col(page) == before, "repeated").when(before.isNotNull() & (F.col(page) != before + 1), "gap")
    return pages.withColumn("problem", problem)
