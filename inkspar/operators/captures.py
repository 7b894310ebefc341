"""Capture selection: the newest of each revision, candidates to replay, byte ranges, earlier revisions."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

DIGEST = "^[A-Z2-7]{32}$"
NO_DIGEST = "-"
GAP_BYTES, SPAN_BYTES = 512 * 1024, 20 * 1024 * 1024


def newest_first(by: Column | str, *also: Column | str):
    return Window.partitionBy(by, *also).orderBy(F.desc("timestamp"), F.desc("original"))


def revision_key(digest: Column, url: Column) -> Column:
    """Captures with equal known digests are one revision; one without a digest is its own."""
    return F.when((digest == NO_DIGEST) | digest.isNull(), F.concat(F.lit("url:"), url)).otherwise(digest)


def newest(captures: DataFrame) -> DataFrame:
    """The newest capture of each revision of each label. An aggregation with map-side partial results, so a label with very many captures is no burden."""
    keyed = captures.withColumn("revision", revision_key(F.col("digest"), F.col("archive_url")))
    best = F.max(F.struct("timestamp", "original", "digest", "archive_url")).alias("c")
    return keyed.groupBy("label", "revision").agg(best).select("label", "revision", "c.*")


def ranked(captures: DataFrame) -> DataFrame:
    """captures (label, timestamp, original, digest, archive_url) with revision, copy (1: the newest of its revision) and, for copy 1, place among the label's revisions, newest first."""
    keyed = captures.withColumn("revision", revision_key(F.col("digest"), F.col("archive_url")))
    copies = keyed.withColumn("copy", F.row_number().over(newest_first("label", "revision")))
    return copies.withColumn("place", F.when(F.col("copy") == 1, F.row_number().over(newest_first("label", F.col("copy") == 1))))


def inventory(captures: DataFrame) -> DataFrame:
    """One row for each label: its revisions' newest captures and the other captures, both newest first."""
    one = F.struct("timestamp", "original", "digest", "archive_url")
    pick = lambda keep: F.sort_array(F.collect_list(F.when(keep, one)), asc=False)
    return ranked(captures).groupBy("label").agg(pick(F.col("copy") == 1).alias("captures"), pick(F.col("copy") > 1).alias("alternates"))


def candidates(captures: DataFrame, revisions: int = 3, alternates: int = 2) -> DataFrame:
    """What to replay, in order: the newest revisions of each label, each followed by some older captures of the same known digest."""
    found = ranked(captures)
    firsts = found.filter((F.col("copy") == 1) & (F.col("place") <= revisions)).select("label", "revision", F.col("place").alias("first"))
    close = found.join(firsts, ["label", "revision"]).filter((F.col("copy") == 1) | ((F.col("copy") <= alternates + 1) & F.col("digest").rlike(DIGEST)))
    return close.withColumn("attempt", F.row_number().over(Window.partitionBy("label").orderBy("first", "copy"))).drop("first", "place")


#: Ranges of offsets that the rows of all files are dealt by.
OFFSET_RANGES = 64


def _islands(ranges: DataFrame, by: str, start: str, end: str, gap: int, pieces: int) -> DataFrame:
    """(file, a, b, island): the number, within its file, of the island that each range lies in; between islands is more than gap.

    Rows are ordered within ranges of offsets. What a range has to know of those before it, how far they reach and how many islands they begin, is one row for each range and file,
    so the rows of one file are in as many tasks as it has ranges. The driver gets the bounds.
    """
    rows = ranges.select(F.col(by).alias("file"), F.col(start).cast("bigint").alias("a"), F.col(end).cast("bigint").alias("b"))
    cuts = rows.agg(F.percentile_approx("a", [i / pieces for i in range(1, pieces)], 10_000).alias("c")).first()["c"] or []
    bounds = F.array(*[F.lit(c).cast("bigint") for c in sorted(set(cuts))]) if cuts else F.array().cast("array<bigint>")
    dealt = rows.withColumn("piece", F.size(F.filter(bounds, lambda x: x <= F.col("a"))))
    here = Window.partitionBy("file", "piece").orderBy("a", "b")
    before = Window.partitionBy("file").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)

    reach = dealt.groupBy("file", "piece").agg(F.max("b").alias("own")).withColumn("carry", F.max("own").over(before)).select(F.col("file").alias("f"), F.col("piece").alias("p"), "carry")
    same = lambda one, other: one["file"].eqNullSafe(other["f"]) & (one["piece"] == other["p"])
    local = dealt.withColumn("reach", F.max("b").over(here.rowsBetween(Window.unboundedPreceding, -1)))
    joined = local.join(reach, same(local, reach)).withColumn("reach", F.greatest("reach", "carry")).drop("f", "p", "carry")
    fresh = joined.withColumn("new", F.when(F.col("reach").isNull() | (F.col("a") - F.col("reach") > gap), 1).otherwise(0))
    begun = fresh.groupBy("file", "piece").agg(F.sum("new").alias("own")).withColumn("carry", F.coalesce(F.sum("own").over(before), F.lit(0))).select(F.col("file").alias("f"), F.col("piece").alias("p"), "carry")
    counted = fresh.withColumn("within", F.sum("new").over(here.rowsBetween(Window.unboundedPreceding, 0)))
    return counted.join(begun, same(counted, begun)).select("file", "a", "b", (F.col("carry") + F.col("within")).alias("island"))


def coalesce_gaps(ranges: DataFrame, by: str, start: str, end: str, gap: int = GAP_BYTES, pieces: int = OFFSET_RANGES) -> DataFrame:
    """Ranges of one file merged where the next starts at most gap behind the end so far: (by, group_start, group_end, members)."""
    grouped = _islands(ranges, by, start, end, gap, pieces).groupBy("file", "island")
    return grouped.agg(F.min("a").alias("group_start"), F.max("b").alias("group_end"), F.count("*").alias("members")).drop("island").withColumnRenamed("file", by)


def coalesce_ranges(ranges: DataFrame, by: str, start: str, end: str, gap: int = GAP_BYTES, span: int = SPAN_BYTES, pieces: int = OFFSET_RANGES) -> DataFrame:
    """As coalesce_gaps, and no group grows past span bytes.

    The gap rule leaves islands that no merge crosses. An island within span bytes is a group; only the
    rows of longer ones are cut in order of start, each island by itself, since where a group ends
    depends on where it began.
    """
    rows = _islands(ranges, by, start, end, gap, pieces)
    islands = rows.groupBy("file", "island").agg(F.min("a").alias("group_start"), F.max("b").alias("group_end"), F.count("*").alias("members"))
    short = islands.filter(F.col("group_end") - F.col("group_start") <= span).drop("island")
    long = rows.join(islands.filter(F.col("group_end") - F.col("group_start") > span).select("file", "island"), ["file", "island"], "left_semi")
    made = long.groupBy("file", "island").applyInPandas(_cut(gap, span), f"file {dict(rows.dtypes)['file']}, group_start bigint, group_end bigint, members bigint")
    return short.unionByName(made).withColumnRenamed("file", by)


def _cut(gap: int, span: int):
    def cut(rows: pd.DataFrame) -> pd.DataFrame:
        out: list[list] = []
        for a, b in rows.sort_values(["a", "b"])[["a", "b"]].itertuples(index=False):
            if out and a - out[-1][2] <= gap and b - out[-1][1] <= span:
                out[-1][2] = max(out[-1][2], b)
                out[-1][3] += 1
            else:
                out.append([rows["file"].iloc[0], a, b, 1])
        return pd.DataFrame(out, columns=["file", "group_start", "group_end", "members"])

    return cut


def earlier_revisions(records: DataFrame, captures: DataFrame) -> DataFrame:
    """records (label, timestamp, original, digest, latest_indexed_timestamp, selection_reason) with the first rule that each breaks, or null."""
    latest = captures.groupBy("label").agg(F.max("timestamp").alias("__latest"))
    indexed = captures.select("label", "timestamp", "original", "digest").distinct().withColumn("__indexed", F.lit(True))
    joined = records.join(latest, "label", "left").join(indexed, ["label", "timestamp", "original", "digest"], "left")
    problem = (
        F.when(F.col("__latest").isNull(), "unknown label")
        .when(F.col("timestamp") >= F.col("__latest"), "not earlier")
        .when(~F.col("latest_indexed_timestamp").eqNullSafe(F.col("__latest")), "latest differs")
        .when(F.col("__indexed").isNull(), "not indexed")
        .when(F.trim(F.coalesce("selection_reason", F.lit(""))) == "", "no reason")
    )
    return joined.withColumn("problem", problem).drop("__latest", "__indexed")


def _sha1_base32(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for bodies in batches:
        yield bodies.map(lambda b: None if b is None else base64.b32encode(hashlib.sha1(b).digest()).decode())


def sha1_base32(body: Column) -> Column:
    """The payload digest of capture indexes."""
    return F.pandas_udf(_sha1_base32, StringType())(body)


def equals_latest(bodies: DataFrame, captures: DataFrame) -> DataFrame:
    """bodies (label, timestamp, original, archive_url, body) with equal: whether the body has the digest of its label's newest capture, and the index lists that digest for it. Of captures of one time and address the greatest digest counts as the newest. Bodies stay as many as they are, however often the index lists their capture."""
    newest = captures.groupBy("label").agg(F.max(F.struct("timestamp", "original", "digest"))["digest"].alias("__digest"))
    listed = captures.select("label", "timestamp", "original", "archive_url", F.col("digest").alias("__digest")).distinct().withColumn("__listed", F.lit(True))
    joined = bodies.join(newest, "label", "left").join(listed, ["label", "timestamp", "original", "archive_url", "__digest"], "left")
    equal = F.col("__digest").rlike(DIGEST) & F.col("__listed") & (sha1_base32(F.col("body")) == F.col("__digest"))
    return joined.withColumn("equal", F.coalesce(equal, F.lit(False))).drop("__digest", "__listed")
