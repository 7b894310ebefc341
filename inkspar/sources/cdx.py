"""Capture indexes: JSON pages with a resume key, and space-separated lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspar.functions.urls import Scope, label_column, quoted
from inkspar.operators import shared
from inkspar.operators.normalize import assert_none
from inkspar.sources import gzindex

# Fixed values of the index formats.
HEADER = "CDX N b a m s k r M S V g"
FIELDS = ("timestamp", "original", "mimetype", "digest")
KEPT_TYPES = ("text/html", "warc/revisit")
MAX_MEMBER = 2 << 20


def _address(timestamp: Column, original: Column, scope: Scope) -> Column:
    return quoted(F.concat(F.lit(f"https://{scope.archive_host}/web/"), timestamp, F.lit("id_/"), original))


def json_rows(pages: DataFrame, body: str = "body") -> DataFrame:
    """pages with the index's header, rows (place, row) and resume key; empty rows are left out.

    A row of one field is the resume key; rows of another width than the header, several resume keys, or a
    header without the needed fields raise an error.
    """
    parsed = pages.withColumn("__all", F.from_json(F.col(body), "array<array<string>>"))
    parsed = parsed.withColumn("header", F.get("__all", F.lit(0))).withColumn("__rows", F.filter(F.expr("slice(__all, 2, greatest(size(__all) - 1, 0))"), lambda r: F.size(r) > 0))
    keys = F.filter("__rows", lambda r: F.size(r) == 1)
    rows = F.filter("__rows", lambda r: F.size(r) > 1)
    problem = (
        F.when(F.col("__all").isNull(), "not an index")
        .when((F.size("__all") > 0) & (F.size(F.array_intersect("header", F.array(*map(F.lit, FIELDS)))) < len(FIELDS)), "unexpected fields")
        .when(F.size(keys) > 1, "several resume keys")
        .when(F.exists(rows, lambda r: F.size(r) != F.size("header")), "a row of another width")
    )
    checked = parsed.withColumn("problem", problem).withColumn("resume_key", F.get(F.get(keys, F.lit(0)), F.lit(0)))
    return checked.withColumn("__found", rows).drop("__all", "__rows").withColumnRenamed("__found", "rows")


def json_captures(pages: DataFrame, scope: Scope, body: str = "body") -> DataFrame:
    """(label, timestamp, original, mimetype, digest, archive_url) of an index's rows in scope."""
    found = json_rows(pages, body)
    found = found.withColumn("rows", F.when(F.col("problem").isNotNull(), F.raise_error(F.col("problem"))).otherwise(F.col("rows")))
    named = found.select(F.explode(F.transform("rows", lambda r: F.map_from_arrays("header", r))).alias("m")).select(*[F.col("m")[f].alias(f) for f in FIELDS])
    bad = ~F.col("timestamp").rlike(r"^\d{14}$")
    named = named.withColumn("timestamp", F.when(bad, F.raise_error(F.lit("a malformed timestamp"))).otherwise(F.col("timestamp")))
    kept = named.filter(F.col("mimetype").isin(*KEPT_TYPES)).withColumn("label", label_column(F.col("original"), scope)).filter("label IS NOT NULL")
    return kept.select("label", *FIELDS, _address(F.col("timestamp"), F.col("original"), scope).alias("archive_url"))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(place, fields) of an index file's lines, gzip or not, after its header was checked; a gzip file is one task, as it can't be split."""
    raw = spark.read.text(path).select(F.monotonically_increasing_id().alias("place"), F.trim("value").alias("value"))
    head = raw.orderBy("place").first()
    if head is None or head["value"] != HEADER:
        raise ValueError("not the expected index header")
    return raw.filter(F.col("value") != HEADER).select("place", F.split("value", r"\s+").alias("fields"))


def line_rows(found: DataFrame, scope: Scope, first: str, last: str, container: str, max_member: int = MAX_MEMBER) -> DataFrame:
    """The index lines of successful HTML pages in scope, their fields beside their place, label and address, and whether they are ``sound``, within the bounds on stamp, digest, container and length.

    Lines of another number of fields are there too, without a label and not sound. Nothing raises an error here: Spark may test a
    filter below a join, on pieces of lines that the join takes away.
    """
    names = ("key", "timestamp", "original", "mimetype", "status", "digest", "redirect", "meta", "length", "offset", "container")
    width = F.size("fields") == len(names)
    rows = found.select("place", width.alias("width"), *[F.get("fields", F.lit(i)).alias(n) for i, n in enumerate(names)])
    rows = rows.withColumn("label", F.when(F.col("width"), label_column(F.col("original"), scope))).filter("NOT width OR (status = '200' AND mimetype = 'text/html' AND label IS NOT NULL)")
    good = F.col("timestamp").rlike(r"^\d{14}$") & F.col("timestamp").between(first, last) & F.col("digest").rlike("^[A-Z2-7]{32}$") & (F.col("container") == container) & F.col("length").rlike(r"^\d{1,12}$") & F.col("offset").rlike(r"^\d{1,18}$")
    good = good & F.coalesce(F.try_to_number("length", F.lit("999999999999")).between(1, max_member), F.lit(False))
    return rows.withColumn("sound", F.coalesce(F.col("width") & good, F.lit(False))).withColumn("archive_url", _address(F.col("timestamp"), F.col("original"), scope))


def first_lines(rows: DataFrame) -> DataFrame:
    """The captures of line_rows: of each address the line whose place is first. An aggregation with partial results where the lines are, so no order of all lines is needed."""
    kept = F.min(F.struct("place", "label", "timestamp", "original", "mimetype", "digest", "offset", "length")).alias("c")
    one = rows.groupBy("archive_url").agg(kept)
    return one.select(*[f"c.{n}" for n in ("label", "timestamp", "original", "mimetype", "digest")], "archive_url", F.col("c.offset").cast("bigint").alias("warc_offset"), F.col("c.length").cast("bigint").alias("warc_length"))


def line_captures(found: DataFrame, scope: Scope, first: str, last: str, container: str, max_member: int = MAX_MEMBER) -> DataFrame:
    """The captures of index lines in scope: successful HTML pages, the first line of each address.

    A line that is in scope but breaks a bound (stamp, digest, container, length) raises an error.
    """
    rows = line_rows(found, scope, first, last, container, max_member)
    return first_lines(rows.withColumn("label", F.when(F.col("sound"), F.col("label")).otherwise(F.raise_error(F.when(F.col("width"), "an index line in scope breaks a bound").otherwise("a malformed index line")))))


def member_lines(spark: SparkSession, path: str, split_bytes: int | None = None) -> DataFrame:
    """(place, fields) of gzip index files of many members, read by many tasks; place is (file, member, line). Each file must open with the header.

    The files are unpacked once, into the folder that driver and executors share; their checks and lines are read from there."""
    pieces = shared.stored(gzindex.pieces(spark, path, split_bytes or gzindex.SPLIT_BYTES), "pieces")
    found = gzindex.lines(pieces).select(F.struct("file", "member", F.col("place").alias("line")).alias("place"), F.trim("line").alias("value"))
    opens = (F.col("place.member") == 0) & (F.col("place.line") == 0)
    assert_none([("index files without the header", found.filter(opens & (F.col("value") != HEADER)))])
    # Null for the header too: a check of fields that is pushed below this filter must not meet it.
    return found.filter(~opens).select("place", F.when(~opens, F.split("value", r"\s+")).alias("fields"))
