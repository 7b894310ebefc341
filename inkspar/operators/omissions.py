"""Reviewed omissions: sections left out of records, and proofs that they hold only what was reviewed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkspar.functions.text import collapse_space

LEAST_PASSAGE, LEAST_TOTAL = 200, 1000


def passages_hold(text: Column, passages: Column, least: int = LEAST_PASSAGE, total: int = LEAST_TOTAL) -> Column:
    """Whether ordered, separate passages (offset, length, sha256) of a text, white space collapsed, have their hashes, and enough length together."""
    clean = collapse_space(text)
    ends = F.transform(passages, lambda p: p["offset"] + p["length"])
    fits = F.forall(passages, lambda p: (p["length"] >= least) & (p["offset"] >= 0) & (p["offset"] + p["length"] <= F.length(clean)) & (F.sha2(F.substr(clean, p["offset"] + 1, p["length"]), 256) == p["sha256"]))
    ordered = F.forall(F.sequence(F.lit(1), F.greatest(F.size(passages) - 1, F.lit(1))), lambda i: F.coalesce(F.get(passages, i)["offset"] >= F.get(ends, i - 1), F.lit(True)))
    return F.coalesce(fits & ordered & (F.aggregate(passages, F.lit(0).cast("bigint"), lambda a, p: a + p["length"]) >= total), F.lit(False))


def outside(repairs: Column, start: Column, end: Column) -> Column:
    """The decoding repairs (byte_offset, byte_length) that don't touch the bytes from start to end."""
    return F.filter(repairs, lambda r: (r["byte_offset"] >= end) | (r["byte_offset"] + r["byte_length"] <= start))


def crossing(repairs: Column, start: Column, end: Column) -> Column:
    """Whether a repair crosses the border of an omitted range, so that neither side can be trusted."""
    touches = lambda r: (r["byte_offset"] < end) & (r["byte_offset"] + r["byte_length"] > start)
    return F.exists(repairs, lambda r: touches(r) & ~((r["byte_offset"] >= start) & (r["byte_offset"] + r["byte_length"] <= end)))


def cross_referenced(evidence: DataFrame, bodies: DataFrame) -> DataFrame:
    """evidence (id, reference_sha256, byte_offset, byte_length, range_sha256) with outcome: equal, no body, or differs. bodies: (sha256, body)."""
    joined = evidence.join(bodies.select(F.col("sha256").alias("reference_sha256"), "body"), "reference_sha256", "left")
    cut = F.sha2(F.substr(F.col("body"), F.col("byte_offset") + 1, F.col("byte_length")), 256)
    return joined.withColumn("outcome", F.when(F.col("body").isNull(), "no body").when(cut == F.col("range_sha256"), "equal").otherwise("differs")).drop("body")


def own_reason() -> Column:
    """The first reason in a record itself against its export, or null, by the columns warnings, license_url, source_sections_complete and omissions."""
    return (
        F.when(F.size("warnings") > 0, "warnings")
        .when(~F.col("license_url").eqNullSafe(F.lit("https://creativecommons.org/licenses/by-sa/2.0/")), "licence")
        .when((F.size("omissions") > 0) & F.coalesce(F.col("source_sections_complete"), F.lit(True)), "omissions in a complete record")
        .when((F.size("omissions") == 0) & (F.col("source_sections_complete") == F.lit(False)), "incomplete without omissions")
    )


def exportable(record: DataFrame) -> DataFrame:
    """The rows with the first reason of their own against export, or null."""
    return record.withColumn("reason", own_reason())


#: What binds a reviewed omission to a record, as the review's and the record's columns.
BINDINGS = ("response_sha256", "source_url", "label", "id")


def validated(records: DataFrame, reviews: DataFrame, key: str) -> DataFrame:
    """(key, problem): the first rule that a record's omissions break, or null.

    records: key, the BINDINGS, omissions (array of structs of the reviews' columns), section_kinds, source_sections_complete; reviews, the manifest of what
    persons reviewed: the BINDINGS, section and further columns. A record may leave out only what a review of its own response, address, label and id names,
    word for word; it must say that it is incomplete, and the section mustn't be in it.
    """
    fields = reviews.columns
    each = records.select(key, *[F.col(b).alias(f"own_{b}") for b in BINDINGS], "section_kinds", "source_sections_complete", F.posexplode_outer("omissions").alias("place", "o"))
    named = each.select("*", *[F.col(f"o.{f}").alias(f) for f in fields])
    known = reviews.dropDuplicates().withColumn("__reviewed", F.lit(True))
    same = F.lit(True)
    for f in fields:
        same = same & named[f].eqNullSafe(known[f])
    # Equality on the response's hash deals the rows; the other columns are compared where these meet.
    joined = named.join(known, (named["response_sha256"] == known["response_sha256"]) & same, "left").select(named["*"], known["__reviewed"])
    there = F.col("o").isNotNull()
    problem = F.when(there & (F.coalesce("source_sections_complete", F.lit(True)) != F.lit(False)), "no mark of an incomplete source").when(there & F.col("__reviewed").isNull(), "not reviewed")
    for b in BINDINGS:
        problem = problem.when(there & ~F.col(b).eqNullSafe(F.col(f"own_{b}")), f"another {b}")
    problem = problem.when(there & F.array_contains("section_kinds", F.col("section")), "the section is still there")
    return joined.withColumn("problem", problem).groupBy(key).agg(F.min_by("problem", F.when(F.col("problem").isNotNull(), F.col("place"))).alias("problem"))


#: Code points of a piece of a body.
PIECE = 1 << 16


def pieces(bodies: DataFrame, sha: str, text: str, size: int = PIECE) -> DataFrame:
    """(sha256, piece, part): the texts of bodies, white space collapsed, in pieces of ``size`` code points, each body once."""
    one = bodies.groupBy(F.col(sha).alias("sha256")).agg(F.first(F.col(text)).alias("whole")).withColumn("whole", F.trim(collapse_space(F.coalesce("whole", F.lit("")))))
    starts = F.sequence(F.lit(0), F.floor(F.greatest(F.length("whole") - 1, F.lit(0)) / size).cast("int"))
    return one.select("sha256", F.explode(F.transform(starts, lambda i: F.struct(i.alias("piece"), F.substr(F.col("whole"), i * size + 1, F.lit(size)).alias("part")))).alias("p")).select("sha256", "p.piece", "p.part")


def referenced(passages: DataFrame, parts: DataFrame, key: str, size: int = PIECE) -> DataFrame:
    """(key, place, outcome) of passages in their reference bodies: equal, differs, outside (past its end, or of no length), or no body.

    passages: key, place, reference_sha256, offset, length, sha256; parts: what ``pieces`` gives. A passage is joined to the pieces that it touches by their
    numbers, each gives the part that is the passage's, and these are put in order and hashed; so no row carries a body, and a body that most passages name is met piece by piece.
    """
    asked = passages.select(key, "place", F.col("reference_sha256").alias("sha256"), F.col("offset").cast("long").alias("offset"), F.col("length").cast("long").alias("length"), F.col("sha256").alias("wanted"))
    sound = F.coalesce((F.col("offset") >= 0) & (F.col("length") > 0), F.lit(False))
    touched = F.when(sound, F.sequence(F.floor(F.col("offset") / size), F.floor((F.col("offset") + F.col("length") - 1) / size))).otherwise(F.array(F.lit(-1).cast("long")))
    rows = asked.select("*", sound.alias("sound"), F.explode(touched).alias("piece"))
    begin = F.greatest(F.col("offset") - F.col("piece") * size, F.lit(0)).cast("int")
    end = F.least(F.col("offset") + F.col("length") - F.col("piece") * size, F.lit(size)).cast("int")
    met = rows.join(parts.select("sha256", F.col("piece").cast("long").alias("piece"), "part"), ["sha256", "piece"], "left")
    cut = F.struct("piece", F.substr(F.col("part"), begin + 1, end - begin).alias("cut"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("part").isNotNull(), cut))), lambda p: p["cut"]), "")
    found = met.groupBy(key, "place", "sha256", "length", "wanted", "sound").agg(whole.alias("found"))
    there = parts.select("sha256").distinct().withColumn("__there", F.lit(True))
    outcome = F.when(F.col("__there").isNull(), "no body").when(~F.col("sound") | (F.length("found") < F.col("length")), "outside").when(F.sha2("found", 256) == F.col("wanted"), "equal").otherwise("differs")
    return found.join(there, "sha256", "left").select(key, "place", outcome.alias("outcome"))


def credit_holds(own: Column, shown: Column, notice: str, referenced_outcomes: Column) -> Column:
    """Whether a reviewed credit may stand: the section shows the notice itself, or its passages hold in it (``own``) and all of them, of which there is one at least, in one reference that shows the notice."""
    return F.coalesce(shown.rlike(notice), F.lit(False)) | F.coalesce(own & (F.size(referenced_outcomes) > 0) & F.forall(referenced_outcomes, lambda o: o == "equal"), F.lit(False))
