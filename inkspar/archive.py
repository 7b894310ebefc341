"""A whole archive: record folders in, gates, relations, checks, and the exports."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspar import schemas
from inkspar.functions.text import observation_key, record_digest
from inkspar.functions.urls import Scope
from inkspar.operators import audits, coverage, destinations, inventories, nested, normalize, reports, shared, verification
from inkspar.operators import captures as selection
from inkspar.operators import gates as rules
from inkspar.sources import captured, cdx, published, records, sinks

#: What stands beside records: a line of JSON for each state, hold and cached response.
STATE, HOLD, RESPONSE = "key string, status string, record_sha256 string", "key string, hold string", "url_sha256 string, retrieved_at string, response_sha256 string"

#: The kind of observations of a capture that isn't their label's newest.
EARLIER = "earlier-indexed-revision"
DATA_LICENCE = "https://creativecommons.org/licenses/by-sa/2.0/"


def current(spark: SparkSession, folder: str) -> DataFrame:
    """(path, record_json and the fields) of current records."""
    rows = records.read(spark, folder)
    return rows.select("path", "record_json", F.from_json("record_json", schemas.ENTRY).alias("e")).select("path", "record_json", "e.*")


def observations(spark: SparkSession, folder: str) -> DataFrame:
    """Historical records, those nested in others included, each with its key."""
    rows = records.read(spark, folder).select("path", "record_json")
    nested = F.coalesce(F.from_json(F.get_json_object("record_json", "$.additional_entries"), "array<string>"), F.array().cast("array<string>"))
    flat = rows.select("path", F.posexplode(F.concat(F.array("record_json"), nested)).alias("place", "record_json"))
    parsed = flat.select("path", "place", "record_json", F.from_json("record_json", schemas.OBSERVATION).alias("e")).select("path", "place", "record_json", "e.*")
    return parsed.withColumn("key", observation_key(F.col("snapshot"), F.col("place"), F.col("id"), F.concat_ws("/", "label", "archive_timestamp")))


def foreign_entries(entries: DataFrame) -> DataFrame:
    """(path, field): what entries nested in one page's record don't share with it, of all that says which capture they are from."""
    at = {f: F.get_json_object("record_json", f"$.{f}") for f in nested.PROVENANCE}
    alike = lambda c: F.min(c).eqNullSafe(F.max(c)) & F.count(c).isin(F.lit(0), F.count(F.lit(1)))
    found = entries.groupBy("path").agg(F.array_compact(F.array(*[F.when(~alike(c), F.lit(f)) for f, c in at.items()])).alias("fields"))
    return found.select("path", F.explode("fields").alias("field"))


def unbound(entries: DataFrame, captures: DataFrame) -> DataFrame:
    """(path, problem) of pages' records that aren't bound to the index: those of the newest capture, or one of an equal digest, and earlier ones with a reason."""
    at = lambda name: F.get_json_object("record_json", f"$.{name}").alias(name)
    rows = entries.filter("place = 0").select("path", "label", "observation_kind", "archive_url", F.col("archive_timestamp").alias("timestamp"), F.col("source_url").alias("original"), F.col("archive_digest").alias("digest"), at("latest_indexed_timestamp"), at("selection_reason"))
    earlier = F.coalesce(F.col("observation_kind") == EARLIER, F.lit(False))
    listed = captures.select("label", "timestamp", "original", "digest", "archive_url")
    old = selection.earlier_revisions(rows.filter(earlier), listed).select("path", "problem")
    newest = listed.groupBy("label").agg(F.max(F.struct("timestamp", "original", "digest")).alias("n"))
    new = rows.filter(~earlier).join(newest, "label", "left")
    same = (F.col("digest") == F.col("n.digest")) & F.col("digest").rlike(selection.DIGEST)
    problem = F.when(F.col("n").isNull(), "unknown label").when(~F.col("latest_indexed_timestamp").eqNullSafe(F.col("n.timestamp")), "latest differs").when((F.col("timestamp") != F.col("n.timestamp")) & ~F.coalesce(same, F.lit(False)), "not the newest")
    return old.unionByName(new.select("path", problem.alias("problem"))).filter("problem IS NOT NULL")


def read_archive_records(spark: SparkSession, folder: str, for_export: bool = False, include_earlier: bool = True, index: str | None = None, states: str | None = None, holds: str | None = None, cache: str | None = None) -> DataFrame:
    """Historical records, those nested in others included, with the earlier ones unless asked otherwise.

    For an export the index and the states must be named, and any page that these don't bear out, or with an entry of another capture, is an error.
    """
    found = observations(spark, folder)
    if not include_earlier:
        found = found.filter(~F.coalesce(F.col("observation_kind") == EARLIER, F.lit(False)))
    if for_export:
        if not states or not index:
            raise ValueError("an export needs the records' states and the index")
        held = export_outcomes(spark, found, states, holds, cache).filter("reason IS NOT NULL")
        normalize.assert_none([("records held", held), ("records not bound to the index", unbound(found, captured.index(spark, index))), ("entries of another capture than their page's", foreign_entries(found))])
    return found


@dataclass(frozen=True)
class Container:
    """A backup that pages were read from: its name in index lines, and the stamps of its first and last capture."""

    name: str
    first: str
    last: str


#: A capture of a stored inventory, as a line of JSON; position is its place in its label's list, newest first.
STORED = "label string, position long, timestamp string, original string, digest string, archive_url string, warc_offset long, warc_length long"


def inventory_checks(spark: SparkSession, index: str, stored: DataFrame, scope: Scope, container: Container) -> list[tuple[str, DataFrame]]:
    """What a stored inventory (STORED) and the index that it was made of, gzip files of many members, say against each other."""
    scoped = cdx.line_rows(cdx.member_lines(spark, index), scope, container.first, container.last, container.name)
    wrong = inventories.compared(cdx.first_lines(scoped.filter("sound")), stored).filter("outcome <> 'equal'")
    return [("index lines that break a bound", scoped.filter("NOT sound")), ("captures that differ from the index", wrong), ("captures out of order", inventories.out_of_order(stored))]


def unproved(entries: DataFrame, stored: DataFrame) -> DataFrame:
    """(path, problem) of pages' records that weren't read from the member that the inventory names for their label's newest capture."""
    at = lambda name, kind: F.get_json_object("record_json", f"$.{name}").cast(kind)
    rows = entries.filter("place = 0").select("path", "label", F.col("archive_timestamp").alias("timestamp"), at("retrieval.offset", "long").alias("offset"), at("retrieval.length", "long").alias("length"), at("retrieval.member_sha256", "string").alias("member"))
    newest = stored.groupBy("label").agg(F.max_by(F.struct("timestamp", "warc_offset", "warc_length"), F.struct("timestamp", "original")).alias("n"))
    joined = rows.join(newest, "label", "left")
    problem = (
        F.when(F.col("n").isNull(), "unknown label").when(~F.col("timestamp").eqNullSafe(F.col("n.timestamp")), "not the newest")
        .when(~F.col("offset").eqNullSafe(F.col("n.warc_offset")) | ~F.col("length").eqNullSafe(F.col("n.warc_length")), "another member").when(~F.coalesce(F.col("member").rlike("^[0-9a-f]{64}$"), F.lit(False)), "no member hash")
    )
    return joined.select("path", problem.alias("problem")).filter("problem IS NOT NULL")


def read_archive_snapshot(spark: SparkSession, folder: str, index: str, stored: str, scope: Scope, container: Container) -> DataFrame:
    """Historical records of one backup, those nested in others included. The inventory, a folder of JSON lines, has to be the one that the index gives,
    and every page to come from the member that it names; else the call is an error."""
    found, listed = observations(spark, folder), spark.read.schema(STORED).json(stored)
    checks = inventory_checks(spark, index, listed, scope, container)
    normalize.assert_none([*checks, ("records of other members", unproved(found, listed)), ("entries of another capture than their page's", foreign_entries(found))])
    return found


def feeds(spark: SparkSession, folder: str) -> DataFrame:
    rows = records.read(spark, folder)
    return rows.select("record_json", F.from_json("record_json", schemas.FEED).alias("e")).select("record_json", "e.*")


def gates(entries: DataFrame, kind: str, key: str) -> list[tuple[str, DataFrame]]:
    """What keeps records from being exported by themselves: repeated keys, and each reason of omissions.own_reason."""
    judged = _judged(entries).select("key", rules.own_reason().alias("reason"))
    return [(f"{kind} held: {reason}", judged.filter(F.col("reason") == reason)) for reason in ("warnings", "licence", "omissions in a complete record", "incomplete without omissions")] + [(f"{kind} with a repeated {key}", normalize.repeated_keys(entries, key))]


def _judged(entries: DataFrame) -> DataFrame:
    """The columns that gates.outcomes reads. A record's key is its id, a feed's its path, and that of a historical page the name of its file.

    Observations that are nested in a page's record have no state of their own: the page's holds or frees them all.
    """
    pages = "place" in entries.columns
    own = next(c for c in ("key", "id", "feed_path") if c in entries.columns)
    if pages:
        entries = entries.filter("place = 0").withColumn("key", page_key(F.col("path")))
    at = lambda name: F.get_json_object("record_json", f"$.{name}")
    none = F.array().cast("array<string>")
    return entries.select(
        F.col(own).cast("string").alias("key"), record_digest(F.col("record_json")).alias("record_sha256"), F.sha2(at("source_url"), 256).alias("url_sha256"), at("response_sha256").alias("response_sha256"), at("retrieved_at").alias("retrieved_at"),
        F.coalesce("warnings", none).alias("warnings"), F.col("license.url").alias("license_url"), at("source_sections_complete").cast("boolean").alias("source_sections_complete"), F.coalesce(F.from_json(at("omitted_sections"), "array<string>"), none).alias("omissions"),
    )


def page_key(path) -> Column:
    """The key of a historical page's record and state: its file's name."""
    return F.regexp_extract(path, r"([^/]+)\.yaml$", 1)


def _lines(spark: SparkSession, folder: str | None, schema: str) -> DataFrame:
    """The rows of a folder of JSON lines, or of the version that holds of a published table."""
    if not folder:
        return spark.createDataFrame([], schema)
    names = [c.split()[0] for c in schema.split(", ")]
    return published.read(spark, folder, verification_schema()).select(*names) if published.number(spark, folder) else spark.read.schema(schema).json(folder)


def verification_schema() -> str:
    return ", ".join(["key string", *[f"{c} string" for c in verification.STATE]])


def export_outcomes(spark: SparkSession, entries: DataFrame, states: str, holds: str | None = None, cache: str | None = None) -> DataFrame:
    """(key, reason) of records: the first reason against the export of each, or null. states, holds and cache are folders of JSON lines."""
    return rules.outcomes(_judged(entries), _lines(spark, states, STATE), _lines(spark, holds, HOLD), _lines(spark, cache, RESPONSE), "key")


def read_records(spark: SparkSession, folder: str, for_export: bool = False, states: str | None = None, holds: str | None = None, cache: str | None = None) -> DataFrame:
    """Current records in order of id. For an export any reason against one of them is an error; states must then be named."""
    found = current(spark, folder)
    if for_export:
        if not states:
            raise ValueError("an export needs the records' states")
        held = export_outcomes(spark, found, states, holds, cache).filter("reason IS NOT NULL")
        normalize.assert_none([("records held", held), ("records with a repeated id", normalize.repeated_keys(found, "id"))])
    return found.orderBy("id")


def relations(spark: SparkSession, current_folder: str | None = None, archive_folder: str | None = None, feed_folder: str | None = None, states: str | None = None, holds: str | None = None, cache: str | None = None) -> tuple[dict[str, DataFrame], list[tuple[str, DataFrame]]]:
    """The relations of all given folders, and the checks that must hold before they are written; with states also those of export_outcomes."""
    found: dict[str, DataFrame] = {}
    checks: list[tuple[str, DataFrame]] = []
    if current_folder:
        # Cut, as every relation and check reads them: the files are parsed once.
        entries = shared.cut(current(spark, current_folder))
        if states:
            checks.append(("entries held by states, holds or newer responses", export_outcomes(spark, entries, states, holds, cache).filter("reason IS NOT NULL")))
        own = normalize.relations(entries.drop("path"))
        checks += gates(entries, "entries", "id") + [("examples repeated", normalize.repeated_keys(own["examples"], "entry_id", "source_id")), ("translations without an example", normalize.orphans(own["translations"].withColumnRenamed("example_id", "source_id"), ["entry_id", "source_id"], own["examples"], ["entry_id", "source_id"])), ("levels out of range", entries.filter("jlpt_level NOT BETWEEN 1 AND 5"))]
        found |= own
    if archive_folder:
        entries = shared.cut(observations(spark, archive_folder))
        if states:
            checks.append(("observations held by states, holds or newer responses", export_outcomes(spark, entries, states, holds, cache).filter("reason IS NOT NULL")))
        checks += [*gates(entries, "observations", "key"), ("entries of another capture than their page's", foreign_entries(entries))]
        found |= normalize.archive_relations(entries.drop("path", "place"))
    if feed_folder:
        entries = shared.cut(feeds(spark, feed_folder))
        if states:
            checks.append(("feeds held by states, holds or newer responses", export_outcomes(spark, entries, states, holds, cache).filter("reason IS NOT NULL")))
        checks += gates(entries, "feeds", "feed_path")
        found |= normalize.feed_relations(entries)
    return found, checks


def build(spark: SparkSession, out: str, sqlite: str | None = None, pages: str | None = None, **folders: str | None) -> dict[str, int]:
    """Writes the relations as Parquet, and if asked as SQLite and Markdown; nothing is written unless all checks hold."""
    preflight(spark, [p for p in (out, sqlite, pages) if p])
    found, checks = relations(spark, **folders)
    normalize.assert_none(checks)
    sinks.write_relations(found, out)
    counts = {name: spark.read.parquet(f"{out.rstrip('/')}/{name}").count() for name in found}
    if sqlite:
        sinks.write_sqlite({n: spark.read.parquet(f"{out.rstrip('/')}/{n}") for n in found}, sqlite)
    if pages:
        update_pages(spark, pages, **folders)
    return counts


def preflight(spark: SparkSession, paths: list[str]) -> None:
    """Refuses destinations that are equal or of which one lies inside another, before anything is made there."""
    rows = spark.createDataFrame([(i, os.path.abspath(p) if "://" not in p else p.replace("://", "/")) for i, p in enumerate(paths)], "n int, path string")
    normalize.assert_none([("overlapping destinations", destinations.overlaps(rows, "n", "path"))])


def update_pages(spark: SparkSession, pages: str, current_folder: str | None = None, archive_folder: str | None = None, feed_folder: str | None = None, **_: str | None) -> dict[str, list[str]]:
    """Brings a folder of Markdown pages up to date. The driver gets each page's path and hash; executors render and write, so the folder must be one that all see."""
    sources = [read(spark, folder).select(sinks.rendered(F.col("record_json")).alias("p")).select("p.path", "p.body") for folder, read in ((current_folder, current), (archive_folder, observations), (feed_folder, feeds)) if folder]
    made = sources[0]
    for more in sources[1:]:
        made = made.unionByName(more)
    return sinks.update_page_table(made, pages)


def audit(spark: SparkSession, bodies: str | None = None, ids: str | None = None, **folders: str | None) -> dict:
    """The counts of offending rows by check, and whether the archive is complete. With the pages' bodies and the index's ids (JSON lines) current records are also held against these."""
    _, checks = relations(spark, **folders)
    counts = {r["check_name"]: r["n_rows"] for r in normalize.violations(checks).collect()}
    report: dict = {"checks": counts}
    if bodies and ids and (folder := folders.get("current_folder")):
        own = current(spark, folder).select("id", F.col("response_sha256").alias("body_sha256"))
        pages = own.join(captured.bodies(spark, bodies), "body_sha256").select("id", F.decode("body", "UTF-8").alias("html"))
        found, report["coverage"] = audit_current(spark, folder, pages, spark.read.schema("id long").json(ids))
        counts |= {f"current: {r['finding']}": r["count"] for r in found.groupBy("finding").count().collect()}
        counts["current: records without their page's bytes"] = own.join(pages.select("id"), "id", "left_anti").count()
    return report | {"export_ready": not any(counts.values())}


def decisions(spark: SparkSession, reviews: str | None = None, omissions: str | None = None, current_folder: str | None = None) -> captured.Decisions:
    """What persons decided, from folders of JSON lines, and the ids that current records prove."""
    lines = lambda folder, schema: spark.read.schema(schema).json(folder) if folder else None
    return captured.Decisions(lines(reviews, captured.REVIEWS), lines(omissions, captured.OMISSIONS), current(spark, current_folder).select("id") if current_folder else None)


def extract(spark: SparkSession, index: str, bodies: str, out: str, states: str, decided: captured.Decisions | None = None) -> dict[str, int]:
    """Records of captured pages: written below out as YAML, with a state for each capture; the counts of states."""
    found = captured.extracted(captured.index(spark, index), captured.bodies(spark, bodies), decided)
    return captured.write(found, out, states)


def audit_captures(spark: SparkSession, index: str, bodies: str, records_folder: str, decided: captured.Decisions | None = None) -> DataFrame:
    """(key, outcome) of stored observations against those extracted again from the captured bytes."""
    found = captured.extracted(captured.index(spark, index), captured.bodies(spark, bodies), decided).filter("status = 'parsed'")
    stored = records.read(spark, records_folder).select(page_key(F.col("path")).alias("key"), record_digest(F.col("record_json")).alias("record_sha256"))
    return audits.reextracted(stored, found.select("key", "record_sha256"), "key", ["record_sha256"])


#: What an audit of pages reads of their records.
_PAGE = "label string, response_sha256 string, archive_url string, archive_timestamp string, source_url string, latest_indexed_timestamp string, observation_kind string, warnings array<string>"


def archive_audit(spark: SparkSession, index: str, bodies: str, records_folder: str, states: str, holds: str | None = None, cache: str | None = None, write: bool = False, decided: captured.Decisions | None = None) -> dict:
    """Holds all pages' records of a folder against their captured bytes, index, states, holds and newest responses.

    With ``write``, and only if nothing speaks against any of them, those that lack a state of this very record get one; ``states`` is a
    published table, so a reader sees all new states or none. Without ``cache`` newest responses aren't looked at. Records of the kind of
    earlier revisions needn't be of the newest capture.
    """
    seen = published.number(spark, states)
    captures = captured.index(spark, index)
    again = captured.extracted(captures, captured.bodies(spark, bodies), decided).select("key", "record_sha256", F.when(F.col("status") != rules.PARSED, F.coalesce("reason", "status")).alias("error"), F.from_json(F.get_json_object("record_json", "$.warnings"), "array<string>").alias("warnings"))
    stored = records.read(spark, records_folder).select(page_key(F.col("path")).alias("key"), "record_json", F.from_json("record_json", _PAGE).alias("r"))
    judged = shared.cut(stored.select("key", record_digest(F.col("record_json")).alias("record_sha256"), "r.*", F.lit("archive").alias("batch")).withColumn("earlier", F.coalesce(F.col("observation_kind") == EARLIER, F.lit(False))))
    old = published.read(spark, states, verification_schema(), seen)
    responses = _lines(spark, cache, f"{RESPONSE}, final_url string") if cache else None
    found = shared.cut(verification.findings(judged, again, old, _lines(spark, holds, HOLD), captures, responses, "key"))
    verdict = verification.verdicts(judged, found, "key", "batch")
    report = verdict.first()
    result = {"records": 0, "verified": False} if report is None else {k: v for k, v in report.asDict().items() if k != "batch"}
    result["states_written"] = 0
    if write and result["verified"] and result["unverified"]:
        new = verification.proposed(judged, found, captures, "key")
        published.publish(verification.settled(old, new, judged, verdict, "key", "batch"), states, seen)
        result["states_written"], result["unverified"] = result["unverified"], 0
    result["export_ready"] = bool(result["verified"] and not result.get("unverified"))
    return result


def verified_labels(spark: SparkSession, current_folder: str | None = None, archive_folder: str | None = None) -> DataFrame:
    """(label, entry_id) of current records and of pages; a current one's id counts where both have one of a label."""
    none = spark.createDataFrame([], "label string, entry_id long, place int")
    if current_folder:
        none = none.unionByName(current(spark, current_folder).select(F.col("romanized_label").alias("label"), F.col("id").alias("entry_id"), F.lit(0).alias("place")))
    if archive_folder:
        none = none.unionByName(observations(spark, archive_folder).filter("size(warnings) = 0").select("label", F.col("id").alias("entry_id"), F.lit(1).alias("place")))
    return none.filter("label IS NOT NULL AND entry_id IS NOT NULL").groupBy("label").agg(F.min_by("entry_id", F.struct("place", "entry_id")).alias("entry_id"))


def extract_feeds(spark: SparkSession, index: str, bodies: str, out: str, states: str, scope: Scope, current_folder: str | None = None, archive_folder: str | None = None) -> dict[str, int]:
    """Records of the newest capture of each feed, and their states in a published table; the counts of states.

    All feeds of the index are published as pending before the work: a job that dies, or a capture that can't be read, leaves them held, older records included.
    """
    captures = captured.index(spark, index)
    paths = captured.newest_feeds(captures).select(F.col("feed_path").alias("key"), F.col("archive_url"), F.col("timestamp").alias("latest_indexed_timestamp"))
    seen = published.number(spark, states)
    others = lambda: published.read(spark, states, verification_schema()).join(paths.select("key"), "key", "left_anti")
    names = ["key", *verification.STATE]
    row = lambda df, **known: df.select(*[known.get(c, F.col(c) if c in df.columns else F.lit(None)).cast("string").alias(c) for c in names])
    seen = published.publish(others().select(*names).unionByName(row(paths, status=F.lit("pending"))), states, seen)
    found = captured.extracted_feeds(captures, captured.bodies(spark, bodies), verified_labels(spark, current_folder, archive_folder), scope)
    done = shared.cut(captured.write_feeds(found, out))
    settled = done.select(F.col("feed_path").alias("key"), "status", "record_sha256", "response_sha256", "archive_url", F.col("archive_timestamp").alias("latest_indexed_timestamp"))
    published.publish(others().select(*names).unionByName(row(settled, verification=F.lit("crawl"))), states, seen)
    return {r["status"]: r["count"] for r in done.groupBy("status").count().collect()}


#: Captions that pages show beside what records hold.
CAPTIONS = ("Meaning", "Formation", "See also", "Phrases", "Discussion and comments", "Show comments >", ",")


def audit_current(spark: SparkSession, current_folder: str, pages: DataFrame, index: DataFrame) -> tuple[DataFrame, dict]:
    """The findings (id, finding, detail) of current records against their pages (id, html) and the index (id), and a report of one row of numbers.

    Findings: runs of text that a page shows and its record lacks or holds more often, related ids that the index lacks, records out of the index, indexed ids
    without a record or a page. A record's texts are those of its fragments and fields, a card's footer aside.
    """
    entries = current(spark, current_folder)
    def each(column: str | Column, field: str) -> Column:
        return F.transform(column, lambda x: x[field])

    html = F.concat(each("sections", "body_html"), each("examples", "japanese_html"), each("comments", "html"), F.flatten(F.transform("examples", lambda x: each(x["translations"], "html"))))
    plain = F.array("title", "romanized_label", F.concat(F.lit("JLPT N"), F.col("jlpt_level").cast("string")), "credits_raw")
    more = F.concat(each("sections", "credits_raw"), each("examples", "credits_raw"), each("examples", "reading"), each("comments", "credits_raw"), each("related_entries", "label"), "alternate_forms")
    held = entries.select("id", coverage.runs(F.concat_ws("<hr>", F.array_compact(html))).alias("a"), F.array_compact(F.concat(plain, more)).alias("b")).select("id", F.concat("a", "b").alias("runs"))
    shown = pages.select("id", coverage.runs(F.col("html")).alias("runs"))
    text = coverage.unmapped(shown, held, "id", CAPTIONS).select("id", F.when(F.col("extra") > 0, "text without a place").otherwise("text not on the page").alias("finding"), F.col("run").alias("detail"))
    lone = coverage.outside_index(entries.select(F.explode("related_entries.target_id").alias("target_id")), index, "id").select("id", F.lit("related id outside the index").alias("finding"), F.lit(None).cast("string").alias("detail"))
    sides = index.select("id", F.lit(True).alias("indexed")).distinct().join(entries.select("id", F.lit(True).alias("captured")).distinct(), "id", "full").fillna(False)
    gone = sides.filter("indexed <> captured").select("id", F.when(F.col("indexed"), "no record").otherwise("not indexed").alias("finding"), F.lit(None).cast("string").alias("detail"))
    found = shared.cut(text.unionByName(lone).unionByName(gone))
    numbers = sides.agg(*[m.alias(n) for n, m in reports.coverage_metrics(F.col("indexed"), F.col("captured")).items()]).first().asDict()
    return found, numbers | {"coverage_verified": bool(numbers["covered"]) and found.isEmpty()}
