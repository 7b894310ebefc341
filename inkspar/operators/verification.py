"""The audit of an archive's records against its sources, and the states that only a whole verified batch gets.

``findings`` holds every record against what was extracted again from its captured bytes, its state, its holds, the inventory and the newest
cached response, and lists all that speaks against it. A batch is verified where it has records and none of them a finding but ``unverified``, the
lack of a state of this very record. ``settled`` overlays the states with new ones of verified batches; of any other batch every state stays as it was.
``published.publish`` makes the outcome visible at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkspar.operators.audits import replay_agrees
from inkspar.operators.gates import PARSED, newest_responses, one_state

ERROR, WARNING, BLOCKED, UNVERIFIED = "error", "warning", "blocked", "unverified"
#: Columns of a state, beside its key.
STATE = ["status", "record_sha256", "response_sha256", "archive_url", "latest_indexed_timestamp", "membership_sha256", "verification"]
SOURCE_AUDIT = "offline-source-audit"


def _said(*cases: tuple[str, str, Column]) -> Column:
    """(kind, detail) of the cases that hold."""
    return F.array_compact(F.array(*[F.when(F.coalesce(holds, F.lit(False)), F.struct(F.lit(kind).alias("kind"), F.lit(detail).alias("detail"))) for kind, detail, holds in cases]))


def findings(records: DataFrame, extracted: DataFrame, states: DataFrame, holds: DataFrame, captures: DataFrame, cached: DataFrame | None, key: str) -> DataFrame:
    """(key, kind, detail) of all that speaks against records.

    records: key, label, record_sha256, response_sha256, archive_url, archive_timestamp, source_url, latest_indexed_timestamp, warnings;
    extracted: key, record_sha256, error, warnings; states: key and STATE; holds: key, hold; captures, the inventory: label, timestamp, original, digest,
    archive_url; cached: url_sha256, retrieved_at, response_sha256, final_url, or None where responses aren't looked at. Records with a true column ``earlier`` needn't be of the newest capture. An older capture counts as the newest one where the inventory lists an equal
    digest for both. Every table is joined by a key of its own rows, so a label's captures are reduced to one row first.
    """
    # Hashes and addresses hardly compress, so what is compared is said where it is joined, and goes no further.
    earlier = F.coalesce("earlier", F.lit(False)) if "earlier" in records.columns else F.lit(False)
    replayed = replay_agrees(F.col("archive_url"), F.col("archive_timestamp"), F.col("source_url"))
    own = records.select(key, "record_sha256", "response_sha256", "archive_url", "warnings", replayed.alias("replayed"))
    again = extracted.select(key, F.struct("record_sha256", "error", "warnings").alias("again"))
    stated = one_state(states.select(key, *STATE), key).select(key, F.struct(*STATE).alias("state"))
    held = holds.groupBy(key).agg(F.min("hold").alias("hold"))
    unverified = F.col("state").isNull() | ~F.col("state.record_sha256").eqNullSafe(F.col("record_sha256"))
    said = _said(
        (ERROR, "replay address", ~F.col("replayed")),
        (ERROR, "not extracted", F.col("again").isNull()), (ERROR, "extraction fails", F.col("again.error").isNotNull()), (ERROR, "extraction differs", F.col("again.error").isNull() & ~F.col("again.record_sha256").eqNullSafe(F.col("record_sha256")) & F.col("again").isNotNull()),
        (ERROR, "source warnings left out", F.size(F.array_except(F.coalesce("again.warnings", F.array()), F.coalesce("warnings", F.array()))) > 0),
        (WARNING, "own warnings", F.size("warnings") > 0),
        (BLOCKED, "state", F.col("state").isNotNull() & ((F.col("state.status") != PARSED) | ~F.col("state.response_sha256").eqNullSafe(F.col("response_sha256")) | ~F.col("state.archive_url").eqNullSafe(F.col("archive_url")))),
        (BLOCKED, "hold", F.col("state").isNull() & F.col("hold").isNotNull()), (UNVERIFIED, "no state of this record", unverified),
    )
    alone = own.join(again, key, "left").join(stated, key, "left").join(held, key, "left").select(key, "response_sha256", "archive_url", said.alias("said"), unverified.alias("unverified")).filter(F.size("said") > 0)
    if cached is not None:
        # only records without a state of theirs need the newest response
        response = newest_responses(cached, "url_sha256", "retrieved_at", ["response_sha256", "final_url"]).select(F.col("url_sha256").alias("at"), F.struct("response_sha256", "final_url").alias("response"))
        unlike = ~F.col("response.response_sha256").eqNullSafe(F.col("response_sha256")) | ~F.col("response.final_url").eqNullSafe(F.col("archive_url"))
        alone = alone.withColumn("at", F.sha2("archive_url", 256)).join(response, "at", "left").withColumn("said", F.concat("said", _said((ERROR, "not the newest response", F.col("unverified") & unlike))))
    newest = captures.groupBy("label").agg(F.max(F.struct("timestamp", "original", "digest")).alias("newest"))
    listed = captures.groupBy("label", "archive_url").agg(F.max("digest").alias("listed_digest"))
    unseen = _said((WARNING, "label not indexed", F.col("newest").isNull()), (WARNING, "newest capture unseen", F.col("newest").isNotNull() & ~F.col("latest_indexed_timestamp").eqNullSafe(F.col("newest.timestamp"))))
    late = F.coalesce(~F.col("earlier") & (F.col("archive_timestamp") != F.col("newest.timestamp")), F.lit(False))
    indexed = records.select(key, "label", "archive_url", "archive_timestamp", "latest_indexed_timestamp", earlier.alias("earlier")).join(newest, "label", "left")
    indexed = indexed.select(key, "label", "archive_url", F.col("newest.digest").alias("digest"), unseen.alias("said"), late.alias("late")).filter(F.col("late") | (F.size("said") > 0))
    same = (F.col("listed_digest") == F.col("digest")) & F.col("listed_digest").rlike("^[A-Z2-7]{32}$")
    indexed = indexed.join(listed, ["label", "archive_url"], "left").withColumn("said", F.concat("said", _said((WARNING, "not the newest capture", F.col("late") & ~F.coalesce(same, F.lit(False))))))
    rows = alone.select(key, "said").unionByName(indexed.select(key, "said"))
    return rows.select(key, F.explode("said").alias("f")).select(key, "f.kind", "f.detail")


def verdicts(records: DataFrame, found: DataFrame, key: str, batch: str) -> DataFrame:
    """(batch, records, errors, warnings, blocked, unverified, verified): numbers of records with a finding of each kind."""
    kinds = found.groupBy(key).agg(F.collect_set("kind").alias("kinds"))
    has = lambda kind: F.count_if(F.array_contains("kinds", kind))
    counts = {"errors": has(ERROR), "warnings": has(WARNING), "blocked": has(BLOCKED), "unverified": has(UNVERIFIED)}
    by = records.select(key, batch).join(kinds, key, "left").groupBy(batch).agg(F.count("*").alias("records"), *[c.alias(n) for n, c in counts.items()])
    return by.withColumn("verified", F.col("errors") + F.col("warnings") + F.col("blocked") == 0)


def of_verified(found: DataFrame, records: DataFrame, judged: DataFrame, key: str, batch: str) -> DataFrame:
    """The findings of records of verified batches."""
    return found.join(records.select(key, batch).join(judged.filter("verified").select(batch), batch, "left_semi").select(key), key, "left_semi")


def proposed(records: DataFrame, found: DataFrame, captures: DataFrame, key: str, membership_sha256: str | None = None) -> DataFrame:
    """The states that unverified records would get: key and STATE."""
    newest = captures.groupBy("label").agg(F.max("timestamp").alias("newest_at"))
    wanted = records.join(found.filter(F.col("kind") == UNVERIFIED).select(key), key, "left_semi").join(newest, "label", "left")
    made = {"status": F.lit(PARSED), "latest_indexed_timestamp": F.col("newest_at"), "membership_sha256": F.lit(membership_sha256).cast("string"), "verification": F.lit(SOURCE_AUDIT)}
    return wanted.select(key, *[made.get(c, F.col(c)).alias(c) for c in STATE])


def settled(states: DataFrame, new: DataFrame, records: DataFrame, judged: DataFrame, key: str, batch: str) -> DataFrame:
    """All states: those of ``new`` whose batch is verified in place of older ones of their keys, and every other one as it was."""
    # batches meet keys before states do, which are wide
    good = new.join(records.select(key, batch).join(judged.filter("verified").select(batch), batch, "left_semi").select(key), key).select(key, *STATE)
    return states.join(good.select(key), key, "left_anti").select(key, *STATE).unionByName(good)
