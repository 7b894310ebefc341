"""What keeps a record from being exported: its state, the hash of its record, holds, newer responses, and the record itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkspar.operators.omissions import own_reason

#: States that a record can be exported in; any other one, and none, holds it.
PARSED = "parsed"


def newest_responses(cache: DataFrame, by: str, at: str, fields: list[str]) -> DataFrame:
    """(by, at and the fields) of the newest response for each address; of several of one time that with the greatest fields."""
    newest = F.max(F.struct(at, *fields)).alias("newest")
    return cache.groupBy(by).agg(newest).select(by, f"newest.{at}", *[f"newest.{f}" for f in fields])


def state_reason(status: Column, stated_sha256: Column, record_sha256: Column) -> Column:
    """Why a record's state holds it, or null: no state, a state other than parsed, or one of another record."""
    return F.when(status.isNull(), "no state").when(status != PARSED, F.concat(F.lit("state "), status)).when(~stated_sha256.eqNullSafe(record_sha256), "another record than the state's")


def one_state(states: DataFrame, key: str) -> DataFrame:
    """One state for each key: of several the worst, any other status before parsed, then the first in order of columns."""
    others = [c for c in states.columns if c != key]
    worst = F.min(F.struct((F.col("status") == PARSED).alias("parsed"), *others)).alias("s")
    return states.groupBy(key).agg(worst).select(key, *[f"s.{c}" for c in others])


def outcomes(records: DataFrame, states: DataFrame, holds: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """(key, reason): the first reason against each record's export, or null.

    records has key, record_sha256, url_sha256, response_sha256, retrieved_at, warnings, license_url,
    source_sections_complete and omissions; states (key, status, record_sha256); holds (key, hold); cache (url_sha256,
    retrieved_at, response_sha256). A response newer than the record's and with other bytes holds it, as does any hold.
    Of several states of a key the worst counts.
    """
    newest = newest_responses(cache, "url_sha256", "retrieved_at", ["response_sha256"]).select("url_sha256", F.col("retrieved_at").alias("newest_at"), F.col("response_sha256").alias("newest_sha256"))
    held = holds.groupBy(key).agg(F.min("hold").alias("hold"))
    joined = records.join(one_state(states.select(key, "status", F.col("record_sha256").alias("stated_sha256")), key), key, "left").join(held, key, "left").join(newest, "url_sha256", "left")
    newer = (F.col("newest_at") > F.col("retrieved_at")) & ~F.col("newest_sha256").eqNullSafe(F.col("response_sha256"))
    reason = F.coalesce(state_reason(F.col("status"), F.col("stated_sha256"), F.col("record_sha256")), F.concat(F.lit("hold: "), "hold"), F.when(newer, "a newer response"), own_reason())
    return joined.select(key, reason.alias("reason"))
