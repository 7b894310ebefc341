"""Holds of feeds: an attempt to read a feed anew holds it from before the work on, and only its own parsed result frees it.

An attempt is announced (``begin``) before it starts and closed by a ``result``. Of a feed's attempts the newest counts: while it has no result the feed is pending,
whatever older attempts left behind, and a result other than ``parsed`` keeps the older record from being exported. Rows may come late or twice: a result of an
older attempt changes nothing. ``states`` is the batch form, an aggregation; ``stream`` holds one row of state for each feed and gives a row for each change.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

PENDING, PARSED = "pending", "parsed"
#: What attempts have: phase is begin or result; a begin has no status and no hash.
ATTEMPTS = "feed_path string, attempt long, phase string, status string, record_sha256 string"
STATES = "feed_path string, attempt long, status string, record_sha256 string, exportable boolean"


def states(attempts: DataFrame) -> DataFrame:
    """STATES of the feeds with an attempt. Several results of one attempt: the one that isn't parsed counts, so a doubt holds."""
    result = F.col("phase") == "result"
    rank = F.struct("attempt", result.alias("closed"), F.when(result, F.coalesce("status", F.lit("")) != PARSED).alias("doubt"), "status", "record_sha256")
    last = attempts.filter("feed_path IS NOT NULL AND attempt IS NOT NULL").groupBy("feed_path").agg(F.max(rank).alias("s"))
    status = F.when(F.col("s.closed"), F.coalesce("s.status", F.lit("failed"))).otherwise(PENDING)
    return last.select("feed_path", "s.attempt", status.alias("status"), F.when(F.col("s.closed"), F.col("s.record_sha256")).alias("record_sha256"), (F.col("s.closed") & F.coalesce(F.col("s.status") == PARSED, F.lit(False))).alias("exportable"))


class HoldProcessor(StatefulProcessor):
    """Keeps the greatest of a feed's attempts by (attempt, closed, doubt, status, hash)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "attempt long, closed boolean, doubt boolean, status string, record_sha256 string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        before = tuple(self.last.get()) if self.last.exists() else None
        best = before
        for batch in rows:
            for r in batch.astype(object).where(batch.notna(), None).itertuples(index=False):
                closed = r.phase == "result"
                one = (int(r.attempt), closed, closed and r.status != PARSED, r.status, r.record_sha256)
                best = one if best is None or _rank(one) > _rank(best) else best
        if best != before:
            self.last.update(best)
            attempt, closed, _, status, sha = best
            yield pd.DataFrame([(key[0], attempt, (status or "failed") if closed else PENDING, sha if closed else None, closed and status == PARSED)], columns=["feed_path", "attempt", "status", "record_sha256", "exportable"])

    def close(self) -> None:
        pass


def _rank(row: tuple) -> tuple:
    attempt, closed, doubt, status, sha = row
    return attempt, closed, doubt, status is not None, status or "", sha is not None, sha or ""


def stream(attempts: DataFrame) -> DataFrame:
    """STATES as they change, of a stream of ATTEMPTS; for the output mode update. State is kept by the RocksDB provider, which the session has to name."""
    rows = attempts.filter("feed_path IS NOT NULL AND attempt IS NOT NULL").groupBy("feed_path")
    return rows.transformWithStateInPandas(statefulProcessor=HoldProcessor(), outputStructType=STATES, outputMode="Update", timeMode="None")
