"""Captured pages to records: an index of captures, bodies by hash, extraction with a state for each capture."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspar.functions.text import canonical
from inkspar.functions.urls import Scope
from inkspar.sources import feed, legacy_pages, records

#: A capture of the index, as a line of JSON; body_sha256 names its bytes.
INDEX = "label string, original string, timestamp string, archive_url string, digest string, retrieved_at string, body_sha256 string"
_EXTRACTED = "key string, status string, reason string, record_json string, record_sha256 string"


def index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEX).json(folder)


def bodies(spark: SparkSession, folder: str) -> DataFrame:
    """(body_sha256, body) of the files in a folder, each hash once; names don't count."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select(F.sha2("content", 256).alias("body_sha256"), F.col("content").alias("body")).dropDuplicates(["body_sha256"])


#: What persons decided, as lines of JSON: reviews of whether a page belongs to the collection, and sections to leave out.
REVIEWS = "id long, label string, decision string, category string, expected_title string, captures array<struct<source_url: string, response_sha256: string>>"
OMISSIONS = "response_sha256 string, source_url string, label string, id long, section string, byte_offset long, byte_length long, range_sha256 string, text_sha256 string"
#: Where a page's bytes name its entry: any number that stands there may be its id.
_NAMED_IDS = r"addGrammar\.php[^\s\"'>]*?[?&;]id=([0-9]{1,18})"


@dataclass
class Decisions:
    """Tables of what persons decided, each may be None: reviews (REVIEWS), omissions (OMISSIONS), verified ids (id)."""

    reviews: DataFrame | None = None
    omissions: DataFrame | None = None
    ids: DataFrame | None = None


def decided(captures: DataFrame, found: DataFrame, decisions: Decisions) -> DataFrame:
    """captures with their bodies and ``reviews``, ``omissions`` and ``ids``: JSON arrays of what was decided on each page's label, response and ids.

    Each meets a page by a join, so a worker sees what is about its pages, however much was decided in all.
    """
    rows = captures.join(found, "body_sha256", "left")
    text = lambda df, key: df.groupBy(key).agg(F.to_json(F.collect_list(F.struct(*[F.col(c) for c in df.columns]))).alias("v"))
    if decisions.reviews is not None:
        rows = rows.join(text(decisions.reviews, "label").withColumnRenamed("v", "reviews"), "label", "left")
    if decisions.omissions is not None:
        own = text(decisions.omissions, "response_sha256").select(F.col("response_sha256").alias("body_sha256"), F.col("v").alias("omissions"))
        rows = rows.join(own, "body_sha256", "left")
    if decisions.ids is not None:
        named = found.select("body_sha256", F.explode(F.array_distinct(F.regexp_extract_all(F.decode("body", "ISO-8859-1"), F.lit(_NAMED_IDS), F.lit(1)))).alias("id")).select("body_sha256", F.col("id").cast("long").alias("id"))
        own = named.join(decisions.ids.select(F.col("id").cast("long").alias("id")).distinct(), "id", "left_semi").groupBy("body_sha256").agg(F.to_json(F.collect_list("id")).alias("ids"))
        rows = rows.join(own, "body_sha256", "left")
    for name in ("reviews", "omissions", "ids"):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast("string"))
    return rows


def _rules(capture: dict) -> legacy_pages.Rules:
    reviews, omissions, ids = (json.loads(capture[name] or "[]") for name in ("reviews", "omissions", "ids"))
    return legacy_pages.Rules(frozenset(ids), {(r.get("id"), r["label"]): r for r in reviews}, omissions=tuple(omissions))


def _one(capture: dict, body: bytes | None) -> tuple[str, str, str | None, str | None, str | None]:
    key = hashlib.sha256("\0".join(str(capture[k]) for k in ("label", "timestamp", "original")).encode()).hexdigest()[:32]
    if body is None:
        return key, "pending", "no body", None, None
    try:
        record = legacy_pages.page(body, capture, _rules(capture), retrieved_at=capture["retrieved_at"])
        record["latest_indexed_timestamp"] = capture["latest_indexed_timestamp"]
    except legacy_pages.Held as held:
        return key, "review_required", str(held), None, None
    except legacy_pages.Outside as outside:
        return key, "excluded", str(outside), None, None
    except ValueError as error:
        return key, "failed", str(error), None, None
    text = json.dumps(record, ensure_ascii=False)
    return key, "parsed", None, text, hashlib.sha256(canonical(record).encode()).hexdigest()


def extracted(captures: DataFrame, found: DataFrame, decisions: Decisions | None = None) -> DataFrame:
    """(key, status, reason, record_json, record_sha256) of every capture: parsed, excluded, review_required, failed, or pending without a body.

    A record says which capture of its label was the newest of the index.
    """
    newest = captures.groupBy("label").agg(F.max("timestamp").alias("latest_indexed_timestamp"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            made = [_one(r, None if r["body"] is None else bytes(r["body"])) for r in rows.astype(object).where(rows.notna(), None).to_dict("records")]
            yield pd.DataFrame(made, columns=["key", "status", "reason", "record_json", "record_sha256"])

    return decided(captures.join(newest, "label", "left"), found, decisions or Decisions()).mapInPandas(run, _EXTRACTED)


def write(found: DataFrame, out: str, states: str) -> dict[str, int]:
    """Writes a record for each parsed capture, by the executors, to a folder that all see, and the states as JSON lines, which are written last."""

    def records_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for key, text in zip(rows["key"], rows["record_json"], strict=True):
                if text is not None:
                    records.write(f"{out}/{key}.yaml", json.loads(text))
            yield rows.drop(columns="record_json")

    written = found.mapInPandas(records_of, "key string, status string, reason string, record_sha256 string")
    written.write.mode("overwrite").json(states)
    counted = found.sparkSession.read.schema("key string, status string").json(states).groupBy("status").count()
    return {r["status"]: r["count"] for r in counted.collect()}


FEEDS = "feed_path string, status string, reason string, record_json string, record_sha256 string, response_sha256 string, archive_url string, archive_timestamp string"
_FIELDS = ["original", "timestamp", "archive_url", "retrieved_at", "body_sha256"]


def newest_feeds(captures: DataFrame) -> DataFrame:
    """The newest capture of each feed, a feed being the path of its address."""
    path = F.regexp_extract("original", r"^https?://[^/?#]+(/[^?#]*)", 1)
    newest = captures.groupBy(path.alias("feed_path")).agg(F.max(F.struct("timestamp", "original", "archive_url", "retrieved_at", "body_sha256")).alias("c"))
    return newest.select("feed_path", *[f"c.{f}" for f in _FIELDS])


def extracted_feeds(captures: DataFrame, found: DataFrame, labels: DataFrame, scope: Scope) -> DataFrame:
    """FEEDS: the newest capture of each feed as a record, or why there is none. labels (label, entry_id) are the verified ones.

    Only the labels that a feed's items name are looked up, by a join, so however many are verified no task holds them all.
    """
    held = newest_feeds(captures).join(found, "body_sha256", "left")

    def asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            pairs = [(path, label) for path, body in zip(rows["feed_path"], rows["body"], strict=True) if body is not None for label in feed.labels(bytes(body), scope)]
            yield pd.DataFrame(pairs, columns=["feed_path", "label"])

    named = held.select("feed_path", "body").mapInPandas(asked, "feed_path string, label string").distinct()
    known = named.join(labels.groupBy("label").agg(F.min("entry_id").alias("entry_id")), "label").groupBy("feed_path").agg(F.map_from_entries(F.collect_list(F.struct("label", "entry_id"))).alias("labels"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            made = [_one_feed(r, scope) for r in rows.astype(object).where(rows.notna(), None).to_dict("records")]
            yield pd.DataFrame(made, columns=[f.split()[0] for f in FEEDS.split(", ")])

    return held.join(known, "feed_path", "left").mapInPandas(run, FEEDS)


def _one_feed(capture: dict, scope: Scope) -> tuple:
    body, at = capture["body"], (capture["archive_url"], capture["timestamp"])
    if body is None:
        return capture["feed_path"], "failed", "no body", None, None, None, *at
    try:
        record = feed.feed(bytes(body), capture, capture["retrieved_at"], dict(capture["labels"] or {}), scope)
    except ValueError as error:
        return capture["feed_path"], "failed", str(error), None, None, None, *at
    status = "review_required" if record["review_required"] or record["warnings"] else "parsed"
    return capture["feed_path"], status, None, json.dumps(record, ensure_ascii=False), hashlib.sha256(canonical(record).encode()).hexdigest(), record["response_sha256"], *at


def write_feeds(found: DataFrame, out: str) -> DataFrame:
    """found without the records, which executors write to a folder that all see, when the result is read: each feed's under its path's name."""

    def records_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for path, text in zip(rows["feed_path"], rows["record_json"], strict=True):
                if text is not None:
                    records.write(f"{out}/{path.strip('/').replace('/', '-').removesuffix('.xml')}.yaml", json.loads(text))
            yield rows.drop(columns="record_json")

    return found.mapInPandas(records_of, FEEDS.replace("record_json string, ", ""))
