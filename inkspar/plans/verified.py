"""Archives held against their sources: audits with states that change whole or not at all, stores and inventories, dataset comparison, history."""

from __future__ import annotations

import gzip
import io

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkspar.functions.urls import Scope
from inkspar.operators import hashtree, history, inventories, shared, verification
from inkspar.plans.base import Plans
from inkspar.plans.tables import table
from inkspar.sources import cdx, objects, published

PLANS = Plans()
SCOPE = Scope(hosts=("old.example.org",), page_path="/view.php", label_field="tagE", feed_paths=("/feed.xml",))
_WEB = "https://archive.example.org/web/"
_STATES = "event_id long, status string, record_sha256 string, response_sha256 string, archive_url string, latest_indexed_timestamp string, membership_sha256 string, verification string"


def _audited(spark, sf_dir) -> dict[str, DataFrame]:
    """Records of all events, in a batch for each user. The first record of a batch has what the user's number says against it, if anything."""
    first = table(spark, sf_dir, "events").groupBy("user_id").agg(F.min("event_id").alias("first"))
    rows = table(spark, sf_dir, "events").join(first, "user_id").withColumn("wrong", F.when(F.col("event_id") == F.col("first"), F.col("user_id") % 10).otherwise(0))
    wrong = lambda n: F.col("wrong") == n
    name = F.col("event_id").cast("string")
    stamp = F.date_format("ts", "yyyyMMddHHmmss")
    base = rows.select("event_id", "user_id", "wrong", F.concat(F.lit("e"), name).alias("label"), F.sha2(name, 256).alias("record_sha256"), F.sha2(F.concat(F.lit("r"), name), 256).alias("response_sha256"), stamp.alias("stamp"), F.concat(F.lit("http://old.example.org/view.php?tagE=e"), name).alias("source_url"))
    base = base.withColumn("archive_url", F.concat(F.lit(_WEB), "stamp", F.lit("id_/"), "source_url")).withColumn("stated", (F.col("event_id") % 2 == 1) & ~F.col("wrong").isin(8, 9) | wrong(7))
    none = F.array().cast("array<string>")
    records = base.select(
        "event_id", "user_id", "label", "record_sha256", "response_sha256", "archive_url", "source_url", F.when(wrong(1), "20000101000000").otherwise(F.col("stamp")).alias("archive_timestamp"),
        F.when(wrong(6), "20000101000000").otherwise(F.col("stamp")).alias("latest_indexed_timestamp"), F.when(wrong(4), F.array(F.lit("w"))).otherwise(none).alias("warnings"),
    )
    extracted = base.filter(~wrong(2)).select("event_id", F.when(wrong(3), "x").otherwise(F.col("record_sha256")).alias("record_sha256"), F.lit(None).cast("string").alias("error"), none.alias("warnings"))
    states = base.filter("stated").select("event_id", F.when(wrong(7), "failed").otherwise("parsed").alias("status"), "record_sha256", "response_sha256", "archive_url", F.col("stamp").alias("latest_indexed_timestamp"), F.lit(None).cast("string").alias("membership_sha256"), F.lit("crawl").alias("verification"))
    holds = base.filter(wrong(8)).select("event_id", F.lit("review_required").alias("hold"))
    captures = base.filter(~wrong(5)).select("label", F.col("stamp").alias("timestamp"), F.col("source_url").alias("original"), F.lit("A" * 32).alias("digest"), "archive_url")
    cached = base.select(F.sha2("archive_url", 256).alias("url_sha256"), F.lit("2020").alias("retrieved_at"), F.when(wrong(9), "newer").otherwise(F.col("response_sha256")).alias("response_sha256"), F.col("archive_url").alias("final_url"))
    return {"records": records, "extracted": extracted, "states": states, "holds": holds, "captures": captures, "cached": cached}


@PLANS.query("""WITH e AS (SELECT event_id, user_id, CASE WHEN event_id = min(event_id) OVER (PARTITION BY user_id) THEN user_id % 10 ELSE 0 END AS wrong FROM events),
    s AS (SELECT *, (event_id % 2 = 1 AND wrong NOT IN (8, 9)) OR wrong = 7 AS stated, bool_and(wrong = 0) OVER (PARTITION BY user_id) AS verified FROM e)
    SELECT event_id, user_id, CASE wrong WHEN 1 THEN 'error: replay address' WHEN 2 THEN 'error: not extracted' WHEN 3 THEN 'error: extraction differs' WHEN 4 THEN 'warning: own warnings' WHEN 5 THEN 'warning: label not indexed'
        WHEN 6 THEN 'warning: newest capture unseen' WHEN 7 THEN 'blocked: state' WHEN 8 THEN 'blocked: hold' WHEN 9 THEN 'error: not the newest response' END AS findings, NOT stated AS unverified, verified,
      CASE WHEN wrong = 7 THEN 'failed' WHEN stated OR verified THEN 'parsed' END AS status, CASE WHEN stated THEN 'crawl' WHEN verified THEN 'offline-source-audit' END AS verification FROM s""")
def archive_audit(spark, sf_dir):
    """States of a whole archive after an audit: batches without a finding get the states that they lack, of all others no state changes, and both become visible at once."""
    t = _audited(spark, sf_dir)
    root = shared.fresh(spark, "states")
    seen = published.publish(t["states"], root, 0)
    found = shared.stored(verification.findings(t["records"], t["extracted"], published.read(spark, root, _STATES), t["holds"], t["captures"], t["cached"], "event_id"), "findings")
    judged = shared.stored(verification.verdicts(t["records"], found, "event_id", "user_id"), "verdicts")
    new = verification.proposed(t["records"], verification.of_verified(found, t["records"], judged, "event_id", "user_id"), t["captures"], "event_id")
    published.publish(verification.settled(published.read(spark, root, _STATES), new, t["records"], judged, "event_id", "user_id"), root, seen)
    said = found.groupBy("event_id").agg(F.array_join(F.array_sort(F.collect_list(F.when(F.col("kind") != verification.UNVERIFIED, F.concat("kind", F.lit(": "), "detail")))), "; ").alias("findings"), F.bool_or(F.col("kind") == verification.UNVERIFIED).alias("unverified"))
    after = published.read(spark, root, _STATES).select("event_id", "status", "verification")
    rows = t["records"].select("event_id", "user_id").join(said, "event_id", "left").join(judged.select("user_id", "verified"), "user_id").join(after, "event_id", "left")
    return rows.select("event_id", "user_id", F.nullif("findings", F.lit("")).alias("findings"), F.coalesce("unverified", F.lit(False)).alias("unverified"), "verified", "status", "verification")


@PLANS.query("""SELECT substr(sha, 1, 2) AS prefix, count(*) AS objects, CAST(sum(bytes) AS BIGINT) AS bytes, true AS sound FROM (SELECT DISTINCT sha256(b) AS sha, octet_length(encode(b)) AS bytes FROM (SELECT text AS b FROM documents UNION ALL SELECT html FROM pages) WHERE b IS NOT NULL) GROUP BY 1""")
def content_store(spark, sf_dir):
    """Bodies of documents and pages in a store, in three commits that overlap: every other document, all documents with their stated hashes, and all bodies twice."""
    docs, pages = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("body")), table(spark, sf_dir, "pages").select(F.col("html").alias("body"))
    root = shared.fresh(spark, "store")
    objects.store(docs.filter("doc_id % 2 = 0"), root)
    objects.store(docs.withColumn("sha", F.sha2("body", 256)), root, stated="sha")
    every = docs.select("body").unionByName(pages)
    objects.store(every.unionByName(every), root)
    outcome = objects.verified(spark, root)
    found = objects.read(spark, root).select("sha256", "size").join(outcome, "sha256")
    return found.groupBy(F.substring("sha256", 1, 2).alias("prefix")).agg(F.count("*").alias("objects"), F.sum("size").alias("bytes"), F.bool_and(F.col("outcome") == "equal").alias("sound"))


_INDEXED = "SELECT event_id, 'te' || user_id AS label, strftime(date_trunc('day', ts), '%Y%m%d%H%M%S') AS stamp, event_id % 997 = 5 AS broken FROM events WHERE event_id % 4 <> 0"


def _index_file(member_bytes: int):
    """Writes the lines of a file as gzip members of member_bytes of text each, so that lines cross their borders."""

    def write(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        text = "\n".join([cdx.HEADER, *rows.sort_values("event_id")["line"]]).encode() + b"\n"
        system, path = fs.FileSystem.from_uri(rows["root"].iloc[0])
        system.create_dir(path, recursive=True)
        with system.open_output_stream(f"{path}/{key[0]:09d}.gz", compression=None) as out:
            for at in range(0, len(text), member_bytes):
                held = io.BytesIO()
                with gzip.GzipFile(fileobj=held, mode="wb", mtime=0) as member:
                    member.write(text[at : at + member_bytes])
                out.write(held.getvalue())
        return pd.DataFrame({"file": [key[0]]})

    return write


@PLANS.query(f"""WITH l AS ({_INDEXED}), c AS (SELECT label, stamp, min(event_id) AS event_id FROM l WHERE NOT broken GROUP BY ALL)
    SELECT label, stamp, CASE WHEN event_id % 101 = 0 THEN 'missing' WHEN event_id % 103 = 0 THEN 'digest' WHEN event_id % 107 = 0 THEN 'warc_offset' WHEN event_id % 109 = 0 THEN 'repeated' ELSE 'equal' END AS outcome FROM c
    UNION ALL SELECT 'x' || user_id, '20240101000000', 'unexpected' FROM (SELECT DISTINCT user_id FROM events WHERE user_id % 10 = 0) UNION ALL SELECT label, stamp, 'breaks a bound' FROM l WHERE broken""")
def verify_dump_inventory(spark, sf_dir):
    """A stored inventory against one rebuilt from its index, gzip files of many members with lines across them. Some captures are stored otherwise, not, or twice; some lines name a member of no length."""
    stamp = F.date_format(F.date_trunc("day", "ts"), "yyyyMMddHHmmss")
    status = F.when(F.col("event_id") % 4 == 0, "404").otherwise("200")
    length = F.when(F.col("event_id") % 997 == 5, "0").otherwise("100")
    line = F.concat_ws(" ", F.lit("k"), stamp, F.concat(F.lit("http://old.example.org/view.php?tagE=te"), F.col("user_id").cast("string")), F.lit("text/html"), status, F.lit("A" * 32), F.lit("-"), F.lit("-"), length, F.col("event_id").cast("string"), F.lit("c.warc.gz"))
    root = shared.fresh(spark, "index")
    rows = table(spark, sf_dir, "events").select(F.floor(F.col("event_id") / 20_000).alias("file"), "event_id", line.alias("line"), F.lit(root).alias("root"))
    rows.groupBy("file").applyInPandas(_index_file(5_000), "file long").write.format("noop").mode("overwrite").save()
    lines = cdx.member_lines(spark, root, 40_000)
    scoped = shared.stored(cdx.line_rows(lines, SCOPE, "20240101000000", "20251231235959", "c.warc.gz"), "scoped")
    rebuilt = cdx.first_lines(scoped.filter("sound"))
    # The stored inventory: as an index without faults gives it, changed here and there.
    events = table(spark, sf_dir, "events").filter("event_id % 4 <> 0 AND event_id % 997 <> 5").select(F.concat(F.lit("te"), F.col("user_id").cast("string")).alias("label"), stamp.alias("timestamp"), "event_id")
    kept = events.groupBy("label", "timestamp").agg(F.min("event_id").alias("event_id")).filter("event_id % 101 <> 0")
    twice = F.when((F.col("event_id") % 109 == 0) & (F.col("event_id") % 103 != 0) & (F.col("event_id") % 107 != 0), 2).otherwise(1)
    stored = kept.select("label", "timestamp", F.concat(F.lit("http://old.example.org/view.php?tagE="), "label").alias("original"), F.when(F.col("event_id") % 103 == 0, "B" * 32).otherwise("A" * 32).alias("digest"), F.when(F.col("event_id") % 107 == 0, -1).otherwise(F.col("event_id")).alias("warc_offset"), F.lit(100).cast("bigint").alias("warc_length"), F.explode(F.sequence(F.lit(1), twice)).alias("copy")).drop("copy")
    others = table(spark, sf_dir, "events").filter("user_id % 10 = 0").select(F.concat(F.lit("x"), F.col("user_id").cast("string")).alias("label")).distinct().select("label", F.lit("20240101000000").alias("timestamp"), F.lit("o").alias("original"), F.lit("-").alias("digest"), F.lit(0).cast("bigint").alias("warc_offset"), F.lit(0).cast("bigint").alias("warc_length"))
    address = F.concat(F.lit(f"https://{SCOPE.archive_host}/web/"), "timestamp", F.lit("id_/"), "original")
    wrong = inventories.compared(rebuilt, stored.unionByName(others).withColumn("archive_url", address))
    outcomes = wrong.select("label", F.regexp_extract("archive_url", r"/web/(\d{14})", 1).alias("stamp"), "outcome")
    return outcomes.unionByName(scoped.filter("NOT sound").select("label", F.col("timestamp").alias("stamp"), F.lit("breaks a bound").alias("outcome")))


@PLANS.query("SELECT user_id AS label, count(*) - 1 AS position FROM events GROUP BY user_id HAVING user_id % 3 = 0 AND count(*) > 1")
def inventory_order(spark, sf_dir):
    """Stored lists of captures, newest first; every third label's oldest capture claims to be newer than all."""
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("label"), F.struct(F.date_format("ts", "yyyyMMddHHmmssSSSSSS").alias("timestamp"), F.format_string("%012d", "event_id").alias("original")).alias("c"))
    lists = rows.groupBy("label").agg(F.sort_array(F.collect_list("c"), asc=False).alias("captures")).select("label", F.posexplode("captures").alias("position", "c"), F.size("captures").alias("n"))
    last = (F.col("position") == F.col("n") - 1) & (F.col("n") > 1) & (F.col("label") % 3 == 0)
    stored = lists.select("label", F.col("position").cast("bigint").alias("position"), F.when(last, "9").otherwise(F.col("c.timestamp")).alias("timestamp"), "c.original")
    return inventories.out_of_order(stored)


@PLANS.query("""SELECT 'changed' AS copy, o_orderkey, CASE o_orderkey % 500 WHEN 1 THEN 'missing' ELSE 'changed' END AS outcome FROM orders WHERE o_orderkey % 500 IN (1, 2, 4) UNION ALL SELECT 'changed', -o_orderkey, 'unexpected' FROM orders WHERE o_orderkey % 500 = 3""")
def verify_dataset(spark, sf_dir):
    """Orders against a copy written and read back, and against one with rows lost, changed, repeated and added: the rows that differ, found through prefix trees of hashes."""
    rows = table(spark, sf_dir, "orders")
    path = shared.fresh(spark, "restored")
    rows.repartition("o_custkey").write.parquet(path)
    n = F.col("o_orderkey") % 500
    changed = rows.filter(n != 1).withColumn("o_totalprice", F.when(n == 2, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    changed = changed.unionByName(rows.filter(n == 3).withColumn("o_orderkey", -F.col("o_orderkey"))).unionByName(rows.filter(n == 4))
    copies = {"restored": spark.read.schema(rows.schema).parquet(path), "changed": changed}
    first, second = (hashtree.compared(rows, copy, ["o_orderkey"]).select(F.lit(name).alias("copy"), "o_orderkey", "outcome") for name, copy in copies.items())
    return first.unionByName(second)


_STAMP = "CAST(strftime(ts, '%Y%m%d%H%M%S') AS BIGINT)"


@PLANS.query(f"""SELECT a.event_id, a.stamp, b.stamp AS newest FROM (SELECT event_id, user_id, {_STAMP} AS stamp FROM events) a ASOF LEFT JOIN (SELECT DISTINCT user_id, {_STAMP} AS stamp FROM events WHERE event_id % 5 = 0) b ON a.user_id = b.user_id AND a.stamp >= b.stamp""")
def inventory_as_of(spark, sf_dir):
    """For every event the last inventory of its user, of which every fifth event makes one."""
    stamp = F.date_format("ts", "yyyyMMddHHmmss").cast("long")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", stamp.alias("stamp"))
    return history.as_of(events, events.filter("event_id % 5 = 0").select("user_id", F.col("stamp").alias("seen_at"), F.col("stamp").alias("newest")), "user_id", "stamp", "seen_at", ["newest"]).select("event_id", "stamp", "newest")


@PLANS.query(f"""WITH e AS (SELECT event_id, user_id, {_STAMP} AS stamp FROM events), c AS (SELECT * FROM e WHERE event_id % 4 <> 3 AND user_id % 50 <> 0), m AS (SELECT user_id, max(stamp) AS now FROM c GROUP BY user_id),
    h AS (SELECT user_id, stamp AS seen_at, stamp AS newest FROM e WHERE event_id % 5 = 0 UNION SELECT user_id, 99980101000000, now FROM m WHERE user_id % 7 <> 0),
    r AS (SELECT e.*, CASE WHEN event_id % 3 > 0 THEN 99990101000000 ELSE stamp END AS checked_at FROM e), k AS (SELECT r.*, h.newest FROM r ASOF LEFT JOIN (SELECT user_id, seen_at, max(newest) AS newest FROM h GROUP BY ALL) h ON r.user_id = h.user_id AND r.checked_at >= h.seen_at)
    SELECT event_id, CASE WHEN now IS NULL THEN 'unknown label' WHEN NOT EXISTS (SELECT 1 FROM c WHERE c.user_id = k.user_id AND c.stamp = k.stamp AND c.event_id = k.event_id) THEN 'unknown capture' WHEN event_id % 11 = 0 THEN 'not bound to the inventory of its time' WHEN newest IS DISTINCT FROM now THEN 'changed inventory'
      WHEN event_id % 13 = 0 THEN 'no state' WHEN event_id % 13 IN (1, 2) THEN 'another state' WHEN stamp = now THEN 'latest' WHEN event_id % 17 = 0 THEN 'no reason' ELSE 'earlier' END AS outcome FROM k LEFT JOIN m USING (user_id)""")
def earlier_observations(spark, sf_dir):
    """Observations as latest or earlier ones, against the inventories and states that held when they were checked, and the inventory of now."""
    stamp = F.date_format("ts", "yyyyMMddHHmmss")
    e = table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("label"), stamp.alias("timestamp"), F.concat(F.lit("o"), F.col("event_id").cast("string")).alias("original"), F.concat(F.lit("u"), F.col("event_id").cast("string")).alias("archive_url"), F.lit("A" * 32).alias("digest"))
    captures = e.filter("event_id % 4 <> 3 AND label % 50 <> 0").drop("event_id")
    late = captures.filter("label % 7 <> 0").groupBy("label").agg(F.max("timestamp").alias("newest")).select("label", F.lit(99980101000000).alias("seen_at"), "newest")
    known = e.filter("event_id % 5 = 0").select("label", F.col("timestamp").cast("long").alias("seen_at"), F.col("timestamp").alias("newest")).unionByName(late)
    rows = e.withColumn("checked_at", F.when(F.col("event_id") % 3 > 0, 99990101000000).otherwise(F.col("timestamp").cast("long")))
    bound = history.as_of(rows, known, "label", "checked_at", "seen_at", ["newest"])
    sha = F.sha2(F.col("event_id").cast("string"), 256)
    records = bound.select(*rows.columns, F.when(F.col("event_id") % 11 == 0, "x").otherwise(F.col("newest")).alias("latest_indexed_timestamp"), sha.alias("record_sha256"), F.when(F.col("event_id") % 17 == 0, " ").otherwise("an earlier text").alias("selection_reason"))
    kind = F.col("event_id") % 13
    # The state of the check holds, not an older failed one nor one that came later.
    states = e.filter(kind != 0).select("event_id", F.lit(2).cast("long").alias("stated_at"), F.when(kind == 1, "failed").otherwise("parsed").alias("status"), F.when(kind == 2, "x").otherwise(sha).alias("stated_sha256"))
    older, later = (e.filter(kind != 0).select("event_id", F.lit(at).cast("long").alias("stated_at"), F.lit("failed").alias("status"), F.lit("x").alias("stated_sha256")) for at in (1, 99999999999999))
    return history.observations(records, captures, known, states.unionByName(older).unionByName(later), "event_id").select("event_id", "outcome")
