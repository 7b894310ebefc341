"""Audits: several checks as one report."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkspar.operators import audits, gates
from inkspar.plans.base import Plans
from inkspar.plans.sources import _old_records as observations
from inkspar.plans.sources import entries
from inkspar.plans.tables import table

PLANS = Plans()


@PLANS.query("SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN 'title' WHEN 1 THEN 'meaning' WHEN 2 THEN 'jlpt_level' ELSE 'equal' END AS outcome FROM part")
def audit_current(spark, sf_dir):
    """Stored records against those extracted again from their pages, by the first field that differs. Some stored ones have another title, meaning or level."""
    n = F.col("p_partkey") % 8
    level = F.when((F.col("p_size") % 7).between(1, 5), (F.col("p_size") % 7).cast("int"))
    stored = table(spark, sf_dir, "part").select("p_partkey", F.when(n == 0, F.concat("p_name", F.lit("!"))).otherwise(F.col("p_name")).alias("title"), F.when(n == 1, "x").otherwise(F.col("p_type")).alias("meaning"), F.when(n == 2, F.coalesce(level, F.lit(0)) + 1).otherwise(level).alias("jlpt_level"))
    return audits.reextracted(stored, entries(spark, sf_dir, "title string, meaning string, jlpt_level int"), "p_partkey", ["title", "meaning", "jlpt_level"])


@PLANS.query("""SELECT p_partkey, CASE WHEN p_partkey = 0 THEN 'missing' WHEN p_partkey % 6 = 0 THEN 'japanese' WHEN p_partkey % 6 = 1 THEN 'translation' ELSE 'equal' END AS outcome FROM part""")
def audit_entry_content(spark, sf_dir):
    """The examples of stored records against their pages', by the first field that differs; some stored ones have another sentence or translation, and one page's example has no id to be found by."""
    n = F.col("p_partkey") % 6
    whole = F.concat("p_name", "p_type")
    stored = table(spark, sf_dir, "part").select("p_partkey", F.when(n == 0, F.concat(whole, F.lit("?"))).otherwise(whole).alias("japanese"), F.col("p_brand").alias("reading"), F.when(n == 1, "x").otherwise(F.col("p_type")).alias("translation"))
    pages = entries(spark, sf_dir, "examples array<struct<japanese: string, reading: string, translations: array<struct<text: string>>>>")
    found = pages.select("p_partkey", F.explode("examples").alias("x")).select("p_partkey", "x.japanese", "x.reading", F.get("x.translations", F.lit(0))["text"].alias("translation"))
    return audits.reextracted(stored, found, "p_partkey", ["japanese", "reading", "translation"])


@PLANS.query("""SELECT label, captures, CASE WHEN captures <> stated THEN 'count' WHEN NOT ordered THEN 'order' ELSE 'equal' END AS outcome FROM (SELECT user_id AS label, count(*) AS captures, count(*) + CASE WHEN user_id % 10 = 0 THEN 1 ELSE 0 END AS stated, user_id % 7 <> 0 AS ordered FROM events GROUP BY user_id)""")
def load_inventory(spark, sf_dir):
    """A saved inventory against its own counts and order."""
    rows = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("label")).agg(F.collect_list("event_id").alias("ids"))
    stated = F.size("ids") + F.when(F.col("label") % 10 == 0, 1).otherwise(0)
    saved = rows.select("label", F.when(F.col("label") % 7 == 0, F.reverse(F.array_sort(F.concat("ids", F.array(F.lit(1 << 40)))))).otherwise(F.array_sort("ids")).alias("listed"), F.size("ids").alias("n"), stated.alias("stated"))
    return saved.select("label", F.col("n").cast("bigint").alias("captures"), audits.inventory_outcome(F.when(F.col("label") % 7 == 0, F.slice("listed", 1, F.col("n"))).otherwise(F.col("listed")), F.col("stated")).alias("outcome"))


@PLANS.query("""SELECT CAST(s_nationkey AS INTEGER) AS nation, count(*) AS checked, count(*) FILTER (WHERE bad) AS failed, bool_and(NOT bad) AS complete FROM (SELECT s_nationkey, s_suppkey % 5 = 0 OR s_suppkey % 7 = 0 AS bad FROM supplier) GROUP BY 1""")
def audit_archive(spark, sf_dir):
    """Stored observations against those extracted again from the captured pages, by nation: every seventh has another title, and every fifth page is outside the scope now."""
    rows = table(spark, sf_dir, "supplier")
    title = F.when(F.col("s_suppkey") % 7 == 0, F.concat("s_name", F.lit("?"))).otherwise(F.col("s_name"))
    stored = rows.select("s_suppkey", title.alias("title"), F.col("s_suppkey").cast("string").alias("reading"), F.col("s_nationkey").cast("string").alias("jlpt_level_original"))
    found = observations(spark, sf_dir).filter("error IS NULL")
    outcome = audits.reextracted(stored, found, "s_suppkey", ["title", "reading", "jlpt_level_original"])
    return audits.summary(outcome.join(rows.select("s_suppkey", F.col("s_nationkey").cast("int").alias("nation")), "s_suppkey"), "nation")


@PLANS.query("SELECT page_id, page_id % 3 <> 1 AS same_url, page_id % 3 = 2 AS same_body FROM pages")
def newest_cached_response(spark, sf_dir):
    """A record's hash and address against the newest of its address's cached responses, of which there are three: an old one, the record's, and one that is older or newer than that."""
    pages, kind = table(spark, sf_dir, "pages"), F.col("page_id") % 3
    key = F.sha2(F.concat_ws(" ", "page_id", "url"), 256).alias("url_sha256")
    sha = F.sha2("html", 256)
    old = pages.select(key, F.lit(1).alias("at"), F.lit("old").alias("final_url"), F.lit("old").alias("body_sha256"))
    own = pages.select(key, F.lit(3).alias("at"), F.col("url").alias("final_url"), sha.alias("body_sha256"))
    other = pages.select(key, F.when(kind == 2, 2).otherwise(4).alias("at"), F.when(kind == 0, F.col("url")).otherwise("elsewhere").alias("final_url"), F.lit("other").alias("body_sha256"))
    newest = gates.newest_responses(old.unionByName(own).unionByName(other), "url_sha256", "at", ["final_url", "body_sha256"])
    rows = pages.select("page_id", "url", key, sha.alias("own"))
    return rows.join(newest, "url_sha256").select("page_id", (F.col("url") == F.col("final_url")).alias("same_url"), (F.col("own") == F.col("body_sha256")).alias("same_body"))


@PLANS.query(r"SELECT page_id, page_id % 5 <> 0 AS agrees FROM pages")
def replay_identity(spark, sf_dir):
    """A replay address must hold the capture's own stamp and original."""
    stamp = F.lit("20150224000000")
    shown = F.when(F.col("page_id") % 5 == 0, "20150224000001").otherwise(stamp)
    rows = table(spark, sf_dir, "pages").select("page_id", "url", F.concat(F.lit("https://archive.example.org/web/"), shown, F.lit("id_/"), F.col("url")).alias("replay"))
    return rows.select("page_id", audits.replay_agrees(F.col("replay"), stamp, F.col("url")).alias("agrees"))
