"""Search views: one row for each searchable text, by kind."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspar.functions.text import contains_ascii_insensitive
from inkspar.operators.normalize import archive_relations, archive_search_view
from inkspar.operators.shared import cut
from inkspar.plans.base import Plans
from inkspar.plans.sources import archive_records
from inkspar.plans.tables import table

PLANS = Plans()

VIEW_SQL = """
    SELECT 'document' AS kind, doc_id AS owner_id, CAST(0 AS BIGINT) AS place, text AS body FROM documents
    UNION ALL SELECT 'turn', conv_id, turn, text FROM conversations
    UNION ALL SELECT 'page', page_id, CAST(0 AS BIGINT), url FROM pages
    UNION ALL SELECT 'part', p_partkey, CAST(0 AS BIGINT), p_name || chr(10) || coalesce(p_type, '') FROM part
    UNION ALL SELECT 'item', item_id, CAST(0 AS BIGINT), text FROM benchmark"""


def view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(kind, owner_id, place, body) of five tables."""

    def part(name: str, kind: str, owner: str, body, place=None) -> DataFrame:
        return table(spark, sf_dir, name).select(F.lit(kind).alias("kind"), F.col(owner).alias("owner_id"), (F.lit(0) if place is None else F.col(place)).cast("bigint").alias("place"), body.alias("body"))

    lines = F.concat(F.col("p_name"), F.chr(F.lit(10)), F.coalesce("p_type", F.lit("")))
    return reduce(DataFrame.unionByName, [part("documents", "document", "doc_id", F.col("text")), part("conversations", "turn", "conv_id", F.col("text"), "turn"), part("pages", "page", "page_id", F.col("url")), part("part", "part", "p_partkey", lines), part("benchmark", "item", "item_id", F.col("text"))])


@PLANS.query(f"""SELECT kind, owner_id, place, CAST(length(body) AS BIGINT) AS body_chars FROM ({VIEW_SQL})
    WHERE contains(translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), 'tion')""")
def search_documents(spark, sf_dir):
    found = view(spark, sf_dir).filter(contains_ascii_insensitive(F.col("body"), "TION"))
    return found.select("kind", "owner_id", "place", F.length("body").cast("bigint").alias("body_chars"))


@PLANS.query(f"SELECT owner_id, place, sha256(body) AS body_sha256 FROM ({VIEW_SQL}) WHERE kind = 'turn' AND contains(body, 'the')")
def search_one_kind(spark, sf_dir):
    """A filter on kind leaves one branch of the union in the plan."""
    return view(spark, sf_dir).filter((F.col("kind") == "turn") & F.contains("body", F.lit("the"))).select("owner_id", "place", F.sha2("body", 256).alias("body_sha256"))


@PLANS.query(f"SELECT kind, count(*) AS n_rows, count(DISTINCT body) AS n_bodies FROM ({VIEW_SQL}) GROUP BY kind")
def search_kinds(spark, sf_dir):
    return view(spark, sf_dir).groupBy("kind").agg(F.count("*").alias("n_rows"), F.countDistinct("body").alias("n_bodies"))


@PLANS.query("""SELECT CAST(s_suppkey AS VARCHAR) AS entry_key, kind, CASE kind WHEN 'entry' THEN s_name || chr(10) WHEN 'note' THEN 'n' || CAST(s_nationkey AS VARCHAR) ELSE 'c' || CAST(s_suppkey AS VARCHAR) END AS text
    FROM supplier, (VALUES ('entry'), ('note'), ('comment')) k(kind) WHERE s_suppkey % 5 <> 0""")
def archive_search_documents(spark, sf_dir):
    """The search view over the relations of historical records, which are parsed from their pages, once for all relations."""
    return archive_search_view(archive_relations(cut(archive_records(spark, sf_dir))))


@PLANS.query("SELECT p_partkey, p_name FROM part WHERE translate(p_name, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') LIKE '%ed%'")
def filter_like(spark, sf_dir):
    return table(spark, sf_dir, "part").filter(contains_ascii_insensitive(F.col("p_name"), "ED")).select("p_partkey", "p_name")


@PLANS.query("SELECT p_partkey, p_size, p_name FROM part WHERE p_size = 4 ORDER BY p_partkey")
def filter_level(spark, sf_dir):
    return table(spark, sf_dir, "part").filter("p_size = 4").select("p_partkey", "p_size", "p_name").orderBy("p_partkey")
