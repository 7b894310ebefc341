"""The thin queries over pages and conversations, and sharding; with SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspar.llm import chat, sharding, warc


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = warc.write(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
    found = warc.captures(spark, paths, payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), "refers_to")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.collapse(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES = {"op1_warc": op1_warc, "op4_sharding": op4_sharding, "op10_chat": op10_chat}
ORACLES = {
    "op1_warc": """
        WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS payload_digest, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes FROM pages),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
        FROM f""",
    "op10_chat": """
        WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
        numbered AS (
            SELECT *, row_number() OVER w AS n, lead(true, 1, false) OVER w AS goes_on,
                coalesce('s' || length(role) || ':' || role, 'n') || coalesce('s' || length(text) || ':' || text, 'n') AS coded,
                '<|im_start|>' || replace(coalesce(role, 'unknown'), '<|', '< |') || chr(10) || replace(coalesce(text, ''), '<|', '< |') || '<|im_end|>' || chr(10) AS shown
            FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), text NULLS FIRST)),
        prefixes AS (SELECT conv_id, n, goes_on, md5(string_agg(coded, '') OVER (PARTITION BY conv_id ORDER BY n)) AS prefix FROM numbered),
        whole AS (SELECT n, prefix, min(conv_id) AS conv_id, count(*) AS n_copies FROM prefixes WHERE NOT goes_on GROUP BY n, prefix),
        kept AS (SELECT * FROM whole w WHERE NOT EXISTS (SELECT 1 FROM prefixes p WHERE p.goes_on AND p.n = w.n AND p.prefix = w.prefix))
        SELECT k.conv_id, CAST(k.n AS BIGINT) AS n_turns, k.n_copies, string_agg(t.shown, '' ORDER BY t.n) AS text
        FROM kept k JOIN numbered t ON k.conv_id IS NOT DISTINCT FROM t.conv_id GROUP BY ALL""",
}
