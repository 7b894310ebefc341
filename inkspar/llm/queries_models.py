"""The thin queries of whitening, quality and fill-in-middle: each calls its operator and derives the columns of the contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspar.llm import infill, rules, whitening


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deviation beyond a long (from some 3 million rows on) is null there and whole in deviation_exact."""
    found, fit = whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
    shares = F.lit([float(v) for v in fit.explained]) if fit is not None and len(fit.explained) else F.array().cast("array<double>")
    n, error = (fit.n, fit.identity_error) if fit is not None else (0, 0.0)
    each = found.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), F.col("deviation").try_cast("long").alias("deviation"), "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"), F.col("deviation").alias("deviation_exact"),
    )


#: The least score that counts as good.
GOOD = 0.7


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", held_out.alias("held_out"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    scored, _ = rules.quality(docs, labels, ~F.col("held_out"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))


def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = infill.infill(docs)
    return found.select("doc_id", F.col("units").alias("n"), "form", "prefix_chars", "middle_chars", "output_sha256", infill.restored_column(F.col("form"), F.col("output"))["sha256"].alias("restored_sha256"))


#: The text is its lines and a last line without an end, if there is one; lists are 1-based, and a slice of no units is empty.
_OP13 = """
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS lines, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), cuts AS (
  SELECT *, CAST(len(lines) AS BIGINT) AS n, [CAST('0x' || substr(h, 8 * g + 1, 8) AS BIGINT) FOR g IN [0, 1, 2, 3]] AS d FROM units
), parts AS (
  SELECT *, least(d[1] % (n + 1), d[2] % (n + 1)) AS low, greatest(d[1] % (n + 1), d[2] % (n + 1)) AS high,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR d[3] % 100 >= 100 THEN 'plain' WHEN d[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM cuts
), slices AS (
  SELECT *, coalesce(array_to_string(lines[1:low], ''), '') AS prefix, coalesce(array_to_string(lines[low + 1:high], ''), '') AS middle, coalesce(array_to_string(lines[high + 1:], ''), '') AS suffix FROM parts
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN text ELSE prefix || middle || suffix END) AS restored_sha256
FROM slices
"""

QUERIES = {"op11_whitening": op11_whitening, "op12_quality": op12_quality, "op13_infill": op13_infill}
ORACLES = {"op13_infill": _OP13}
