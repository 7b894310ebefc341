"""The thin queries over documents: each calls its operator and derives the columns of the contract."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspar.llm import bpe, decontaminate, langid, lm, simhash, spotsigs, tokens


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op2_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spotsigs.compare_edited(documents(spark, sf_dir).select("doc_id", "text"))
    own, edited, following = F.col("signatures"), F.col("edited_signatures"), F.col("next_signatures")
    return found.select(
        "doc_id", F.char_length("text").cast("bigint").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        spotsigs.digest(own).alias("fingerprint"), spotsigs.digest(edited).alias("edited_fingerprint"), spotsigs.likeness(own, edited).alias("near_edited"), spotsigs.likeness(own, following).alias("near_next"),
    )


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    model = langid.train(docs.filter("NOT held_out"))
    return langid.identify(docs.select("doc_id", "held_out", "text"), model, keep_text=False).select("doc_id", "held_out", "lang_pred", "score")


def op6_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = tokens.write(documents(spark, sf_dir).select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return tokens.read(spark, files)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.digest_column(F.col("text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return documents(spark, sf_dir).select("doc_id", found.alias("x")).select("doc_id", "x.n_tokens", "x.ids_sha256", "x.decoded_sha256")


def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    docs = documents(spark, sf_dir).select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    model, words = lm.train(docs.filter("NOT held_out"))
    return lm.score(docs, model, words)


QUERIES = {"op2_spotsigs": op2_spotsigs, "op3_simhash": op3_simhash, "op5_langid": op5_langid, "op6_tokens": op6_tokens, "op7_decontaminate": op7_decontaminate, "op8_bpe": op8_bpe, "op9_lm": op9_lm}
ORACLES: dict[str, str] = {}
