"""A training-corpus pipeline over the table documents: language ID, near-dedup, decontamination, BPE.

Every stage takes (spark, docs, sf_dir), works on all rows of its docs, and its result is written as Parquet
and read again as the next one's docs. All but the last keep the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspar.llm import bpe, decontaminate, langid, simhash
from inkspar.llm.common import written
from inkspar.shipping import ship

#: A document whose best language has less than this share of belief is rejected.
MIN_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts that are null or have no letter, and those of no one language. The model learns from all labelled rows.

    Without any labelled row no language is known, and only texts without a letter go. Rows that repeat are judged alike,
    labels are not asked for in judging, all columns stay, and an empty table stays empty.
    """
    ship(spark)
    model = langid.train(docs)
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    return langid.keep(docs, model, MIN_SCORE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near copies (five-word shingles, Jaccard 0.8 or more) the document with the smallest doc_id.

    Null, empty and blank texts are one group; of rows that repeat one stays; rows without an id stay only where their
    group has no id; all columns stay; an empty table stays empty.
    """
    ship(spark)
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes documents with a passage of the benchmark, exact or edited.

    Null and empty texts have no passage and stay; rows that repeat are judged alike; all columns stay; an empty table stays empty.
    """
    ship(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds ids (the token ids), n_tokens and round_trip (whether decoding gives the text again); columns of these names are replaced.

    A null text is as an empty one and has no ids; an empty table stays empty.
    """
    ship(spark)
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.encode_checked(docs, path, pattern)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontamination", decontamination), ("byte_bpe", byte_bpe)]

#: SQL can't express the stages; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
