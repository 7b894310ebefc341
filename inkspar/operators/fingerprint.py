"""Fingerprints of relations that don't depend on row order or layout.

A row is hashed in canonical JSON form (columns in order of name, columns that end in _json as the value
that they hold). A relation's digest is a SHA-256 over the bucket digests, and each bucket's over its sorted row
hashes; rows are dealt to buckets by their hash, so no task holds more than a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from inkspar.functions.text import canonical

BUCKETS = 4096


def _row_form(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for rows in batches:
        yield rows.map(lambda x: canonical({k: json.loads(v) if k.endswith("_json") and v is not None else v for k, v in json.loads(x).items()}))


def row_hashes(df: DataFrame) -> DataFrame:
    """row_sha256 of every row."""
    whole = F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})
    return df.select(F.sha2(F.pandas_udf(_row_form, StringType())(whole), 256).alias("row_sha256"))


def plain_row_hashes(df: DataFrame) -> DataFrame:
    """row_sha256 of every row over its values as text, each behind its length; without Python, for columns of simple types."""
    coded = [F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in sorted(df.columns)]
    return df.select(F.sha2(F.concat(*coded), 256).alias("row_sha256"))


def combined(hashes: DataFrame, name: str, buckets: int = BUCKETS) -> DataFrame:
    """(relation, row_count, sha256) of row hashes."""
    digits = len(f"{buckets - 1:x}")
    by = hashes.groupBy(F.substring("row_sha256", 1, digits).alias("bucket")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("row_sha256")), ""), 256).alias("d"), F.count("*").alias("n"))
    parts = F.array_sort(F.collect_list(F.struct("bucket", "d")))
    return by.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("row_count"), F.sha2(F.array_join(F.transform(parts, lambda p: p["d"]), ""), 256).alias("sha256")).select(F.lit(name).alias("relation"), "row_count", "sha256")


def fingerprint(df: DataFrame, name: str) -> DataFrame:
    return combined(row_hashes(df), name)


def schema_fingerprint(df: DataFrame, name: str) -> DataFrame:
    """(relation, sha256) of the names and types of the columns."""
    listed = canonical([[f.name, f.dataType.simpleString()] for f in sorted(df.schema, key=lambda f: f.name)])
    return df.sparkSession.range(1).select(F.lit(name).alias("relation"), F.sha2(F.lit(listed), 256).alias("sha256"))


def compared(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(relation, outcome): equal, missing, unexpected, rows differ or content differs."""
    a, b = expected.select("relation", F.struct("row_count", "sha256").alias("e")), actual.select("relation", F.struct("row_count", "sha256").alias("a"))
    outcome = F.when(F.col("a").isNull(), "missing").when(F.col("e").isNull(), "unexpected").when(F.col("e.row_count") != F.col("a.row_count"), "rows differ").when(F.col("e.sha256") != F.col("a.sha256"), "content differs").otherwise("equal")
    return a.join(b, "relation", "full").select("relation", outcome.alias("outcome"))
