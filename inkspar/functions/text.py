"""Text functions as native column expressions; canonical JSON, which Spark lacks, as an Arrow batch function."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def contains_ascii_insensitive(text: Column, part: str) -> Column:
    """Whether part occurs in text, A to Z in either case; no character of part is a wildcard."""
    return F.contains(ascii_lower(text), F.lit("".join(LOWER[UPPER.index(c)] if c in UPPER else c for c in part)))


def collapse_space(text: Column) -> Column:
    """Every run of Unicode white space as one space."""
    return F.regexp_replace(text, r"(?U)\s+", " ")


def strip_space(text: Column) -> Column:
    """Without Unicode white space at either end."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def nonempty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def level_of(text: Column) -> Column:
    """The digit behind "JLPT N", 1 to 5, or null."""
    return F.try_to_number(nonempty(F.regexp_extract(text, "JLPT N([1-5])", 1)), F.lit("9")).cast("int")


def split_title(title: Column) -> Column:
    """Struct (name, reading, label) of "name [reading] (label)"; the bracketed parts can be absent, and a title of another shape is all name."""
    shape = r"^\s*([^\[\(]+?)\s*(?:\[([^\]]*)\]\s*)?\(([^()]*)\)\s*$"
    part = lambda i: nonempty(F.regexp_extract(title, shape, i))
    return F.struct(F.coalesce(part(1), title).alias("name"), part(2).alias("reading"), part(3).alias("label"))


def comment_hash(author: Column, text: Column) -> Column:
    """SHA-256 of author, NUL and text; a missing author counts as the word None."""
    return F.sha2(F.concat(F.coalesce(author, F.lit("None")), F.chr(F.lit(0)), text), 256)


def key_of(label: Column) -> Column:
    """The file key of a label or path."""
    return F.sha2(label, 256)


def observation_key(snapshot: Column, position: Column, source_id: Column, label: Column) -> Column:
    """A key for one entry of one page of one snapshot; absent parts are left out, the label is hashed."""
    return F.concat_ws("-", F.coalesce(snapshot, F.lit("current")), position.cast("string"), source_id.cast("string"), F.substring(key_of(label), 1, 12))


def canonical(value: object) -> str:
    """JSON with sorted keys, no spaces and non-ASCII characters as they are; NaN and infinities are refused."""
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False)


def digest(value: object) -> str:
    return hashlib.sha256(canonical(value).encode()).hexdigest()


def _constant(name: str) -> None:
    raise ValueError(f"{name} is not record data")


@F.pandas_udf(StringType())
def _canonical_json(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield texts.map(lambda x: None if x is None else canonical(json.loads(x, parse_constant=_constant)))


def canonical_json(text: Column) -> Column:
    """The canonical form of JSON text. Works on the text, so that absent and null keys stay different."""
    return _canonical_json(text)


def record_digest(text: Column) -> Column:
    return F.sha2(canonical_json(text), 256)
