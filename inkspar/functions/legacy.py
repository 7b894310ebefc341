"""Old Japanese pages: strict Shift-JIS, its Windows extension, and repairs where neither fits."""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import quote_from_bytes

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from inkspar.functions.urls import SAFE

#: Names under which pages declare the encoding.
NAMES = {b"shift_jis", b"shift-jis", b"x-sjis"}
_TOKEN = re.compile(rb"<[^>]*>|[^<]+", re.S)
_LABEL = re.compile(rb"[^a-z0-9_-]*([a-z0-9_-]+)")
_QUOTED = re.compile(rb"([\w:-]+)[ \t\r\n]*=[ \t\r\n]*(?:\"([^\"]*)\"|'([^']*)')")


def _declares(head: bytes) -> bool:
    """Whether any charset declaration in the head names the encoding."""
    _, *after = head.lower().split(b"charset")
    labels = (_LABEL.match(part.lstrip()[1:]) for part in after if part.lstrip()[:1] == b"=")
    return any(found is not None and found[1] in NAMES for found in labels)


def _addresses(tag: bytes) -> Iterator[tuple[int, int]]:
    """The places of the quoted values of href and src in a tag."""
    for found in _QUOTED.finditer(tag):
        if found[1].lower() in (b"href", b"src"):
            yield found.span(2 if found[2] is not None else 3)


def _fits(raw: bytes, encoding: str) -> bool:
    try:
        raw.decode(encoding)
    except UnicodeDecodeError:
        return False
    return True


def decode(body: bytes) -> tuple[str, str, list[dict]]:
    """(text, encoding, repairs) of a page.

    A page that declares Shift-JIS is read strictly as such, else as CP932; runs of text that are not
    CP932 are read as UTF-8 if they are that, else with replacement characters, and addresses in tags are
    percent-encoded byte by byte. Each repair names its place and original bytes. Other pages are UTF-8.
    """
    if not _declares(body[:4096]):
        return body.decode("utf-8", "replace"), "utf-8", []
    if _fits(body, "shift_jis"):
        return body.decode("shift_jis"), "shift_jis", []
    out, repairs = [], []

    def repaired(at: int, raw: bytes, encoding: str) -> None:
        repairs.append({"byte_offset": at, "byte_length": len(raw), "encoding": encoding, "original_bytes_hex": raw.hex()})

    for token in _TOKEN.finditer(body):
        raw, at = token[0], token.start()
        if _fits(raw, "cp932"):
            out.append(raw.decode("cp932"))
        elif raw.startswith(b"<"):
            clean, last = b"", 0
            for first, end in _addresses(raw):
                if not _fits(raw[first:end], "cp932"):
                    repaired(at + first, raw[first:end], "percent-encoded-original-url-bytes")
                    clean += raw[last:first] + quote_from_bytes(raw[first:end], safe=SAFE).encode()
                    last = end
            out.append((clean + raw[last:]).decode("cp932", "replace"))
        else:
            encoding = "utf-8" if _fits(raw, "utf-8") else "cp932-with-undecodable-bytes"
            repaired(at, raw, encoding)
            out.append(raw.decode("utf-8") if encoding == "utf-8" else raw.decode("cp932", "replace"))
    return "".join(out), "cp932", repairs


_REPAIR = StructType([StructField("byte_offset", IntegerType()), StructField("byte_length", IntegerType()), StructField("encoding", StringType()), StructField("original_bytes_hex", StringType())])
_DECODED = StructType([StructField("text", StringType()), StructField("encoding", StringType()), StructField("repairs", ArrayType(_REPAIR))])


def decoded(body: Column) -> Column:
    @F.pandas_udf(_DECODED)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for bodies in batches:
            yield pd.DataFrame([(None, None, None) if b is None else decode(bytes(b)) for b in bodies], columns=["text", "encoding", "repairs"])

    return run(body)
