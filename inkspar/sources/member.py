"""One member of an archive container, proved against its index line."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

MAX_MEMBER = 2 << 20


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _fields(lines: list[str]) -> dict[str, str]:
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def body(compressed: bytes, length: int, original: str, timestamp: str, digest: str, max_member: int = MAX_MEMBER) -> bytes:
    """The page in a gzip member; ValueError says what differs from the index."""

    def need(holds: bool, what: str) -> None:
        if not holds:
            raise ValueError(what)

    need(len(compressed) == length, "compressed length")
    unpack = zlib.decompressobj(31)
    try:
        raw = unpack.decompress(compressed, max_member + 1)
    except zlib.error as error:
        raise ValueError("not a gzip member") from error
    need(len(raw) <= max_member, "size of the member")
    need(unpack.eof, "the member ends early")
    head, gap, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8").split("\r\n")
    record = _fields(lines)
    need(bool(gap) and version in ("WARC/1.0", "WARC/1.1"), "version")
    need(record.get("warc-type") == "response", "type")
    need(record.get("warc-target-uri") == original, "address")
    need(re.sub(r"\D", "", record.get("warc-date", "")) == timestamp, "date")
    size = record.get("content-length", "")
    need(size.isdigit() and int(size) <= len(rest) and not rest[int(size) :].strip(), "block length")
    block = rest[: int(size)]
    need(record.get("warc-block-digest") == f"sha1:{sha1(block)}", "block digest")
    http, gap, page = block.partition(b"\r\n\r\n")
    status, *lines = http.decode("latin-1").split("\r\n")
    sent = _fields(lines)
    need(bool(gap) and re.fullmatch(r"HTTP/1\.[01] 200(?: .*)?", status) is not None, "status")
    need(not {"transfer-encoding", "content-encoding"} & set(sent), "encoded page")
    need(sent.get("content-length", str(len(page))) == str(len(page)), "page length")
    need(sha1(page) == digest and record.get("warc-payload-digest") == f"sha1:{digest}", "payload digest")
    return page


_BODY = StructType([StructField("body", BinaryType()), StructField("error", StringType())])


def bodies(compressed: Column, length: Column, original: Column, timestamp: Column, digest: Column) -> Column:
    """Struct (body, error) of members and their index lines."""

    @F.pandas_udf(_BODY)
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for columns in batches:
            rows = []
            for c, n, o, t, d in zip(*columns, strict=True):
                try:
                    rows.append((body(bytes(c), int(n), o, t, d), None))
                except (ValueError, TypeError, UnicodeDecodeError) as error:
                    rows.append((None, str(error)))
            yield pd.DataFrame(rows, columns=["body", "error"])

    return run(compressed, length, original, timestamp, digest)
