"""WARC archives: writing pages as transactions, reading records back, assembling transactions.

Each page becomes a response or revisit record, and a request and a metadata record that name it in
WARC-Concurrent-To. Of equal payloads of at least ``revisit_bytes`` bytes the page with the smallest id
is the response and the others are revisits that carry the payload's digest and no payload. Each
record is a gzip member of its own; a file ends once it has ``FILE_BYTES`` bytes of records.

Assembly joins requests and metadata with the captures (responses and revisits) that they name in
WARC-Concurrent-To, or that name them there (the field can be repeated), and emits one nested row for each capture.
A record linked from both sides is listed once. A capture without a request or metadata has an empty list. Revisits get the payload's length and the response's page through the
digest they share.

Defined results: a null html is an empty payload; a null page_id is written without a page-id field
and read as null; a null url is written as an empty target; pages that repeat a page_id are captures
of their own, and all those with the smallest id are responses; an empty table gives no files.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspar.llm.common import fresh_path, written
from inkspar.llm.files import opened, replacing

REVISIT_BYTES = 100
FILE_BYTES = 128 << 20
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMES = uuid.uuid5(uuid.NAMESPACE_URL, "inkspar:warc")


def _record(kind: str, record_id: str, block: bytes, content_type: str, more: dict[str, str | None]) -> bytes:
    head = {"WARC-Type": kind, "WARC-Record-ID": record_id, "WARC-Date": DATE, **more, "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}", "Content-Type": content_type, "Content-Length": str(len(block))}
    lines = "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in head.items() if v is not None)
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(b"WARC/1.1\r\n" + lines.encode("utf-8", "surrogatepass") + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def transaction(name: str, page_id: int | None, url: str | None, payload: bytes, digest: str, first_url: str | None, revisit: bool) -> list[bytes]:
    """The records of one page; name makes their ids."""
    ids = [f"<urn:uuid:{uuid.uuid5(_NAMES, f'{name}/{part}')}>" for part in ("capture", "request", "metadata")]
    target = {"WARC-Target-URI": url or ""}
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if revisit:
        more = target | {"WARC-Profile": PROFILE, "WARC-Refers-To-Target-URI": first_url or "", "WARC-Payload-Digest": f"sha256:{digest}"}
        capture = _record("revisit", ids[0], http, "application/http; msgtype=response", more)
    else:
        capture = _record("response", ids[0], http + payload, "application/http; msgtype=response", target | {"WARC-Payload-Digest": f"sha256:{digest}"})
    asked = f"GET {' '.join((url or '/').split())} HTTP/1.1\r\n\r\n".encode("utf-8", "surrogatepass")
    request = _record("request", ids[1], asked, "application/http; msgtype=request", target | {"WARC-Concurrent-To": ids[0]})
    fields = b"" if page_id is None else f"page-id: {page_id}\r\n".encode()
    metadata = _record("metadata", ids[2], fields, "application/warc-fields", target | {"WARC-Concurrent-To": ids[0]})
    return [capture, request, metadata]


_FILE = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])


def write(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", revisit_bytes: int = REVISIT_BYTES) -> list[str]:
    """Writes the archives, and returns their paths."""
    folder = folder or fresh_path(pages.sparkSession, "warc")
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    large = rows.filter(F.octet_length("payload") >= revisit_bytes).select("digest", F.struct(F.isnull("page_id"), "page_id", "url").alias("who"))
    firsts = written(large.groupBy("digest").agg(F.min("who").alias("who"), F.count("*").alias("n")).filter("n > 1").select(F.col("digest").alias("first_digest"), F.col("who.page_id").alias("first_id"), F.col("who.url").alias("first_url")), "repeated-payloads")
    joined = rows.join(firsts, F.col("digest") == F.col("first_digest"), "left").select("page_id", "url", "payload", "digest", "first_url", (F.col("first_digest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))).alias("revisit"))

    def archived(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, seq = TaskContext.get(), 0
        pending = (r for b in batches for i in range(b.num_rows) for r in b.slice(i, 1).to_pylist())
        row = next(pending, None)
        while row is not None:
            uri, records, size = f"{folder}/{context.partitionId():06d}-{seq:06d}.warc.gz", 1, 0
            with replacing(uri, context.taskAttemptId()) as out:
                out.write(_record("warcinfo", f"<urn:uuid:{uuid.uuid5(_NAMES, uri)}>", b"software: inkspar\r\nformat: WARC File Format 1.1\r\n", "application/warc-fields", {}))
                while row is not None and size < FILE_BYTES:
                    for record in transaction(f"{uri}/{records}", row["page_id"], row["url"], row["payload"], row["digest"], row["first_url"], row["revisit"]):
                        out.write(record)
                        size, records = size + len(record), records + 1
                    row = next(pending, None)
            yield pa.RecordBatch.from_pylist([{"path": uri, "records": records, "bytes": size}], _FILE)
            seq += 1

    return sorted(r["path"] for r in joined.mapInArrow(archived, "path string, records bigint, bytes bigint").collect())


def parse(stream) -> Iterator[tuple[dict[str, list[str]], bytes]]:
    """(header fields by lower-case name, each a list of its values, and block) of each record of an uncompressed stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        head: dict[str, list[str]] = {}
        last: list[str] = []
        while (line := stream.readline()).strip():
            if line[:1] in b" \t" and last:
                last[-1] += " " + line.decode("utf-8", "surrogatepass").strip()
                continue
            name, _, value = line.decode("utf-8", "surrogatepass").partition(":")
            last = head.setdefault(name.strip().lower(), [])
            last.append(value.strip())
        record = head.get("warc-record-id", ["without an id"])[0]
        size = int(head["content-length"][0])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError(f"record {record} ends early")
        digest = head.get("warc-block-digest", [""])[0]
        if digest.startswith("sha256:") and digest[7:] != hashlib.sha256(block).hexdigest():
            raise ValueError(f"record {record} differs from its block digest")
        yield head, block


_RECORD = pa.schema(
    [("record_id", pa.string()), ("kind", pa.string()), ("concurrent_to", pa.list_(pa.string()))]
    + [(n, pa.string()) for n in ("target_uri", "date", "content_type", "refers_to_uri", "stated_digest", "http_head")]
    + [("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("fields", pa.string())]
)
RECORD_DDL = "record_id string, kind string, concurrent_to array<string>, target_uri string, date string, content_type string, refers_to_uri string, stated_digest string, http_head string, payload binary, payload_bytes bigint, payload_sha256 string, fields string"


def read(spark: SparkSession, paths: list[str], payloads: bool = True) -> DataFrame:
    """One row for each record; payload is what follows the HTTP head, and null unless asked for. A task holds one record at a time."""
    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)))

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path in (p for b in batches for p in b.column(0).to_pylist()):
            system, name = opened(path)
            rows, size = [], 0
            with system.open_input_stream(name, compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                for head, block in parse(stream):
                    one = {k: v[0] for k, v in head.items()}
                    content, kind = one.get("content-type", ""), one.get("warc-type")
                    http, gap, payload = block.partition(b"\r\n\r\n") if content.startswith("application/http") else (b"", b"", b"")
                    carries = kind == "response"
                    rows.append({
                        "record_id": one.get("warc-record-id"), "kind": kind, "concurrent_to": head.get("warc-concurrent-to", []), "target_uri": one.get("warc-target-uri"), "date": one.get("warc-date"),
                        "content_type": one.get("content-type"), "refers_to_uri": one.get("warc-refers-to-target-uri"), "stated_digest": one.get("warc-payload-digest", "").removeprefix("sha256:") or None,
                        "http_head": http.decode("utf-8", "replace") if gap else None, "payload": payload if carries and payloads else None, "payload_bytes": len(payload) if carries else None,
                        "payload_sha256": hashlib.sha256(payload).hexdigest() if carries else None, "fields": block.decode("utf-8", "replace") if content == "application/warc-fields" else None,
                    })
                    size += len(payload) if payloads else 500
                    if size >= 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, _RECORD)
                        rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _RECORD)

    return listed.mapInArrow(records, RECORD_DDL)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row for each capture: its own fields, requests (list), metadata (list), and what a revisit refers to.

    payload_digest and payload_bytes are those of the full payload; a revisit has them, and page id and
    URI of the response it refers to, from the response with its digest (of several, that with the
    smallest page id). Requests and metadata whose capture isn't among the records appear in no row. A null
    concurrent_to is as an empty one.
    """
    named = F.explode("concurrent_to").alias("concurrent_to")
    beside = records.filter("kind IN ('request', 'metadata')").select("record_id", "kind", "concurrent_to", F.struct("record_id", "date", "target_uri", "http_head", "fields").alias("r"))
    stated = records.filter("kind IN ('response', 'revisit') AND size(concurrent_to) > 0").select(F.col("record_id").alias("capture"), F.explode("concurrent_to").alias("other"))
    by_capture = beside.join(stated, F.col("record_id") == F.col("other")).select(F.col("capture").alias("concurrent_to"), "kind", "r")
    linked = beside.select(named, "kind", "r").unionByName(by_capture)
    gathered = linked.groupBy("concurrent_to").agg(*[F.array_sort(F.collect_set(F.when(F.col("kind") == k, F.col("r")))).alias(name) for k, name in (("request", "requests"), ("metadata", "metadata"))])
    captures = records.filter("kind IN ('response', 'revisit')").drop("concurrent_to", "fields")
    nothing = F.array().cast(gathered.schema["requests"].dataType)
    page = F.regexp_extract(F.concat_ws("\n", F.transform("metadata", lambda m: m["fields"])), r"(?m)^page-id: (-?\d+)", 1)
    joined = captures.join(gathered, captures["record_id"] == gathered["concurrent_to"], "left").drop("concurrent_to")
    joined = joined.withColumn("requests", F.coalesce("requests", nothing)).withColumn("metadata", F.coalesce("metadata", nothing)).withColumn("page_id", F.nullif(page, F.lit("")).cast("bigint"))
    joined = joined.withColumn("payload_digest", F.coalesce("payload_sha256", "stated_digest"))
    own = joined.filter("kind = 'response'").select(F.col("payload_digest").alias("own_digest"), F.struct(F.isnull("page_id"), "page_id", "target_uri", "payload_bytes").alias("who"))
    referred = joined.filter("kind = 'revisit'").select(F.col("payload_digest").alias("own_digest")).distinct()
    sources = own.join(referred, "own_digest", "left_semi").groupBy("own_digest").agg(F.min("who").alias("who"))
    out = joined.join(sources, (F.col("kind") == "revisit") & (F.col("payload_digest") == F.col("own_digest")), "left")
    return out.withColumn("payload_bytes", F.coalesce("payload_bytes", "who.payload_bytes")).withColumn("refers_to", F.col("who.page_id")).drop("own_digest", "who", "payload_sha256", "stated_digest")


def captures(spark: SparkSession, paths: list[str], payloads: bool = True) -> DataFrame:
    """The nested rows of archives; their records are parsed once and kept as a table."""
    return assemble(written(read(spark, paths, payloads), "records"))
