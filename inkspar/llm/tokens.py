"""Token-id files: one array of ids, and document boundaries in Elias-Fano code.

A file holds the ids of its documents one after another, 2 bytes each where the vocabulary allows
it, else 4. The n + 1 boundaries are increasing numbers up to the count of ids: their low bits are
packed, their high bits are a bit array with a one for each boundary, and every 256th one's place is
sampled in 4 bytes. select(i) reads a sample and a few bytes, so an offset costs about
2 + log2(ids / documents) bits instead of 64. Document ids, which ascend, are coded alike.

Layout: MAGIC; ids; boundary code; document-id code; a JSON footer with the places and sizes of
these; the footer's length in 8 bytes; MAGIC. The ids are written as they come, so a task holds
one batch of texts and the boundaries of one file.

Defined results: a null text has no ids but the end id; rows with a null doc_id come first; rows
with equal doc_id are in order of text; an empty table gives no files and no rows.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkspar.llm.common import fresh_path, only, shuffle_partitions
from inkspar.llm.files import opened, replacing

MAGIC = b"INKTOK01"
SAMPLE = 256
#: A file ends when it has this many ids, or documents.
FILE_IDS, FILE_DOCUMENTS = 1 << 26, 1 << 20
#: Remembered chunks between white space, in each worker (about 200 MB when full), and the longest that is remembered.
CACHED, CACHED_CHARS = 1_000_000, 64
#: Texts that are encoded together, by characters.
TOGETHER = 2_000_000
_STOP = re.compile(rb"(?<=[a-z])(?=[.,](?:[ \t-\r]|$))")
_ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(1)


class EliasFano:
    """Non-decreasing integers from 0, with select(i) for the i-th."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        high_at = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(n + (top >> low_bits) + 1, np.uint8)
        bits[high_at] = 1
        low = ((values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        return cls(n, low_bits, np.packbits(low.ravel(), bitorder="little"), np.packbits(bits, bitorder="little"), high_at[::SAMPLE].astype(np.uint32))

    def _low(self, i: int) -> int:
        first = i * self.low_bits
        last = first + self.low_bits
        whole = int.from_bytes(self.low[first // 8 : (last + 7) // 8].tobytes(), "little")
        return (whole >> (first % 8)) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte, skip = at // 8, at % 8
        now = int(self.high[byte]) >> skip << skip
        while (ones := int(_ONES[now])) <= left:
            left, byte = left - ones, byte + 1
            now = int(self.high[byte])
        for _ in range(left):
            now &= now - 1
        place = byte * 8 + (now & -now).bit_length() - 1
        return ((place - i) << self.low_bits) | self._low(i)

    def parts(self) -> tuple[dict, bytes]:
        pieces = [self.low.tobytes(), self.high.tobytes(), self.samples.astype("<u4").tobytes()]
        return {"n": self.n, "low_bits": self.low_bits, "sizes": [len(p) for p in pieces]}, b"".join(pieces)

    @classmethod
    def read(cls, about: dict, data: bytes) -> EliasFano:
        a, b, _ = about["sizes"]
        return cls(about["n"], about["low_bits"], np.frombuffer(data, np.uint8, a), np.frombuffer(data, np.uint8, b, a), np.frombuffer(data, "<u4", offset=a + b))


class Writer:
    """Appends documents to an open stream: those without an id first, then in ascending order of id."""

    def __init__(self, out, dtype: str):
        self.out, self.dtype, self.ends, self.doc_ids, self.nulls, self.total = out, np.dtype(dtype), array("q", [0]), array("q"), 0, 0
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.out.write(ids)
        self.total += len(ids) // self.dtype.itemsize
        self.ends.append(self.total)
        if doc_id is None:
            self.nulls += 1
        else:
            self.doc_ids.append(doc_id)

    def __len__(self) -> int:
        return len(self.ends) - 1

    def close(self) -> None:
        base = self.doc_ids[0] if self.doc_ids else 0
        bounds, bound_bytes = EliasFano.of(np.array(self.ends)).parts()
        # differences of 64-bit numbers are right in unsigned ones, whatever they wrap around
        named, named_bytes = EliasFano.of(np.array(self.doc_ids, np.int64).view(np.uint64) - np.array([base], np.int64).view(np.uint64)).parts()
        self.out.write(bound_bytes + named_bytes)
        footer = json.dumps({"dtype": self.dtype.str, "ids": self.total, "nulls": self.nulls, "base": base, "bounds": bounds, "named": named}).encode()
        self.out.write(footer + len(footer).to_bytes(8, "little") + MAGIC)


class TokenFile:
    """A file opened for reading: any document's ids by its place, or all in order."""

    def __init__(self, uri: str):
        system, path = opened(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        tail = self._at(size - 16, 16)
        if tail[8:] != MAGIC or self._at(0, 8) != MAGIC:
            raise ValueError(f"not a token file: {uri}")
        length = int.from_bytes(tail[:8], "little")
        about = json.loads(self._at(size - 16 - length, length))
        self.dtype, self.total, self.nulls, self.base = np.dtype(about["dtype"]), about["ids"], about["nulls"], about["base"]
        at = 8 + self.total * self.dtype.itemsize
        self.bounds = EliasFano.read(about["bounds"], self._at(at, sum(about["bounds"]["sizes"])))
        self.named = EliasFano.read(about["named"], self._at(at + sum(about["bounds"]["sizes"]), sum(about["named"]["sizes"])))

    def _at(self, at: int, n: int) -> bytes:
        return self.file.read_at(n, at)

    def __len__(self) -> int:
        return self.bounds.n - 1

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.base + self.named.select(i - self.nulls)

    def ids(self, i: int) -> np.ndarray:
        first, end = self.bounds.select(i), self.bounds.select(i + 1)
        return np.frombuffer(self._at(8 + first * self.dtype.itemsize, (end - first) * self.dtype.itemsize), self.dtype)

    def documents(self, block: int = 1 << 22) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, first id's place, ids) of each document in order; ids are read in blocks of about that many, offsets and doc_ids come from select."""
        i, first = 0, 0
        while i < len(self):
            ends = [self.bounds.select(i + 1)]
            while ends[-1] - first < block and i + len(ends) < len(self):
                ends.append(self.bounds.select(i + len(ends) + 1))
            ids = np.frombuffer(self._at(8 + first * self.dtype.itemsize, (ends[-1] - first) * self.dtype.itemsize), self.dtype)
            at = first
            for k, end in enumerate(ends, i):
                yield self.doc_id(k), at, ids[at - first : end - first]
                at = end
            i, first = i + len(ends), at

    def close(self) -> None:
        self.file.close()


class ChunkEncoder:
    """Encodes with a tokenizer that lower-cases, never joins text across white space and marks the last token of each piece.

    Chunks between ASCII white space are encoded by the library, each once while it is remembered; a
    full stop or comma after a letter and before white space is a piece of its own there, so it is cut
    off first. Chunks of letters only are one piece each and go to the library joined by spaces; the
    marks of last tokens part the ids again. A text that has the string of an added token, such as a special one, in any
    case goes to the library whole, as it finds them before it cuts and lower-cases.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.added = [t.content.lower() for t in self.whole.get_added_tokens_decoder().values()]
        #: a sign without case that all of them have, if there is one: texts without it need no closer look
        self.rare = next((c for c in "|<>" if all(c in t for t in self.added)), "")
        # a chunk has no added token, but lower-casing can make one of it
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        size = self.tokenizer.get_vocab_size()
        self.dtype = "<u2" if size <= 1 << 16 else "<u4"
        self.ends = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self.cache: dict[bytes, bytes] = {}

    @staticmethod
    def chunks(text: str) -> list[bytes]:
        data = text.encode("utf-8", "replace")
        if b"\xcc" not in data and b"\xcd" not in data:
            # a combining mark could compose with the small letter only, so such texts keep their case
            data = data.lower()
        return _STOP.sub(b" ", data).split()

    def _encode(self, chunks: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        whole, other = [], []
        for c in chunks:
            (whole if c.decode().isalpha() else other).append(c)
        for at in range(0, len(whole), 4096):
            part = whole[at : at + 4096]
            ids = np.array(self.tokenizer.encode(b" ".join(part).decode(), add_special_tokens=False).ids, self.dtype)
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(part):
                other += part
                continue
            size, data, first = ids.itemsize, ids.tobytes(), 0
            for c, end in zip(part, cuts.tolist(), strict=True):
                yield c, data[first * size : end * size]
                first = end
        made = self.tokenizer.encode_batch([c.decode() for c in other], add_special_tokens=False)
        for c, e in zip(other, made, strict=True):
            yield c, np.array(e.ids, self.dtype).tobytes()

    def _whole(self, text: str) -> bytes:
        return np.array(self.whole.encode(text.encode("utf-8", "replace").decode(), add_special_tokens=False).ids, self.dtype).tobytes()

    def batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as bytes."""
        special = {i for i, x in enumerate(texts) if self.rare in x and any(t in x.lower() for t in self.added)}
        cut = [() if i in special else self.chunks(x) for i, x in enumerate(texts)]
        missing = set().union(*cut).difference(self.cache)
        if len(self.cache) + len(missing) > CACHED:
            self.cache.clear()
            missing = set().union(*cut)
        self.cache.update(self._encode(list(missing)))
        found = [self._whole(texts[i]) if i in special else b"".join(map(self.cache.__getitem__, c)) for i, c in enumerate(cut)]
        for c in missing:
            if len(c) > CACHED_CHARS:
                del self.cache[c]
        return found


def chunk_encoder(path: str) -> ChunkEncoder:
    return only(("chunks", path), lambda: ChunkEncoder(path))


def _encoded(batches: Iterator[pa.RecordBatch], encode: ChunkEncoder) -> Iterator[tuple[int | None, bytes]]:
    for b in batches:
        doc_ids, texts, size = [], [], 0
        for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            doc_ids.append(doc_id)
            texts.append(text.as_py() or "")
            size += len(texts[-1])
            if size >= TOGETHER:
                yield from zip(doc_ids, encode.batch(texts), strict=True)
                doc_ids, texts, size = [], [], 0
        yield from zip(doc_ids, encode.batch(texts), strict=True)


_FILES = "path string, null_ids boolean, first_id bigint, seq int, documents bigint, ids bigint"


def write(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", file_ids: int = FILE_IDS) -> list[dict]:
    """Writes the ids of all texts, in ascending doc_id order, and returns the files in that order with their first ids' places."""
    folder = folder or fresh_path(docs.sparkSession, "tokens")

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, encode = TaskContext.get(), chunk_encoder(tokenizer_path)
        end = np.array([end_id], encode.dtype).tobytes()
        rows = _encoded(batches, encode)
        row, seq = next(rows, None), 0
        while row is not None:
            uri, first = f"{folder}/{context.partitionId():06d}-{seq:06d}.tok", row[0]
            with replacing(uri, context.taskAttemptId()) as out:
                file = Writer(out, encode.dtype)
                while row is not None and file.total < file_ids and len(file) < FILE_DOCUMENTS:
                    file.add(row[0], row[1] + end)
                    row = next(rows, None)
                file.close()
            yield pa.RecordBatch.from_pylist([{"path": uri, "null_ids": first is None, "first_id": first, "seq": seq, "documents": len(file), "ids": file.total}], _ARROW)
            seq += 1

    ordered = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).repartitionByRange(shuffle_partitions(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id", "text")
    files = sorted((r.asDict() for r in ordered.mapInArrow(written, _FILES).collect()), key=lambda r: (not r["null_ids"], r["first_id"] or 0, r["seq"]))
    start = 0
    for f in files:
        f["start"] = start
        start += f["ids"]
    return files


_ARROW = pa.schema([("path", pa.string()), ("null_ids", pa.bool_()), ("first_id", pa.int64()), ("seq", pa.int32()), ("documents", pa.int64()), ("ids", pa.int64())])
_READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def read(spark, files: list[dict]) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files; a task reads a file at a time, in blocks."""
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    listed = spark.createDataFrame([(f["path"], f["start"]) for f in files], "path string, start bigint")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                file, rows = TokenFile(path), []
                for doc_id, at, ids in file.documents():
                    rows.append((doc_id, start + at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    if len(rows) == 10_000:
                        yield _batch(rows)
                        rows = []
                if rows:
                    yield _batch(rows)
                file.close()

    return listed.repartition(max(1, len(files))).mapInArrow(documents, schema)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _READ.types, strict=True)], schema=_READ)
