"""Lines of a gzip file of many members, read by as many tasks as the file has ranges.

A range owns the members that begin in it. Where the first begins can't be known without what comes before, so places with gzip's mark are tried: a member is one that
unpacks to its end with its checksum. From there on each member begins where the last one ended. Members are unpacked as streams, never whole, and a file of one
member is read by one task, as it must be.

A line can cross the border of two members. Pieces are therefore read first, (member, place in it), and the open end of a member is joined to the
open begin of the one that starts where it stops. ``lines`` refuses files whose members don't tile them, and lines over more than two members.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from inkspar.operators.normalize import assert_none

FORMAT = "gzip_members"
PIECES = "file string, file_bytes long, member long, member_end long, place long, piece binary, ended boolean"
SPLIT_BYTES = 64 << 20
MAX_LINE = 64 << 10
_MARK, _CHUNK, _ROWS = b"\x1f\x8b\x08", 1 << 20, 20_000


class Range(InputPartition):
    def __init__(self, file: str, size: int, start: int, stop: int):
        self.file, self.size, self.start, self.stop = file, size, start, stop


def unpacked(stream, start: int) -> Iterator[tuple[bytes, int]]:
    """(bytes, end) of the member at start: end is 0 until the last piece. zlib.error if there is no whole member."""
    stream.seek(start)
    unpack, read = zlib.decompressobj(31), 0
    while True:
        data = stream.read(_CHUNK)
        if not data:
            raise zlib.error("a member ends early")
        read += len(data)
        found = unpack.decompress(data)
        if unpack.eof:
            yield found, start + read - len(unpack.unused_data)
            return
        yield found, 0


def first_member(stream, start: int, stop: int) -> int | None:
    """Where the first member that begins from start on, before stop, begins."""
    at = start
    while at < stop:
        stream.seek(at)
        data = stream.read(min(_CHUNK, stop - at) + len(_MARK) - 1)
        place = data.find(_MARK)
        if place < 0 or at + place >= stop:
            at += max(len(data) - len(_MARK) + 1, 1)
            continue
        try:
            for _ in unpacked(stream, at + place):
                pass
            return at + place
        except zlib.error:
            at += place + 1
    return None


class MemberReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.split = options["path"], int(options.get("split_bytes", SPLIT_BYTES))

    def partitions(self) -> list[Range]:
        system, path = fs.FileSystem.from_uri(self.path)
        info = system.get_file_info(path)
        files = [info] if info.is_file else sorted((f for f in system.get_file_info(fs.FileSelector(path, recursive=True)) if f.is_file and not f.base_name.startswith(("_", "."))), key=lambda f: f.path)
        found = [Range(f.path, f.size, start, min(start + self.split, f.size)) for f in files for start in range(0, f.size, self.split)]
        return found or [Range("", 0, 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        p = partition
        if not p.size:
            return
        system, _ = fs.FileSystem.from_uri(self.path)
        with system.open_input_file(p.file) as stream:
            # The file's own begin needs no search: where no member is, that is an error.
            at = 0 if p.start == 0 else first_member(stream, p.start, p.stop)
            while at is not None and at < p.stop:
                yield from self._member(p, stream, at)
                at = self._end

    def _member(self, p: Range, stream, at: int) -> Iterator[pa.RecordBatch]:
        rows, place, rest = [], 0, b""
        try:
            for data, end in unpacked(stream, at):
                *whole, rest = (rest + data).split(b"\n")
                if max(map(len, [rest, *whole])) > MAX_LINE:
                    raise ValueError(f"a line of over {MAX_LINE} bytes in the member at {at}")
                rows += [(place + i, line, True) for i, line in enumerate(whole)]
                place += len(whole)
                if end:
                    self._end = end
                    # The open end, empty where the member closes its last line: it also stands for a member without lines.
                    rows.append((place, rest, False))
                if end or len(rows) >= _ROWS:
                    yield self._batch(p, at, end, rows)
                    rows = []
        except zlib.error as error:
            raise ValueError(f"no gzip member at {at} of {p.file}: {error}") from error

    def _batch(self, p: Range, at: int, end: int, rows: list) -> pa.RecordBatch:
        n = len(rows)
        places, pieces, ended = zip(*rows, strict=True)
        columns = [pa.array([p.file] * n), pa.array([p.size] * n, pa.int64()), pa.array([at] * n, pa.int64()), pa.array([None] * (n - 1) + [end or None], pa.int64()), pa.array(places, pa.int64()), pa.array(pieces, pa.binary()), pa.array(ended)]
        return pa.RecordBatch.from_arrays(columns, names=["file", "file_bytes", "member", "member_end", "place", "piece", "ended"])


class MemberSource(DataSource):
    """Options: path, a file or folder; split_bytes."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return PIECES

    def reader(self, schema) -> MemberReader:
        return MemberReader(self.options)


def pieces(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """PIECES; member_end is set at a member's open end, its last row."""
    spark.dataSource.register(MemberSource)
    return spark.read.format(FORMAT).option("path", path).option("split_bytes", str(split_bytes)).load()


def gaps(found: DataFrame) -> DataFrame:
    """(file, at): members' ends, and files' begins, at which there is neither a member nor the file's end."""
    ends = found.filter("member_end IS NOT NULL AND member_end < file_bytes").select("file", F.col("member_end").alias("at")).unionByName(found.select("file", F.lit(0).cast("long").alias("at")).distinct())
    return ends.join(found.filter("place = 0").select("file", F.col("member").alias("at")), ["file", "at"], "left_anti")


def lines(found: DataFrame) -> DataFrame:
    """(file, member, place, line): all lines, as text, numbered by the member and place where they begin. ``found`` is read more than once."""
    assert_none([("gaps between members", gaps(found))])
    open_ends = found.filter("NOT ended AND octet_length(piece) > 0")
    heads = found.filter("place = 0").select("file", F.col("member").alias("at"), F.col("piece").alias("head"), "ended", F.col("member_end").alias("head_end"))
    crossing = open_ends.select("file", "file_bytes", "member", "place", "piece", F.col("member_end").alias("at")).join(heads, ["file", "at"], "left")
    long = F.coalesce(~F.col("ended") & (F.col("head_end") < F.col("file_bytes")), F.lit(False))
    stitched = F.concat("piece", F.coalesce("head", F.lit(b"")))
    joined = crossing.select("file", "member", "place", F.when(long, F.raise_error(F.lit("a line over more than two members")).cast("binary")).otherwise(stitched).alias("piece"))
    continued = open_ends.select("file", F.col("member_end").alias("member"), F.lit(0).cast("long").alias("place"))
    # Only a member's first line can be a continued one, so no other meets the join.
    closed = found.filter("ended").select("file", "member", "place", "piece")
    firsts = closed.filter("place = 0").join(continued, ["file", "member", "place"], "left_anti")
    return closed.filter("place > 0").unionByName(firsts).unionByName(joined).select("file", "member", "place", F.decode("piece", "UTF-8").alias("line"))
