"""A content-addressed store of bodies: each different body once, named by its SHA-256.

Objects lie in packs, Parquet files sorted by hash, each of one hash prefix. A commit adds a numbered folder of packs, which appears whole by one rename;
nothing in it is changed later. ``store`` deals rows by prefix and sorts them by hash, so equal bodies meet in one task as neighbours, and a task walks along the
sorted hash columns of the earlier packs of its prefixes to leave out what is there. A task's packs have names of their attempt: those of an attempt
that failed or was tried again are in no commit message, and the commit deletes them before the rename. An abort, a row whose stated hash isn't that of its
body, or another commit that came in between leaves the store as it was.

Defined results: null bodies aren't stored; an empty body is an object; a stated hash of null isn't checked; no rows make no commit.
"""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "hashed_objects"
SCHEMA = "sha256 string, size long, body binary"
_PACK = pa.schema([("sha256", pa.string()), ("size", pa.int64()), ("body", pa.binary())])
#: A pack is closed at this size, so a prefix can have several.
PACK_BYTES = 512 << 20
#: Hexadecimal digits of a prefix: 256 prefixes. Stores of many terabytes want 3 or 4.
DIGITS = 2


class Conflict(ValueError):
    """A stated hash isn't the body's, or another commit came first."""


def _listed(system: fs.FileSystem, folder: str) -> list[str]:
    found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted(f.path for f in found)


def commits(root: str) -> list[str]:
    """The numbers of the commits, rising."""
    system, path = fs.FileSystem.from_uri(root)
    return [p.rpartition("/")[2] for p in _listed(system, f"{path.rstrip('/')}/commits")]


@dataclass
class Packed(WriterCommitMessage):
    """What an attempt of a task wrote: its packs' names, different new objects, and objects that were there or came again; the first conflict."""

    packs: list[str] = field(default_factory=list)
    objects: int = 0
    known: int = 0
    repeated: int = 0
    conflict: str | None = None


class PackWriter(DataSourceArrowWriter):
    """Writes rows (sha256, size, body, stated), sorted by hash within prefixes that no other task has."""

    def __init__(self, root: str, digits: int, job: str, seen: list[str], pack_bytes: int = PACK_BYTES):
        self.root, self.digits, self.job, self.seen, self.pack_bytes = root.rstrip("/"), digits, job, seen, pack_bytes

    def _place(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.root)

    def _known(self, system: fs.FileSystem, path: str, prefix: str) -> Iterator[str]:
        """The hashes of a prefix in the commits that were there when the job began, sorted."""

        def hashes(pack: str) -> Iterator[str]:
            with system.open_input_file(pack) as file:
                for batch in pq.ParquetFile(file).iter_batches(4096, columns=["sha256"]):
                    yield from batch.column(0).to_pylist()

        packs = [p for number in self.seen for p in _listed(system, f"{path}/commits/{number}") if p.rpartition("/")[2].startswith(prefix + "-")]
        return heapq.merge(*map(hashes, packs))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Packed:
        system, path = self._place()
        done, own, file, staged = Packed(), [], None, f"{path}/staged/{self.job}"
        prefix = last = current = None
        known: Iterator[str] = iter(())

        def close() -> None:
            nonlocal file
            if file is not None:
                file.close()
                file = None

        try:
            for batch in iterator:
                hashes, stated = batch.column("sha256").to_pylist(), batch.column("stated").to_pylist()
                start = 0
                while start < len(hashes):
                    # A run of one prefix, of which some rows are new.
                    if hashes[start][: self.digits] != prefix:
                        close()
                        prefix = hashes[start][: self.digits]
                        known = self._known(system, path, prefix)
                        current = next(known, None)
                    fresh, stop = [], start
                    while stop < len(hashes) and hashes[stop].startswith(prefix):
                        sha = hashes[stop]
                        if stated[stop] not in (None, sha):
                            done.conflict = f"a body has the hash {sha}, not {stated[stop]}"
                            raise Conflict(done.conflict)
                        while current is not None and current < sha:
                            current = next(known, None)
                        if sha == last:
                            done.repeated += 1
                        elif sha == current:
                            done.known += 1
                        else:
                            fresh.append(stop)
                        last, stop = sha, stop + 1
                    if fresh:
                        if file is None:
                            name = f"{prefix}-{uuid.uuid4().hex}.parquet"
                            system.create_dir(staged, recursive=True)
                            stream = system.open_output_stream(f"{staged}/{name}")
                            file, size = pq.ParquetWriter(stream, _PACK, compression="zstd"), 0
                            own.append((name, stream))
                        rows = batch.select(["sha256", "size", "body"]).take(pa.array(fresh))
                        file.write_batch(pa.RecordBatch.from_arrays([rows.column(i).cast(f.type) for i, f in enumerate(_PACK)], schema=_PACK))
                        done.objects += len(fresh)
                        size += rows.nbytes
                        if size >= self.pack_bytes:
                            close()
                    start = stop
            close()
            for _, stream in own:
                stream.close()
        except BaseException as error:
            close()
            for name, stream in own:
                stream.close()
                system.delete_file(f"{staged}/{name}")
            if isinstance(error, Conflict):
                # No retry mends a conflict: it's the commit that fails.
                return Packed(conflict=done.conflict)
            raise
        done.packs = [name for name, _ in own]
        return done

    def commit(self, messages: list[Packed | None]) -> None:
        system, path = self._place()
        staged = f"{path}/staged/{self.job}"
        try:
            if wrong := next((m.conflict for m in messages if m is not None and m.conflict), None):
                raise Conflict(wrong)
            kept = {name for m in messages if m is not None for name in m.packs}
            if not kept:
                return
            for file in _listed(system, staged):
                if file.rpartition("/")[2] not in kept:
                    system.delete_file(file)
            if commits(self.root) != self.seen:
                raise Conflict("another commit came first")
            system.create_dir(f"{path}/commits", recursive=True)
            system.move(staged, f"{path}/commits/{int(self.seen[-1]) + 1 if self.seen else 1:08d}")
        finally:
            if system.get_file_info(staged).type != fs.FileType.NotFound:
                system.delete_dir(staged)

    def abort(self, messages: list[Packed | None]) -> None:
        system, path = self._place()
        staged = f"{path}/staged/{self.job}"
        if system.get_file_info(staged).type != fs.FileType.NotFound:
            system.delete_dir(staged)


class ObjectStore(DataSource):
    """The data source behind ``store``; options: path, digits, pack_bytes."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return f"{SCHEMA}, stated string"

    def writer(self, schema, overwrite: bool) -> PackWriter:
        if overwrite:
            raise ValueError("objects are added, never replaced")
        root = self.options["path"]
        return PackWriter(root, int(self.options.get("digits", DIGITS)), uuid.uuid4().hex, commits(root), int(self.options.get("pack_bytes", PACK_BYTES)))


def store(df: DataFrame, root: str, body: str = "body", stated: str | None = None, digits: int = DIGITS, tasks: int | None = None) -> None:
    """Adds the bodies of df to the store; with ``stated``, a column of hashes, all of them must be true. One shuffle, by hash prefix."""
    spark = df.sparkSession
    spark.dataSource.register(ObjectStore)
    raw = F.col(body).cast("binary")
    rows = df.filter(F.col(body).isNotNull()).select(F.sha2(raw, 256).alias("sha256"), F.octet_length(raw).cast("long").alias("size"), raw.alias("body"), (F.col(stated) if stated else F.lit(None)).cast("string").alias("stated"))
    dealt = rows.repartition(*([tasks] if tasks else []), F.substring("sha256", 1, digits)).sortWithinPartitions("sha256")
    dealt.write.format(FORMAT).mode("append").option("path", root).option("digits", str(digits)).save()


def read(spark: SparkSession, root: str) -> DataFrame:
    """(sha256, size, body) of all objects; a filter by hash skips the packs and row groups of other ones."""
    numbers = commits(root)
    if not numbers:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(*[f"{root.rstrip('/')}/commits/{n}" for n in numbers])


def verified(spark: SparkSession, root: str) -> DataFrame:
    """(sha256, outcome): equal, or what a stored object breaks: its hash, its size, or being there once."""
    one = read(spark, root).select("sha256", F.when(F.sha2("body", 256) != F.col("sha256"), "hash").when(F.octet_length("body") != F.col("size"), "size").alias("wrong"))
    return one.groupBy("sha256").agg(F.count("*").alias("n"), F.min("wrong").alias("wrong")).select("sha256", F.when(F.col("wrong").isNotNull(), F.col("wrong")).when(F.col("n") > 1, "repeated").otherwise("equal").alias("outcome"))
