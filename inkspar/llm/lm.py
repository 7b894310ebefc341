"""Language-model scores from a log-frequency Bloom filter.

Tokens are the ASCII-lower-cased words of a text and one end. The base model is the smoothed unigram
model with exact counts. The model conditions every token on the word before it, of whatever frequency (the first
on the end of a text):

    p(w | h) = (c(h, w) + MU * base(w)) / (c(h) + MU)

The counts of pairs are quantised, q = 1 + floor(log_BASE c), and c(h, w) is the count that stands for q (the middle
of those with it). c(h) is the exact sum of these over all w, so the probabilities behind any h sum to 1 but for
false positives of the filter. h counts by 32 bits of its hash, and so does w within h.

The Bloom filter holds the keys (pair, 1) to (pair, q): probing level after level until one is missing returns q. It
is cut into blocks by pair, each built in one task from its own pairs' counts. Pairs behind one h are in one block, so
that c(h) is summed there; only where h is more than ``SPLIT`` tokens is it dealt over several blocks. The filter has
``max_bits`` bits at most, which bounds what each worker loads; its file is in the shared folder, so nothing of it
passes through the driver. Pairs of the least counts that a block has no room for are in a table, and each
text's pairs that the filter lacks are looked up there by a join: no pair is lost at any size.

The logarithm of a text's probability is a sum over its tokens of three terms: the base, -log(1 + c(h) / MU) of the
word before it, and log(1 + c(h, w) / (MU * base(w))). So what concerns the ``dictionary`` most frequent words, whose
counts go to the workers, is added there; the other words of each text, of which none can be a large part of the
training texts, are looked up by a join, with the q of the pairs that they end.

Defined results: a null text is as an empty one and has the end only; rows with a null id are kept;
repeated rows are scored each for itself; without training rows every token has the base's
probability 1; an empty table gives no rows; of further columns none is read.
"""

from __future__ import annotations

import io
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkspar.llm.common import frequent_floor, fresh_path, only, release, shuffle_partitions, written
from inkspar.llm.files import opened, replacing

DICTIONARY = 120_000
#: Bits of the whole filter at most, and hashes: a filter is half full, and best, at HASHES / ln 2 bits for each key.
MAX_BITS, HASHES, BASE = 1 << 30, 7, 1.5
MU, ADD = 200.0, 0.1
#: Tokens for each block of pairs; the fewest and the most blocks.
BLOCK_TOKENS, FEWEST, MOST = 1_000_000, 64, 1 << 17
#: A word before more tokens than this, or than one in so many of all, is dealt over several blocks.
SPLIT, SPLIT_SHARE = 200_000, 100_000
#: Different words that a task holds before it sends their counts on, and pairs of its runs of texts.
HELD_WORDS, HELD_PAIRS = 250_000, 1_200_000
#: Tokens of the texts that are counted or scored together.
TOGETHER = 300_000
SEED = 42
#: Stands for the end of a text, and for what is before its first word; no word has a space.
END = b" "
#: Levels of quantised counts; BASE to this power is more than any count.
LEVELS = 110
_HIGH, _LOW = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF)


def tokens(text: str | None) -> list[bytes]:
    """The words of a text; its end is not among them."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _runs(texts: pa.Array) -> Iterator[tuple[int, list[list[bytes]]]]:
    """(place of the first text, words of each) of runs of texts with about TOGETHER tokens."""
    at, held, size = 0, [], 0
    for x in texts:
        held.append(tokens(x.as_py()))
        size += len(held[-1]) + 1
        if size >= TOGETHER:
            yield at, held
            at, held, size = at + len(held), [], 0
    if held:
        yield at, held


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of words and of END."""
    release()
    held: Counter = Counter()
    for b in batches:
        held[END] += b.num_rows
        for text in b.column(0):
            held.update(tokens(text.as_py()))
            if len(held) >= HELD_WORDS:
                yield _counted(held)
                held = Counter()
    if held:
        yield _counted(held)


def _counted(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])


def quantised(n: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(n) / math.log(BASE) + 1e-9).astype(np.int64)


def _doubled() -> np.ndarray:
    """Twice the count that stands for each quantised value (0 for 0), a whole number."""
    q = np.arange(LEVELS + 1, dtype=float)
    low = np.ceil(BASE ** (q - 1) - 1e-9)
    high = np.maximum(np.ceil(BASE**q - 1e-9) - 1, low)
    out = np.minimum(low + high, 1 << 62).astype(np.int64)
    out[0] = 0
    return out


DOUBLED = _doubled()


def _different(texts: list[list[bytes]]) -> tuple[list[bytes], np.ndarray]:
    """The different tokens of texts, ends too, in order of their first places, and which of them each token is, all texts one after the other."""
    flat = list(chain.from_iterable(chain(t, (END,)) for t in texts))
    which = pa.array(flat, pa.binary()).dictionary_encode().indices.to_numpy()
    first = np.flatnonzero(np.diff(np.maximum.accumulate(which), prepend=-1))
    return [flat[i] for i in first.tolist()], which


def pair_keys(texts: list[list[bytes]], different: tuple[list[bytes], np.ndarray] | None = None) -> np.ndarray:
    """A key for each token, ends too, of all texts one after the other: 32 bits of the hash of the word before it, and 32 of its own."""
    words, which = different or _different(texts)
    own = np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(SEED)), np.uint64, len(words))[which]
    before = np.concatenate([np.array([xxhash.xxh64_intdigest(END, SEED)], np.uint64), own[:-1]])
    return (before & _HIGH) | (own & _LOW)


def _mixed(x: np.ndarray) -> np.ndarray:
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
    return x ^ (x >> np.uint64(31))


@dataclass
class Blocks:
    """Which block a pair is in. split has, for the high halves in hot, over how many blocks their pairs are dealt."""

    n: int
    hot: np.ndarray
    split: np.ndarray

    def of(self, keys: np.ndarray) -> np.ndarray:
        high, part = keys >> np.uint64(32), np.zeros(len(keys), np.uint64)
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, high), len(self.hot) - 1)
            part = np.where(self.hot[at] == high, (keys & _LOW) % self.split[at], np.uint64(0))
        return (_mixed(high * np.uint64(0x9E3779B97F4A7C15) + part) % np.uint64(self.n)).astype(np.int64)


_BITS = (1 << np.arange(8)).astype(np.uint8)


def _draws(keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """The two hashes of (key, level); the place by hash i is that of one + i * two."""
    one = _mixed(keys * np.uint64(0x9E3779B97F4A7C15) + np.uint64(level))
    return one, _mixed(one + np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)


def _place(h: np.ndarray, size) -> np.ndarray:
    """A place in so many bits, below 2^32, by a hash's high half: a multiplication, as a division takes several times as long."""
    return (((h >> np.uint64(32)) * size) >> np.uint64(32)).astype(np.int64)


def block_bits(keys: np.ndarray, q: np.ndarray, hashes: int = HASHES) -> np.ndarray:
    """The bytes of a block that holds all levels of the keys."""
    size = max(64, 8 * math.ceil(int(q.sum()) * hashes / math.log(2) / 8))
    bits = np.zeros(size, bool)
    for level in range(1, int(q.max(initial=0)) + 1):
        one, two = _draws(keys[q >= level], level)
        for i in range(hashes):
            bits[_place(one + np.uint64(i) * two, np.uint64(size))] = True
    return np.packbits(bits, bitorder="little")


class LogBloom:
    """The whole filter; block b has sizes[b] bits from bit starts[b] on, and one without any holds nothing."""

    def __init__(self, blocks: Blocks, starts: np.ndarray, sizes: np.ndarray, bits: np.ndarray, hashes: int = HASHES):
        self.blocks, self.starts, self.sizes, self.bits, self.hashes = blocks, starts, sizes, bits, hashes

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The quantised counts; too high where a missing level's bits all happen to be set."""
        block, q = self.blocks.of(keys), np.zeros(len(keys), np.int64)
        active = np.flatnonzero(self.sizes[block] > 0)

        def on(one: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
            at = start + _place(one, size)
            return (self.bits[at >> 3] & _BITS[at & 7]) != 0

        for level in range(1, LEVELS + 1):
            own = block[active]
            one, two = _draws(keys[active], level)
            start, size = self.starts[own], self.sizes[own].astype(np.uint64)
            # Of the keys that lack a level most lack its first bit; the others are asked for all its bits.
            left = on(one, start, size)
            active, one, two, start, size = active[left], one[left], two[left], start[left], size[left]
            left = np.ones(len(active), bool)
            for i in range(1, self.hashes):
                left &= on(one + np.uint64(i) * two, start, size)
            active = active[left]
            if len(active) == 0:
                break
            q[active] = level
        return q

    @classmethod
    def read(cls, uri: str, blocks: Blocks, hashes: int) -> LogBloom:
        system, path = opened(uri)
        with system.open_input_file(path) as f:
            data = f.read()
        at = int.from_bytes(data[-8:], "little")
        index = np.load(io.BytesIO(data[at:-8]))
        starts, sizes = np.zeros(blocks.n, np.int64), np.zeros(blocks.n, np.int64)
        starts[index[:, 0]], sizes[index[:, 0]] = index[:, 1] * 8, index[:, 2] * 8
        return cls(blocks, starts, sizes, np.frombuffer(data, np.uint8, at), hashes)


@dataclass
class Model:
    """What the workers get: the most frequent words' numbers, counts and context totals (END is number 0), and where the filter is."""

    total: int
    distinct: int
    numbers: dict[bytes, int]
    counts: np.ndarray
    doubled_totals: np.ndarray
    filter_path: str
    blocks: Blocks
    hashes: int
    #: (key, q) of the pairs that the filter had no room for, if there are any; stays with the driver.
    left_out: DataFrame | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"left_out": None}

    @property
    def denominator(self) -> float:
        return self.total + ADD * (self.distinct + 1)

    def bloom(self) -> LogBloom:
        return only(("lm", self.filter_path), lambda: LogBloom.read(self.filter_path, self.blocks, self.hashes))


def _blocks(words: DataFrame, total: int) -> Blocks:
    most = max(SPLIT, total // SPLIT_SHARE)
    hot = sorted((xxhash.xxh64_intdigest(bytes(r["word"]), SEED) >> 32, math.ceil(r["n"] / most)) for r in words.filter(F.col("n") > most).collect())
    return Blocks(min(MOST, max(FEWEST, total // BLOCK_TOKENS)), np.array([h for h, _ in hot], np.uint64), np.array([s for _, s in hot], np.uint64))


def _packed(held: list[tuple[np.ndarray, np.ndarray]], blocks: Blocks) -> pa.RecordBatch:
    """The pairs of several runs, each once, as a row for each block."""
    keys, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
    n = np.bincount(at, np.concatenate([t for _, t in held]), len(keys)).astype("<u4")
    block = blocks.of(keys)
    order = np.argsort(block, kind="stable")
    cuts = np.flatnonzero(np.diff(block[order])) + 1
    parts = np.split(order, cuts)
    return pa.RecordBatch.from_arrays(
        [pa.array([int(block[p[0]]) for p in parts], pa.int32()), pa.array([keys[p].tobytes() for p in parts], pa.binary()), pa.array([n[p].tobytes() for p in parts], pa.binary())], names=["block", "keys", "counts"]
    )


_PARTS = "block int, bits binary, h bigint, doubled bigint, key bigint, q int"
_PARTS_ARROW = pa.schema([("block", pa.int32()), ("bits", pa.binary()), ("h", pa.int64()), ("doubled", pa.int64()), ("key", pa.int64()), ("q", pa.int32())])


def _part(n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _PARTS_ARROW], schema=_PARTS_ARROW)


def _block_parts(block: int, keys: np.ndarray, n: np.ndarray, most_bits: float, hashes: int) -> Iterator[pa.RecordBatch]:
    """Of a block's pairs, of which keys and n have several parts: its bits, the totals of what they follow, and the pairs that it has no room for."""
    order = np.argsort(keys)
    keys, first = np.unique(keys[order], return_index=True)
    q = quantised(np.add.reduceat(n[order], first))
    high, at = np.unique(keys >> np.uint64(32), return_index=True)
    yield _part(len(high), h=high.astype(np.int64), doubled=np.add.reduceat(DOUBLED[q], at))
    levels = np.arange(LEVELS + 1) * np.bincount(q, minlength=LEVELS + 1)
    room = np.cumsum(levels[::-1])[::-1] * hashes / math.log(2) <= most_bits
    inside = room[q]
    yield _part(1, block=[block], bits=[block_bits(keys[inside], q[inside], hashes).tobytes()])
    if not inside.all():
        yield _part(int((~inside).sum()), key=keys[~inside].view(np.int64), q=q[~inside])


def train(docs: DataFrame, text_col: str = "text", dictionary: int = DICTIONARY, max_bits: int = MAX_BITS, hashes: int = HASHES) -> tuple[Model, DataFrame]:
    """The model, and the table (word, n, doubled) of all words and END: exact counts, and twice the totals of the pairs behind them."""
    spark = docs.sparkSession
    rows = docs.select(F.col(text_col).cast("string").alias("text"))
    counted = written(rows.mapInArrow(_count_words, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n")), "words")
    total, distinct = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    blocks = _blocks(counted, total)
    n, most_bits = min(blocks.n, shuffle_partitions(spark)), max_bits / blocks.n

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        held, size = [], 0
        for batch in batches:
            for _, texts in _runs(batch.column(0)):
                held.append(np.unique(pair_keys(texts), return_counts=True))
                size += len(held[-1][0])
                if size >= HELD_PAIRS:
                    yield _packed(held, blocks)
                    held, size = [], 0
        if held:
            yield _packed(held, blocks)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, keys, counts = None, [], []
        for b in batches:
            for block, k, c in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
                if block != own and keys:
                    yield from _block_parts(own, np.concatenate(keys), np.concatenate(counts).astype(np.int64), most_bits, hashes)
                    keys, counts = [], []
                own = block
                keys.append(np.frombuffer(k.as_py(), np.uint64))
                counts.append(np.frombuffer(c.as_py(), "<u4"))
        if keys:
            yield from _block_parts(own, np.concatenate(keys), np.concatenate(counts).astype(np.int64), most_bits, hashes)

    packed = rows.mapInArrow(count_pairs, "block int, keys binary, counts binary").repartition(n, "block").sortWithinPartitions("block")
    parts = written(packed.mapInArrow(build, _PARTS), "pairs")
    totals = parts.filter("h IS NOT NULL").groupBy("h").agg(F.sum("doubled").alias("doubled"))
    words = counted.withColumn("h", F.shiftrightunsigned(F.xxhash64("word"), 32)).join(totals, "h", "left").select("word", "n", F.coalesce("doubled", F.lit(0)).alias("doubled"))
    words = written(words, "words-and-totals")
    frequent = sorted(words.filter((F.col("n") >= frequent_floor(words, "n", dictionary)) | (F.col("word") == END)).collect(), key=lambda r: (bytes(r["word"]) != END, bytes(r["word"])))
    # without training rows END is known all the same, with no count
    numbers = {END: 0} | {bytes(r["word"]): i for i, r in enumerate(frequent)}
    known = [(r["n"], r["doubled"]) for r in frequent] or [(0, 0)]
    left_out = parts.filter("key IS NOT NULL").select("key", "q")
    model = Model(total, distinct, numbers, np.array([k for k, _ in known], np.int64), np.array([k for _, k in known], np.int64), _filter_file(parts), blocks, hashes)
    if not left_out.isEmpty():
        model.left_out = left_out
    return model, words


def _filter_file(parts: DataFrame) -> str:
    """Writes the blocks' bits, bounded in all, one after the other; behind them an index (block, first byte, bytes) and its place."""
    spark = parts.sparkSession
    uri = fresh_path(spark, "log-bloom")

    def collected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, at, packed = [], 0, io.BytesIO()
        with replacing(uri, TaskContext.get().taskAttemptId()) as out:
            for b in batches:
                for block, bits in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                    if data := bits.as_py():
                        out.write(data)
                        index.append((block, at, len(data)))
                        at += len(data)
            np.save(packed, np.array(index, np.int64).reshape(-1, 3))
            out.write(packed.getvalue() + at.to_bytes(8, "little"))
        yield pa.RecordBatch.from_pylist([{"bytes": at}], pa.schema([("bytes", pa.int64())]))

    bits = parts.filter("bits IS NOT NULL").select("block", "bits")
    # a row of no block, so that an empty table gives a file too
    bits.unionByName(spark.range(1).select(F.lit(0).alias("block"), F.lit(b"").alias("bits"))).repartition(1).mapInArrow(collected, "bytes bigint").collect()
    return uri


_SCORED = "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, gain double, open array<struct<word: binary, prior: double, key: bigint, q: int, n: int>>"
_OPEN = pa.list_(pa.struct([("word", pa.binary()), ("prior", pa.float64()), ("key", pa.int64()), ("q", pa.int32()), ("n", pa.int32())]))


def _scorer(shared, all_held: bool):
    """What the dictionary's words add to each text's scores; open has the tokens of which the word, or a pair that the filter lacks, has yet to be looked up."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, row = shared.value, TaskContext.get().partitionId() << 40
        bloom, get = m.bloom(), m.numbers.get
        base = np.log10((m.counts + ADD) / m.denominator)
        prior = MU * (m.counts + ADD) / m.denominator
        behind = -np.log10(1 + m.doubled_totals / 2 / MU)
        for b in batches:
            for at, texts in _runs(b.column(1)):
                sizes = np.array([len(t) + 1 for t in texts])
                starts = np.cumsum(sizes) - sizes
                found = _different(texts)
                number = np.fromiter(map(get, found[0], repeat(-1)), np.int64, len(found[0]))[found[1]]
                before = np.concatenate([np.zeros(1, np.int64), number[:-1]])
                keys = pair_keys(texts, found)
                different, inverse = np.unique(keys, return_inverse=True)
                q = bloom.get(different)[inverse]
                known = number >= 0
                gains = np.where(before >= 0, behind[before], 0.0) + np.where(known, np.log10(1 + DOUBLED[q] / 2 / prior[number]), 0.0)
                added = [np.add.reduceat(x, starts) for x in (np.where(known, base[number], 0.0), gains, known & (m.counts[number] > 0))]
                opened_ = _open(found, starts, keys, q, known, prior[number], all_held)
                part = b.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + len(texts))), part.column(0), part.column(2), pa.array(sizes), pa.array(added[2].astype(np.int64)), pa.array(added[0]), pa.array(added[1]), opened_],
                    names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "gain", "open"],
                )
                row += len(texts)

    return scored


def _open(found: tuple[list[bytes], np.ndarray], starts: np.ndarray, keys: np.ndarray, q: np.ndarray, known: np.ndarray, prior: np.ndarray, all_held: bool) -> pa.Array:
    """What has yet to be looked up of each text, equal ones once with their number."""
    words, which = found
    places = np.flatnonzero(~known if all_held else ~known | (q == 0))
    text = np.searchsorted(starts, places, "right") - 1
    ask = np.zeros(len(places), bool) if all_held else q[places] == 0
    # Rows are equal if text, word and level are, and where the pair is asked for its key too.
    alike = np.stack([text, which[places], q[places], np.where(ask, keys[places].view(np.int64), 0)])
    order = np.lexsort(alike[::-1])
    alike, places, ask = alike[:, order], places[order], ask[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(places)), bool), (alike[:, 1:] != alike[:, :-1]).any(axis=0)]))
    n, places, ask = np.diff(first, append=len(places)), places[first], ask[first]
    own = known[places]
    columns = [
        pa.array([None if x else words[w] for x, w in zip(own.tolist(), which[places].tolist(), strict=True)], pa.binary()), pa.array(prior[places], pa.float64(), mask=~own),
        pa.array(keys[places].view(np.int64), pa.int64(), mask=~ask), pa.array(q[places], pa.int32()), pa.array(n, pa.int32()),
    ]
    entries = pa.StructArray.from_arrays(columns, fields=list(_OPEN.value_type))
    ends = np.cumsum([0, *np.bincount(alike[0][first], minlength=len(starts))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries)


def _stands(q: Column) -> Column:
    return F.get(F.array(*[F.lit(float(x) / 2) for x in DOUBLED]), q)


def _looked_up(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """rows with the columns of table's row of their key, or nulls. Rows without a key, most of all where a filter is full, stay out of the join, where they would meet in one task."""
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema if f.name != key]
    return rows.filter(F.col(key).isNotNull()).join(table, key, "left").unionByName(rows.filter(F.col(key).isNull()).select("*", *blank))


def score(docs: DataFrame, model: Model, words: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out_col: str = "held_out") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(held_out_col).alias("held_out"))
    first = written(rows.mapInArrow(_scorer(shared, model.left_out is None), _SCORED), "scored")
    asked = first.select("row", F.explode("open").alias("o")).select("row", "o.*")
    if model.left_out is not None:
        asked = _looked_up(asked, model.left_out.select("key", F.col("q").alias("left_q")), "key").withColumn("q", F.coalesce("left_q", "q"))
    looked_up = _looked_up(asked, words.select("word", F.col("n").alias("c"), "doubled"), "word")
    count = F.coalesce("c", F.lit(0))
    share = (count + ADD) / F.lit(model.denominator)
    prior, own = F.coalesce("prior", MU * share), F.col("word").isNotNull()
    gain = F.log10(1 + _stands(F.col("q")) / prior) - F.when(own, F.log10(1 + F.coalesce("doubled", F.lit(0)) / 2 / MU)).otherwise(0.0)
    more = looked_up.groupBy("row").agg(
        F.sum(F.when(own & (count > 0), F.col("n")).otherwise(0)).alias("known"), F.sum(F.when(own, F.col("n") * F.log10(share)).otherwise(0.0)).alias("base"), F.sum(F.col("n") * gain).alias("more_gain")
    )
    both = first.drop("open").join(more, "row", "left")
    base = F.col("base_score") + F.coalesce("base", F.lit(0.0))
    score_ = base + F.col("gain") + F.coalesce("more_gain", F.lit(0.0))
    return both.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(model.total).cast("bigint").alias("train_tokens"), base.alias("base_score"), score_.alias("score"))
