r"""Benchmark decontamination: passages of documents within a small edit distance of a benchmark item.

Distances are between sequences of words (lower-cased runs of what Python's ``\w`` takes: letters, digits and
"_"; other signs, combining marks among them, part words). An item of n words is found where some passage of a
document differs from it by at most floor(n * edits) word edits. The steps, for the items of one block (a bounded
part of the benchmark, broadcast; blocks are worked off one after the other, and each one's broadcast is released):

1. Windows. An item with at most k edits has, of its k + 1 pieces, one unchanged. So only windows of
   the item's size around a place where a piece of it occurs can match. Of these, only such stay around which n - k
   or more words are the item's, as any match has. Neither test drops a window that could match. Pieces are looked
   up by hashes of one to four words, in whole texts.
2. Embedding. A CGK walk reads a window by a random rule: at step j it writes the current word
   and moves on or stays, as a random bit of (repetition, j, word) says. Strings at edit distance k thus get
   outputs at Hamming distance O(k squared), and with constant probability few.
3. Bit sampling. Each walk samples ``SAMPLED`` places of its output; a window and an item with equal samples in any
   repetition are a candidate pair. There are as many repetitions as simulated edits need to reach the ``recall``
   asked for, at every number of edits that is allowed (``repetitions``). Windows at all offsets up to k around
   a place are tried, so an edit before the place does no harm.
4. Verification. The exact edit distance of the item to the best passage around the candidate
   decides.

One row is returned for each (document, item), with the best passage (smallest distance, then
first).

Defined results: null and empty texts have no passages; items that are null, without a word or under ``min_words``
words (1: none is left out) match nothing; equal items each match; repeated documents each get their rows; a null
doc_id stays null; empty tables give no rows; further columns of any name are kept by ``clean`` and ignored by ``matches``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from inkspar.llm.common import fresh_path, release, written

EDITS = 0.2
MIN_WORDS = 1
#: Share of the matches that the sampled walks have to reach, and the places that each samples.
RECALL, SAMPLED = 0.999, 2
#: Pairs of edited strings by which repetitions are found; items of more than DIRECT words are taken at lengths that grow by STEP, with fewer pairs.
SIMULATED, DIRECT, STEP, LONG_PAIRS = 1_000, 64, 1.25, 200
#: Share of the estimated chance of a meeting that is counted on for these, and the repetitions beyond which a recall can't be promised.
CAUTION, BEYOND = 0.8, 1 << 14
#: Items that are broadcast at once, by their characters.
BLOCK_CHARS = 8 << 20
#: Tokens looked up together; windows embedded together; pairs of a place and an item looked at together.
TOGETHER, WINDOWS, PAIRS = 400_000, 20_000, 200_000
#: Over any place in a run of texts.
_HOME = 1 << 40
_WORD = re.compile(r"\w+")


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def allowed(n: int, edits: float = EDITS) -> int:
    return int(n * edits + 1e-9)


def best_passage(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(distance, start, end) of the passage text[start:end] nearest to item; of several the first to end, and of those the longest."""
    n, m = len(item), len(text)
    cost, start = np.zeros(m + 1, np.int64), np.arange(m + 1)
    at = np.arange(m + 1)
    for i in range(n):
        change = np.concatenate([[i + 1], cost[:-1] + (text != item[i])])
        change_start = np.concatenate([[0], start[:-1]])
        drop = cost + 1
        use = drop < change
        now, now_start = np.where(use, drop, change), np.where(use, start, change_start)
        # insertions run along the row: the least of cost - place so far, plus place
        rel = now - at
        least = np.minimum.accumulate(rel)
        first = np.maximum.accumulate(np.where(rel == least, at, 0))
        cost, start = least + at, now_start[first]
    end = int(cost.argmin())
    return int(cost[end]), int(start[end]), end


@dataclass
class Items:
    """A block of items; made ready for look-up once in each worker. times: repetitions by number of words."""

    ids: list
    texts: list[list[str]]
    edits: float
    recall: float = RECALL
    times: dict[int, int] = field(default_factory=dict)
    vocabulary: dict[str, int] = field(default_factory=dict)
    arrays: list[np.ndarray] = field(default_factory=list)
    ready: bool = False

    def __post_init__(self):
        # found by the driver, once for all workers
        self.times = {n: repetitions(n, allowed(n, self.edits), self.recall) for n in {len(t) for t in self.texts}}

    def prepare(self) -> Items:
        if self.ready:
            return self
        for t in self.texts:
            for w in t:
                self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
        self.arrays = [np.array([self.vocabulary[w] for w in t], np.int64) for t in self.texts]
        # pieces by length: sorted keys, with the item and the offset of each
        pieces: dict[int, list[tuple[int, int, int]]] = {}
        for i, x in enumerate(self.arrays):
            parts = allowed(len(x), self.edits) + 1
            for p in range(parts):
                a, b = p * len(x) // parts, (p + 1) * len(x) // parts
                size = min(b - a, 4)
                pieces.setdefault(size, []).append((int(_keys(x, size, np.array([a]))[0]), i, a))
        self.pieces = {}
        for size, found in pieces.items():
            found.sort()
            self.pieces[size] = tuple(np.array(c, t) for c, t in zip(zip(*found, strict=True), (np.uint64, np.int64, np.int64), strict=True))
        self.lengths = np.array([len(x) for x in self.arrays], np.int64)
        self.edited = np.array([allowed(len(x), self.edits) for x in self.arrays], np.int64)
        #: (item, word) as one number, in order
        self.members = np.unique(np.concatenate([i * (len(self.vocabulary) + 1) + x for i, x in enumerate(self.arrays)] or [np.zeros(0, np.int64)]))
        self.signatures = {int(n): self._signatures(int(n)) for n in np.unique(self.lengths)}
        self.ready = True
        return self

    def _signatures(self, n: int) -> tuple[int, list[np.ndarray], list[np.ndarray]]:
        """Of the items of n words: the repetitions, and by repetition the samples in order and whose they are."""
        own, times = np.flatnonzero(self.lengths == n), self.times[n]
        samples = cgk_samples(np.stack([self.arrays[i] for i in own]), times)
        order = np.argsort(samples, axis=1, kind="stable")
        return times, [s[o] for s, o in zip(samples, order, strict=True)], [own[o] for o in order]

    def has(self, items: np.ndarray, found: np.ndarray) -> np.ndarray:
        """Whether each item has the word of its row's cells; 0 is no item's word."""
        key = items[:, None] * (len(self.vocabulary) + 1) + found
        at = np.minimum(np.searchsorted(self.members, key), len(self.members) - 1)
        return (self.members[at] == key) & (found > 0)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _keys(x: np.ndarray, size: int, places: np.ndarray) -> np.ndarray:
    """A hash of the size words from each place on."""
    key = np.zeros(len(places), np.uint64)
    for i in range(size):
        key = _mix(key * np.uint64(31) + x[places + i].astype(np.uint64) + np.uint64(1))
    return key


@lru_cache(maxsize=1 << 16)
def _places(r: int, n: int) -> np.ndarray:
    """The places that repetition r samples, of the first 2 n steps, in which a walk passes about n words."""
    return np.sort(np.random.default_rng((r, n)).choice(max(2 * n, SAMPLED), SAMPLED, replace=False))


def cgk_samples(windows: np.ndarray, times: int) -> np.ndarray:
    """A hash for each repetition (row) and window (column; equal-sized rows of word numbers): the sampled places of its CGK embeddings.

    A walk moves on at every second step on average; what it writes after the end is 0. A word's hash at a step
    has a bit for each of 64 repetitions, which walk together.
    """
    count, n = windows.shape
    different, number = np.unique(np.concatenate([np.zeros(1, windows.dtype), windows.ravel()]), return_inverse=True)
    different = different.astype(np.uint64)
    flat = np.zeros((count, n + 1), np.int32)
    flat[:, :n] = number.ravel()[1:].reshape(count, n)
    flat, first = flat.ravel(), np.arange(count, dtype=np.int32 if count * (n + 1) < 1 << 31 else np.int64) * (n + 1)
    out = np.zeros((times, count), np.uint64)
    for group in range(0, times, 64):
        sampled = {r: _places(r, n) for r in range(group, min(group + 64, times))}
        # those that end last come first, so that the ones still on their way stand together
        order = sorted(sampled, key=lambda r: -sampled[r][-1])
        ends = np.array([sampled[r][-1] for r in order])
        at = np.zeros((len(order), count), first.dtype)
        key = np.repeat(np.array(order, np.uint64) + np.uint64(1), count).reshape(len(order), count)
        shift = (np.array(order, np.uint64) - np.uint64(group))[:, None]
        for j in range(int(ends[0]) + 1):
            on = int((ends >= j).sum())
            here = flat[at[:on] + first]
            for x in [x for x in range(on) if j in sampled[order[x]]]:
                key[x] = _mix(key[x] * np.uint64(31) + different[here[x]] + np.uint64(7))
            bits = _mix(different * np.uint64(0x9E3779B97F4A7C15) + np.uint64((group << 32) + j))
            at[:on] += ((bits[here] >> shift[:on]) & np.uint64(1)).astype(at.dtype)
            np.minimum(at[:on], n, out=at[:on])
        out[order] = key
    return out


def _edited_pairs(n: int, k: int, count: int) -> np.ndarray:
    """An item of n different words, row 0, and passages that are k random edits away."""
    rng = np.random.default_rng((n, k))
    rows = np.zeros((count + 1, n), np.int64)
    rows[0] = np.arange(1, n + 1)
    for row in rows[1:]:
        own = rows[0].tolist()
        for new in range(k):
            at, kind = int(rng.integers(len(own))), int(rng.integers(3))
            if kind == 0:
                own[at] = n + 1 + new
            elif kind == 1:
                own.insert(at, n + 1 + new)
            elif len(own) > 1:
                del own[at]
        own = own[:n]
        row[: len(own)] = own
    return rows


@lru_cache(maxsize=4096)
def repetitions(n: int, k: int, recall: float = RECALL) -> int:
    """The least repetitions by which a share ``recall`` of simulated passages, k random edits from an item of n words, share a sample with it.

    The simulated words are all different, so no walk meets another by chance; fewer edits need no more. Long items are taken at the two lengths of a
    grid around them, with the same share of edits, and the larger number of these holds. ValueError where the recall can't be reached.
    """
    if k == 0:
        return 1
    if n <= DIRECT:
        return _counted(n, k, recall)
    low = int(np.log(n / DIRECT) / np.log(STEP))
    return max(_estimated(g, -(-g * k // n), recall) for g in {round(DIRECT * STEP**i) for i in (low, low + 1)})


@lru_cache(maxsize=4096)
def _counted(n: int, k: int, recall: float) -> int:
    both = _edited_pairs(n, k, SIMULATED)
    met, times = np.zeros(SIMULATED, bool), 0
    made = cgk_samples(both, 64)
    while met.mean() < recall:
        if times == len(made):
            if times >= BEYOND:
                raise ValueError(f"a recall of {recall} for {k} edits of {n} words takes over {BEYOND} repetitions")
            made = cgk_samples(both, 2 * times)
        met |= made[times][1:] == made[times][0]
        times += 1
    return times


@lru_cache(maxsize=4096)
def _estimated(n: int, k: int, recall: float) -> int:
    """From the chance that a repetition's samples meet: in long items all passages have about the same."""
    made = cgk_samples(_edited_pairs(n, k, LONG_PAIRS), 64)
    chance = CAUTION * float((made[:, 1:] == made[:, :1]).mean())
    times = int(np.ceil(np.log(1 - recall) / np.log1p(-chance))) if chance else BEYOND + 1
    if times > BEYOND:
        raise ValueError(f"a recall of {recall} for {k} edits of {n} words takes over {BEYOND} repetitions")
    return times


def _ranges(found: np.ndarray, keys: np.ndarray, most: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each key, every entry of a sorted table with it: (index of the key, index of the entry), about ``most`` at a time."""
    low, high = np.searchsorted(found, keys, "left"), np.searchsorted(found, keys, "right")
    hit = np.flatnonzero(high > low)
    before = np.concatenate([[0], np.cumsum((high - low)[hit])])
    first = 0
    while first < len(hit):
        end = len(hit) if most is None else max(first + 1, int(np.searchsorted(before, before[first] + most, "right")) - 1)
        own, times = hit[first:end], (high - low)[hit[first:end]]
        yield np.repeat(own, times), np.repeat(low[own], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        first = end


def _possible(items: Items, flat: np.ndarray, item: np.ndarray, start: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Whether, around each start, enough words are the item's; low and high are the bounds of the text."""
    n, k = items.lengths[item], items.edited[item]
    first, end = np.maximum(start - k, low), np.minimum(start + n + k, high)
    known = np.concatenate([[0], np.cumsum(flat > 0)])
    ok = known[end] - known[first] >= n - k
    left = np.flatnonzero(ok)
    while len(left):
        width = int((end - first)[left].max())
        some, left = left[: max(1, WINDOWS * 50 // width)], left[max(1, WINDOWS * 50 // width) :]
        place = first[some][:, None] + np.arange(width)
        words_there = np.where(place < end[some][:, None], flat[np.minimum(place, len(flat) - 1)], 0)
        ok[some] = items.has(item[some], words_there).sum(1) >= (n - k)[some]
    return ok


def candidates(items: Items, flat: np.ndarray, owner: np.ndarray, bounds: np.ndarray) -> set[tuple[int, int, int]]:
    """(document, item, window start within flat) of windows whose samples equal an item's. flat: word numbers of several documents."""
    sizes: dict[int, list[np.ndarray]] = {}
    for size, (table, who, offset) in items.pieces.items():
        # words that no item has are 0, so no piece has one
        n = max(0, len(flat) - size + 1)
        whole = owner[:n] == owner[size - 1 : size - 1 + n]
        for i in range(size):
            whole &= flat[i : i + n] > 0
        places = np.flatnonzero(whole)
        for which, entry in _ranges(table, _keys(flat, size, places), PAIRS):
            item, start, home = who[entry], places[which] - offset[entry], owner[places[which]]
            ok = _possible(items, flat, item, start, bounds[home], bounds[home + 1])
            item, start, home = item[ok], start[ok], home[ok]
            lengths = items.lengths[item]
            for n in np.unique(lengths):
                own, k = lengths == n, allowed(int(n), items.edits)
                near = (start[own][:, None] + np.arange(-k, k + 1)).ravel()
                sizes.setdefault(int(n), []).append(np.unique(np.repeat(home[own], 2 * k + 1) * _HOME + near + k))
    found: set[tuple[int, int, int]] = set()
    padded = np.concatenate([flat, np.zeros(max(sizes, default=0), flat.dtype)])
    for n, parts in sizes.items():
        home, near = np.divmod(np.unique(np.concatenate(parts)), _HOME)
        near = np.clip(near - allowed(n, items.edits), bounds[home], np.maximum(bounds[home + 1] - 1, bounds[home]))
        times, samples, whose = items.signatures[n]
        for at in range(0, len(near), WINDOWS):
            start, doc = near[at : at + WINDOWS], home[at : at + WINDOWS]
            place = start[:, None] + np.arange(n)
            windows = np.where(place < bounds[doc + 1][:, None], padded[place], 0)
            different, inverse = np.unique(windows, axis=0, return_inverse=True)
            made = cgk_samples(different, times)
            by_window: dict[int, set[int]] = {}
            for r in range(times):
                for which, entry in _ranges(samples[r], made[r], PAIRS):
                    for w, i in zip(which.tolist(), whose[r][entry].tolist(), strict=True):
                        by_window.setdefault(w, set()).add(i)
            inverse = inverse.ravel()
            for x in np.flatnonzero(np.isin(inverse, list(by_window))) if by_window else []:
                found.update((int(doc[x]), i, int(start[x])) for i in by_window[int(inverse[x])])
    return found


def matches_in(items: Items, texts: list[str | None]) -> Iterator[tuple[int, int, int, int, int]]:
    """(index of the text, index of the item, distance, first word, end) for every text and item that match."""
    items.prepare()
    cut = [words(x) for x in texts]
    lengths = np.array([len(t) for t in cut], np.int64)
    flat = np.fromiter(map(items.vocabulary.get, chain.from_iterable(cut), repeat(0)), np.int64, int(lengths.sum()))
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    owner = np.repeat(np.arange(len(cut)), lengths)
    near: dict[tuple[int, int], list[int]] = {}
    for doc, item, start in candidates(items, flat, owner, bounds):
        near.setdefault((doc, item), []).append(start)
    for (doc, item), starts in sorted(near.items()):
        x, best = items.arrays[item], None
        n, k = len(x), allowed(len(x), items.edits)
        for a, b in _joined(sorted((max(s - k, bounds[doc]), min(s + n + k, bounds[doc + 1])) for s in starts)):
            distance, start, end = best_passage(x, flat[a:b])
            if distance <= k and (best is None or distance < best[0]):
                best = (distance, int(a - bounds[doc]) + start, int(a - bounds[doc]) + end)
        if best:
            yield doc, item, *best


def _joined(spans: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    first, last = spans[0]
    for a, b in spans[1:]:
        if a <= last:
            last = max(last, b)
        else:
            yield first, last
            first, last = a, b
    yield first, last


_MATCH = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("item_words", pa.int64()), ("distance", pa.int64()), ("first_word", pa.int64()), ("end_word", pa.int64())])
MATCH_DDL = "doc_id bigint, item_id bigint, item_words bigint, distance bigint, first_word bigint, end_word bigint"


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, edits: float, min_words: int, block_chars: int, recall: float = RECALL) -> Iterator[Items]:
    """The benchmark in blocks of about block_chars characters, read one after the other."""
    ids, texts, size = [], [], 0
    for r in benchmark.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).filter("t IS NOT NULL").toLocalIterator():
        cut = words(r["t"])
        if len(cut) < max(1, min_words):
            continue
        ids.append(r["i"])
        texts.append(cut)
        size += len(r["t"])
        if size >= block_chars:
            yield Items(ids, texts, edits, recall)
            ids, texts, size = [], [], 0
    if ids:
        yield Items(ids, texts, edits, recall)


def _one_by_one(spark, blocks: Iterator[Items]) -> Iterator[tuple[Broadcast, bool]]:
    """(block's broadcast, whether it is the only block); the broadcast of a block is released when the next one is asked for, unless it is the only one."""
    block, alone = next(blocks, None), True
    while block is not None:
        shared, following = spark.sparkContext.broadcast(block), next(blocks, None)
        alone = alone and following is None
        yield shared, alone
        if not alone:
            shared.destroy()
        block = following


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", edits: float = EDITS, min_words: int = MIN_WORDS, block_chars: int = BLOCK_CHARS, recall: float = RECALL) -> DataFrame:
    """(doc_id, item_id, item_words, distance, first_word, end_word) of each pair of document and item that match.

    The driver and the workers hold one block of items at a time (two while the next one is read). What the blocks of a
    large benchmark find is written to a table.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    path = None
    for shared, alone in _one_by_one(spark, item_blocks(benchmark, item_id_col, item_text_col, edits, min_words, block_chars, recall)):
        found = rows.mapInArrow(_finder(shared), MATCH_DDL)
        if alone:
            return found
        path = path or fresh_path(spark, "matches")
        found.write.mode("append").parquet(path)
    return spark.read.schema(MATCH_DDL).parquet(path) if path else spark.createDataFrame([], MATCH_DDL)


def _together(texts: Iterator) -> Iterator[tuple[int, list[str | None]]]:
    """(place of the first, texts) in runs of about TOGETHER words."""
    release()
    at, held, size = 0, [], 0
    for x in texts:
        held.append(x.as_py())
        size += len(held[-1] or "") // 6
        if size >= TOGETHER:
            yield at, held
            at, held, size = at + len(held), [], 0
    if held:
        yield at, held


def _finder(shared):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for b in batches:
            ids = b.column(0)
            for at, texts in _together(b.column(1)):
                rows = [(ids[at + d].as_py(), items.ids[i], len(items.arrays[i]), distance, first, end) for d, i, distance, first, end in matches_in(items, texts)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _MATCH.types, strict=True)], schema=_MATCH)

    return find


def _flagger(shared):
    @F.arrow_udf(BooleanType())
    def has(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            flags = np.zeros(len(batch), bool)
            for at, texts in _together(batch):
                for d, *_ in matches_in(shared.value, texts):
                    flags[at + d] = True
            yield pa.array(flags)

    return has


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", edits: float = EDITS, min_words: int = MIN_WORDS, block_chars: int = BLOCK_CHARS, recall: float = RECALL) -> DataFrame:
    """The rows of docs, all columns, without a passage that matches an item; with several blocks of items, what each leaves is written to a table."""
    for shared, alone in _one_by_one(docs.sparkSession, item_blocks(benchmark, item_id_col, item_text_col, edits, min_words, block_chars, recall)):
        docs = docs.filter(~_flagger(shared)(F.col(text_col)))
        if not alone:
            docs = written(docs, "decontaminated")
    return docs
