"""Sets of word shingles and the search for pairs of them of a Jaccard similarity, 0.8 or more by default.

A text's words are as in op3: ASCII-lower-cased, between white space. The 64-bit hashes of its shingles are mixed from
its words' hashes; equal sets are one node. Candidates come in two steps, and every link is verified on the whole sets:

1. Each node has BANDS keys of ROWS minimums. At a similarity of 0.8 two nodes have no key in common once in twenty
   million times, above that less often. The nodes of a key are compared with one of them, the one that meets most
   others in all its keys, which connects groups of near copies without their pairs.
2. Nodes of a key that are still in different components are searched exactly. Of a node's shingles, those come first
   that no other component has, then the others from the rarest on; a pair of the similarity t shares one of the
   n - ceil(t n) + 1 first, and what comes behind it must leave enough in common. So a node whose own share is too
   large for any partner is put aside at once, and no pair that could be linked is left out, however many meet.

Defined results: null, empty and blank texts have the empty set, a text of fewer words than a shingle
the one shingle of them all; case and runs of space don't count; nodes without any key in common have no links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from inkspar.llm.common import release, written
from inkspar.llm.components import components

SHINGLE_WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 32, 4
SEED = 42
#: Shingles whose minimums are taken at once, and words of the texts that are hashed together.
BLOCK, TOGETHER = 512, 300_000

_DRAWN = np.random.default_rng(SEED)
_TIMES, _PLUS = (_DRAWN.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1) for _ in range(2))
_BAND = _DRAWN.integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
    return x ^ (x >> np.uint64(31))


def shingle_lists(texts: list[str | None], words: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """The hashes of each text's shingles, repeats included, in order of place."""
    cut = [(x or "").encode("utf-8", "surrogatepass").lower().split() for x in texts]
    sizes = np.array([len(c) for c in cut], np.int64)
    own = np.fromiter(map(xxhash.xxh64_intdigest, chain.from_iterable(cut), repeat(SEED)), np.uint64, int(sizes.sum()))
    made = np.zeros(max(0, len(own) - words + 1), np.uint64)
    for i in range(words if len(made) else 0):
        made = _mixed(made * _ODD + own[i : i + len(made)])
    ends = np.cumsum(sizes)
    out = []
    for first, end in zip((ends - sizes).tolist(), ends.tolist(), strict=True):
        if end - first >= words:
            out.append(made[first : end - words + 1])
        else:
            short = np.zeros(min(1, end - first), np.uint64)
            for w in own[first:end]:
                short = _mixed(short * _ODD + w)
            out.append(short)
    return out


def name_of(own: np.ndarray) -> int:
    """A set's 64-bit name."""
    return xxhash.xxh64_intdigest(own.tobytes(), SEED)


def band_keys(own: np.ndarray) -> np.ndarray:
    least, x = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32), (own >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(x), BLOCK):
        drawn = x[None, at : at + BLOCK] * _TIMES[:, None]
        drawn += _PLUS[:, None]
        drawn ^= drawn >> np.uint32(15)
        np.minimum(least, drawn.min(axis=1), out=least)
    return _mixed(((least.reshape(BANDS, ROWS) + np.uint64(1)) * _BAND).sum(axis=1, dtype=np.uint64))


def fingerprint_of(hashes: np.ndarray) -> int:
    """The SimHash of shingle hashes: a bit is set if it is in over half of them."""
    count = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at : at + (1 << 15)].astype(">u8")
        count += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * count > len(hashes)).tobytes(), "big")


def _together(texts: pa.Array) -> Iterator[list[str | None]]:
    release()
    held, size = [], 0
    for x in texts:
        held.append(x.as_py())
        size += len(held[-1] or "") // 6
        if size >= TOGETHER:
            yield held
            held, size = [], 0
    if held:
        yield held


def _longs(found: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0] + [len(x) for x in found])
    flat = np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def _signed_longs(found: list[int]) -> pa.Array:
    return pa.array(np.array(found, np.uint64).view(np.int64))


def signed_column(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """Struct (fp, bits, bands): the set's name, the SimHash of its shingles and its keys."""

    @F.arrow_udf(StructType([StructField("fp", LongType()), StructField("bits", LongType()), StructField("bands", ArrayType(LongType()))]))
    def signed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for texts in _together(batch):
                lists = shingle_lists(texts, words)
                sets = [np.unique(x) for x in lists]
                yield pa.StructArray.from_arrays([_signed_longs([name_of(x) for x in sets]), _signed_longs([fingerprint_of(x) for x in lists]), _longs([band_keys(x) for x in sets])], names=["fp", "bits", "bands"])

    return signed(text)


def named_column(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """Struct (fp, shingles): the set's name and members."""

    @F.arrow_udf(StructType([StructField("fp", LongType()), StructField("shingles", ArrayType(LongType()))]))
    def named(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for texts in _together(batch):
                sets = [np.unique(x) for x in shingle_lists(texts, words)]
                yield pa.StructArray.from_arrays([_signed_longs([name_of(x) for x in sets]), _longs(sets)], names=["fp", "shingles"])

    return named(text)


def verified(pairs: DataFrame, sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs (u, v) of the similarity or more."""
    one, two = sets.select(F.col("fp").alias("u"), F.col("shingles").alias("a")), sets.select(F.col("fp").alias("v"), F.col("shingles").alias("b"))
    sizes = pairs.join(one, "u").join(two, "v").select("u", "v", F.size("a").alias("a"), F.size("b").alias("b"), F.size(F.array_intersect("a", "b")).alias("both"))
    return sizes.filter(F.col("both") >= F.lit(similarity) * (F.col("a") + F.col("b") - F.col("both")) - 1e-9).select("u", "v")


def pivot_pairs(members: DataFrame) -> DataFrame:
    """Pairs (u < v) of each key's nodes with that one which meets most others in all its keys; members has (key, fp, n), n the key's nodes."""
    meets = members.groupBy("fp").agg(F.sum(F.col("n") - 1).alias("meets"))
    pivots = members.join(meets, "fp").groupBy("key").agg(F.max(F.struct("meets", "fp")).alias("p")).select("key", F.col("p.fp").alias("v"))
    pairs = members.join(pivots, "key").filter("fp != v")
    return pairs.select(F.least("fp", "v").alias("u"), F.greatest("fp", "v").alias("v"))


def exact_pairs(left: DataFrame, sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Every pair (u, v) of nodes of different roots that can have the similarity; left has (fp, root)."""
    t = F.lit(similarity)
    each = sets.join(left, "fp").select("fp", "root", F.size("shingles").alias("n"), F.explode("shingles").alias("s"))
    common = each.groupBy("s").agg(F.count("*").alias("f"), F.min("root").alias("a"), F.max("root").alias("b")).filter("a != b").select("s", "f")
    shared = each.join(common, "s").groupBy("fp", "root", "n").agg(F.count("*").alias("shared"), F.sort_array(F.collect_list(F.struct("f", "s"))).alias("by"))
    own, first = F.col("n") - F.col("shared"), F.col("n") - F.ceil(F.col("n") * t - 1e-9) + 1
    able = shared.filter(own < first).select("fp", "root", "n", own.alias("own"), F.slice("by", F.lit(1), (first - own).cast("int")).alias("by"))
    prefix = able.select("fp", "root", "n", "own", F.posexplode("by").alias("at", "x")).select("fp", "root", "n", (F.col("own") + F.col("at")).alias("at"), F.col("x.s").alias("s"))
    a, b = prefix.alias("a"), prefix.alias("b")
    behind = 1 + F.least(F.col("a.n") - F.col("a.at"), F.col("b.n") - F.col("b.at")) - 1
    enough = behind * (1 + t) >= t * (F.col("a.n") + F.col("b.n")) - 1e-6
    met = a.join(b, (F.col("a.s") == F.col("b.s")) & (F.col("a.root") < F.col("b.root")) & enough)
    return met.select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v")).distinct()


def linked(members: DataFrame, sets: DataFrame, also: DataFrame | None = None, similarity: float = SIMILARITY) -> DataFrame:
    """(node, root) of all nodes with links: the components of all pairs of the similarity among nodes that share a key.

    members has (key, fp, n), sets (fp, shingles); also has further candidates (u, v) that are verified with the first ones.
    """
    first = pivot_pairs(members)
    first = first if also is None else first.unionByName(also)
    links = written(verified(written(first.distinct(), "candidates"), sets, similarity), "links")
    roots = written(components(links), "roots")
    current = members.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("key", "fp", F.coalesce("root", "fp").alias("root"))
    several = current.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a != b").select("key")
    left = written(current.join(several, "key", "left_semi").select("fp", "root").distinct(), "left")
    further = written(verified(written(exact_pairs(left, sets, similarity), "further-candidates"), sets, similarity), "further-links")
    if further.isEmpty():
        return roots
    of = left.withColumnRenamed("fp", "x")
    between = further.join(of.select(F.col("x").alias("u"), F.col("root").alias("a")), "u").join(of.select(F.col("x").alias("v"), F.col("root").alias("b")), "v")
    joined = written(components(between.select(F.col("a").alias("u"), F.col("b").alias("v"))), "joined-roots").select(F.col("node").alias("root"), F.col("root").alias("top"))
    # a joined root without links before is a node of its own
    alone = joined.join(roots.select("root").distinct(), "root", "left_anti").select(F.col("root").alias("node"), F.col("top").alias("root"))
    return roots.join(joined, "root", "left").select("node", F.coalesce("top", "root").alias("root")).unionByName(alone)
