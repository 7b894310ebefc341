"""SimHash near-duplicates: deletion-variant signatures, equality join, verification, components.

A 64-bit fingerprint is cut into two segments of 32 bits. Of two fingerprints at three or fewer
differing bits, one segment differs in one bit at most. So each fingerprint is indexed, for either
segment, under the segment itself (pairs that agree in it) and under the 32 values that lack one
bit (pairs that differ in that bit only: one side has it set, the other not). An equality join on
these keys meets every such pair; its condition keeps those that truly differ in three bits or fewer.

Only different fingerprints are indexed; equal ones, hot groups of copies included, collapse in an
aggregation with map-side partial results. A segment value held by more than ``heavy`` fingerprints
would make large buckets: these buckets are cut once more by the variants of the other segment's
halves, so no bucket of the first index has more than ``heavy`` fingerprints on a side, and one of
the second has at most 2**17, however many rows there are.

Defined results: null and empty texts have no words and fingerprint zero, linked like any other;
repeated rows have equal fingerprints; a null doc_id never is a component's id unless all its rows
have none; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from inkspar.llm import jaccard
from inkspar.llm.common import free_name, text_key, written
from inkspar.llm.components import components

MAX_BITS = 3
HEAVY = 1024
SHINGLE_WORDS = 3
SEED = 42
#: Hashes whose bits are counted at once.
BLOCK = 1 << 15


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The unsigned SimHash of a whole text; any bit is set if it is set in over half of the shingles' hashes."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    if len(tokens) < words:
        return xxhash.xxh64_intdigest(b" ".join(tokens), SEED)
    n = len(tokens) - words + 1
    count, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words)), strict=False))
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.dtype(">u8"), n)
    for at in range(0, n, BLOCK):
        count += np.unpackbits(hashes[at : at + BLOCK].view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * count > n).tobytes(), "big")


@F.arrow_udf(LongType())
def _fingerprints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        made = np.fromiter((fingerprint(x.as_py()) for x in texts), np.uint64, len(texts))
        yield pa.array(made.view(np.int64))


def fingerprint_column(text: Column) -> Column:
    """The fingerprint as a signed long; equal to the unsigned one bit by bit."""
    return _fingerprints(text)


def _variants(value: Column, bits: int, base: int) -> list[Column]:
    """Structs (code, key, side) of a segment: side null under the whole segment, else the bit that the key lacks."""
    whole = F.struct(F.lit(base).alias("code"), value.alias("key"), F.lit(2).alias("side"))
    lacking = [
        F.struct(F.lit(base + 1 + i).alias("code"), value.bitwiseAND(F.lit(~(1 << i) & ((1 << bits) - 1))).alias("key"), F.shiftright(value, i).bitwiseAND(F.lit(1)).cast("int").alias("side"))
        for i in range(bits)
    ]
    return [whole, *lacking]


def _part(fp: Column, shift: int, bits: int) -> Column:
    return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << bits) - 1))


def _meet(indexed: DataFrame, keys: list[str], sides: list[str], max_bits: int) -> DataFrame:
    """Verified pairs (u, v) of rows that agree in all keys and, where a key lacks a bit, differ in it. Both sides are the same rows, so they are shuffled once.

    They are merged whatever their size is taken for: Spark's estimate leaves out that each fingerprint becomes many rows
    of an index, so a side could be broadcast that has a hundred times the bytes.
    """
    a, b = indexed.hint("merge").alias("a"), indexed.hint("merge").alias("b")
    met = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits
    for k in keys:
        met = met & (F.col(f"a.{k}") == F.col(f"b.{k}"))
    for s in sides:
        met = met & ((F.col(f"a.{s}") == 2) | (F.col(f"a.{s}") != F.col(f"b.{s}")))
    return a.join(b, met & (F.col("a.fp") < F.col("b.fp"))).select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v"))


def links(fps: DataFrame, max_bits: int = MAX_BITS, heavy: int = HEAVY) -> DataFrame:
    """All pairs (u < v) of the different fingerprints in column fp that differ in max_bits (at most 3) bits or fewer."""
    if not 0 <= max_bits <= 3:
        raise ValueError("two segments of which one differs by a bit at most hold for three bits or fewer")
    value = {0: _part(F.col("fp"), 0, 32), 1: _part(F.col("fp"), 32, 32)}
    crowded = written(
        fps.select(F.explode(F.array(*[F.struct(F.lit(s).alias("segment"), v.alias("value")) for s, v in value.items()])).alias("x"))
        .groupBy("x.segment", "x.value").count().filter(F.col("count") > heavy).select("segment", "value"),
        "crowded",
    )
    indexed = fps.select("fp", F.explode(F.array(*[x for s, v in value.items() for x in _variants(v, 32, 33 * s)])).alias("x")).select("fp", "x.code", "x.key", "x.side")
    if crowded.isEmpty():
        return _meet(indexed, ["code", "key"], ["side"], max_bits).distinct()
    light = indexed.withColumn("segment", (F.col("code") / 33).cast("int"))
    light = light.withColumn("value", F.when(F.col("segment") == 0, value[0]).otherwise(value[1]))
    light = light.join(crowded, ["segment", "value"], "left_anti").select("fp", "code", "key", "side")
    hot_keys = crowded.select("segment", F.explode(F.array(*[F.struct(x["code"].alias("code"), x["key"].alias("key")) for x in _variants(F.col("value"), 32, 0)])).alias("x"))
    # written, so that the join knows how many they are: 33 for each crowded value
    hot_keys = written(hot_keys.select((F.col("x.code") + 33 * F.col("segment")).alias("code"), F.col("x.key").alias("key")).distinct(), "hot-keys")
    hot = indexed.join(hot_keys, ["code", "key"], "left_semi")
    rest = F.when(F.col("code") < 33, value[1]).otherwise(value[0])
    low, high = rest.bitwiseAND(F.lit(0xFFFF)), F.shiftright(rest, 16)
    finer = hot.select("fp", "code", "key", "side", F.explode(F.array(*_variants(low, 16, 0), *_variants(high, 16, 17))).alias("x"))
    finer = finer.select("fp", "code", "key", "side", F.col("x.code").alias("code2"), F.col("x.key").alias("key2"), F.col("x.side").alias("side2"))
    return _meet(light, ["code", "key"], ["side"], max_bits).unionByName(_meet(finer, ["code", "key", "code2", "key2"], ["side", "side2"], max_bits)).distinct()


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS, heavy: int = HEAVY) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): each row's id, fingerprint fp and text_key; each different fp's component_id and component root.

    component_id is the smallest id among all rows that links reach from fp.
    """
    text = F.col(text_col)
    rows = written(docs.select(F.col(id_col).alias("doc_id"), fingerprint_column(text).alias("fp"), text_key(text).alias("text_key")), "fingerprints")
    firsts = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "different-fingerprints")
    return rows, joined(firsts, components(links(firsts.select("fp"), max_bits, heavy)))


#: Components that have more than this part of all linked nodes are looked up apart from the others; there are fewer than that many.
LARGE = 4096


def joined(firsts: DataFrame, linked: DataFrame) -> DataFrame:
    """(fp, component_id, root) of all fp in firsts (fp, first_id), of which linked (node, root) has those with links.

    Members of the largest components, fewer than LARGE of these, meet their root's row where they are, by a broadcast of these rows; so no task gets all members of one component.
    """
    nodes = linked.withColumnRenamed("node", "fp")
    roots = written(nodes.join(firsts, "fp").groupBy("root").agg(F.min("first_id").alias("component_id"), F.count("*").alias("n")), "roots")
    total = roots.agg(F.sum("n")).first()[0] or 0
    large = F.col("n") * LARGE > total
    most = roots.filter(large).select("root", "component_id")
    often = nodes.join(F.broadcast(most), "root")
    seldom = nodes.join(F.broadcast(most.select("root")), "root", "left_anti").join(roots.filter(~large).select("root", "component_id"), "root")
    members = written(often.select("fp", "component_id", "root").unionByName(seldom.select("fp", "component_id", "root")), "members")
    alone = firsts.join(members, "fp", "left_anti").select("fp", F.col("first_id").alias("component_id"), F.col("fp").alias("root"))
    return members.unionByName(alone)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id) for every row."""
    rows, found = classes(docs, id_col, text_col, max_bits)
    return rows.drop("text_key").join(found.select("fp", "component_id"), "fp")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS, words: int = jaccard.SHINGLE_WORDS, similarity: float = jaccard.SIMILARITY) -> DataFrame:
    """The rows of docs, all columns, of which each group of near copies keeps one: that with the smallest id.

    Near copies are texts whose sets of ``words``-word shingles have the Jaccard similarity, and what such links join.
    Candidates are the fingerprints of these shingles that the deletion variants link, and, as few pairs of a similarity
    of 0.8 are within three bits, those that share a key of jaccard; all are verified on the whole sets.

    Of several rows with the smallest id one stays; a group without any id keeps one row. Texts are signed once: the
    rows to keep are found again by id and text hashes. Null, empty and blank texts are one group; columns of any name
    stay as they are; an empty table stays empty.
    """
    text = F.col(text_col)
    signed = docs.select(F.col(id_col).alias("doc_id"), text_key(text).alias("text_key"), jaccard.signed_column(text, words).alias("s"))
    rows = written(signed.select("doc_id", "text_key", "s.fp", "s.bits", "s.bands"), "signed")
    firsts = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.min("text_key").alias("text_key"), F.min("bits").alias("bits"), F.first("bands").alias("bands")), "different-sets")
    keys = firsts.select("fp", F.explode("bands").alias("key"))
    members = written(keys.join(keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").hint("merge"), "key"), "members")
    near = written(_near_sets(firsts.select("fp", "bits"), max_bits), "near-sets")
    nodes = members.select("fp").unionByName(near.select(F.col("u").alias("fp"))).unionByName(near.select(F.col("v").alias("fp"))).distinct()
    wanted = firsts.join(nodes, "fp", "left_semi").select(F.col("text_key").alias("k"))
    texts = docs.select(text.alias("text"), text_key(text).alias("k")).join(wanted, "k", "left_semi").groupBy("k").agg(F.first("text").alias("text"))
    sets = written(texts.select(jaccard.named_column(F.col("text"), words).alias("s")).select("s.fp", "s.shingles"), "sets")
    found = joined(firsts.select("fp", "first_id"), jaccard.linked(members, sets, near, similarity))
    return kept(docs, rows.select("doc_id", "text_key", "fp"), found, id_col, text_col)


def _near_sets(sets: DataFrame, max_bits: int) -> DataFrame:
    """Pairs (u, v) of sets fp whose fingerprints, bits, are linked; of sets with one fingerprint the least stands for all, and is paired with each."""
    heads = sets.groupBy("bits").agg(F.min("fp").alias("head"))
    same = sets.join(heads, "bits").filter("fp != head").select(F.col("head").alias("u"), F.col("fp").alias("v"))
    near = links(heads.select(F.col("bits").alias("fp")), max_bits)
    one, two = heads.select(F.col("bits").alias("u"), F.col("head").alias("a")), heads.select(F.col("bits").alias("v"), F.col("head").alias("b"))
    between = near.join(one, "u").join(two, "v").select(F.col("a").alias("u"), F.col("b").alias("v"))
    return same.unionByName(between).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))


def kept(docs: DataFrame, rows: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of docs to keep by rows (doc_id, fp, text_key) and the components found (fp, component_id, root)."""
    held = rows.join(found, "fp").filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = held.groupBy("root").agg(F.min(F.struct("text_key", "doc_id")).alias("k"), F.count("*").alias("n"))
    own_id, key, times = (free_name(docs, n) for n in ("kept_id", "kept_key", "kept_times"))
    chosen = written(first.select(F.col("k.doc_id").alias(own_id), F.col("k.text_key").alias(key), F.col("n").alias(times)), "kept")
    same = docs[id_col].eqNullSafe(chosen[own_id]) & (text_key(docs[text_col]) == chosen[key])
    single = docs.join(chosen.filter(F.col(times) == 1), same, "left_semi")
    again = docs.join(chosen.filter(F.col(times) > 1), same, "left_semi").withColumn(key, text_key(F.col(text_col))).dropDuplicates([key]).drop(key)
    return single.unionByName(again)
