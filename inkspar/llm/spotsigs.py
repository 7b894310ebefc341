"""SpotSigs document fingerprints: chains of content words behind common-word anchors.

A text's words are its lower-cased runs of letters, digits and marks. A run of adjacent anchors (common
words of the languages at hand) and the two content words behind it, anchors between these skipped, form
a signature; the set of a text's signatures, as 64-bit hashes, is its fingerprint. Where a content word
and those before it, ``STRETCH`` in all, have no anchor (lists, tables, other languages), it and the next form a
signature too. A text of fewer than two content words has one of all its words, so any fingerprint has a
member and texts with equal words have equal ones.

Likeness is the Jaccard similarity of two sets. It is at most the smaller over the larger length. So
for a threshold t sets are partitioned by length, in bands that grow by 1 / t: only sets of the same or
the next band are compared, and of those only pairs that share one of the few rarest signatures of each
(a set of n with a partner must share one of its n - ceil(t n) + 1 rarest).

Defined results: null texts are as empty ones, whose set holds the hash of no words; equal texts have
equal fingerprints and likeness 1; the next document follows in descending doc_id, null ids last, equal
ids in order of the texts' hashes, and the first follows the last, itself if alone; an empty table
gives no rows. Only DataFrame functions are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkspar.llm.common import free_name, range_bounds, range_bucket, shuffle_partitions, written

#: Common words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be but by for from had has have he her his if in is it its not of on or she so than that the their there they this to was we were which who will with you "
    "als am auch auf aus bei das dass dem den der des die durch ein eine einem einen einer er es für hat ich im ist mit nach nicht noch sich sie sind über um und von war wie wird zu zum zur "
    "au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur lui mais ne nous ou par pas plus pour qu que qui sa se ses son sont sur un une vous "
    "al como con cuando del el ella ellos entre era esta este fue ha hay la las lo los más me muy no nos o para pero por porque si sin sobre su sus también una uno y ya"
)
THRESHOLD = 0.8
STRETCH = 4


def _alternatives(anchors: str) -> str:
    """A pattern for any anchor, grouped by first letter so that few are tried."""
    by: dict[str, list[str]] = {}
    for w in sorted(set(anchors.split()), key=lambda w: (w[0], -len(w), w)):
        by.setdefault(w[0], []).append(w[1:])
    return "|".join(f"{first}(?:{'|'.join(rest)})" for first, rest in sorted(by.items()))


def _words(text: Column) -> Column:
    """The lower-cased runs of letters, digits and marks, with single spaces between them."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\p{M}]+", " "))


def with_signatures(df: DataFrame, text_col: str, into: str, anchors: str = ANCHORS) -> DataFrame:
    """df with the sorted set of signatures in column into; the text must not be null, and all other columns stay, of whatever name. Each step is evaluated once for each row."""
    clean, all_runs, with_anchors, found = (free_name(df, n) for n in ("__clean", "__runs", "__anchored", "__found"))
    step = df.withColumn(clean, _words(F.col(text_col)))
    # each run: the anchors before a content word, if any, and that word
    step = step.withColumn(all_runs, F.regexp_extract_all(clean, F.lit(f"(?:(?:{_alternatives(anchors)}) )*+[^ ]+"), F.lit(0)))
    step = step.withColumn(with_anchors, F.transform(all_runs, lambda run: F.contains(run, F.lit(" "))))
    runs, anchored = F.col(all_runs), F.col(with_anchors)

    def chain(run: Column, i: Column) -> Column:
        bare = ~F.coalesce(F.get(anchored, i - 1), F.lit(False))
        for back in range(2, STRETCH):
            bare = bare & ~F.coalesce(F.get(anchored, i - back), F.lit(False))
        behind = F.get(runs, i + 1)
        return F.when(behind.isNotNull() & (F.get(anchored, i) | bare), F.xxhash64(run, F.substring_index(behind, " ", -1)))

    step = step.withColumn(found, F.array_sort(F.array_distinct(F.array_compact(F.transform(runs, chain)))))
    return step.withColumn(into, F.when(F.size(found) == 0, F.array(F.xxhash64(clean))).otherwise(F.col(found))).drop(found, clean, all_runs, with_anchors)


def digest(members: Column) -> Column:
    """The fingerprint as text: the set's length and 128 bits of hashes of its members, in hex."""
    return F.concat(F.hex(F.size(members)), F.lit("-"), F.lpad(F.hex(F.xxhash64(members)), 16, "0"), F.lpad(F.hex(F.xxhash64(F.lit(1), members)), 16, "0"))


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """The Jaccard similarity of two sets; 0 without a comparison where their lengths show that it is under least."""
    shared = F.size(F.array_intersect(a, b))
    value = shared / (F.size(a) + F.size(b) - shared)
    if least <= 0:
        return value
    return F.when(F.least(F.size(a), F.size(b)) < least * F.greatest(F.size(a), F.size(b)), F.lit(0.0)).otherwise(value)


def with_next(docs: DataFrame, id_col: str, cols: list[str]) -> DataFrame:
    """docs with next_<c> of each column c: that of the next row in descending id; after the last comes the first. All other columns stay, of whatever name.

    Rows are dealt by ranges of ids, several for each shuffle partition, and ordered in each. The first row
    of a range also goes, as a marked copy, behind the last of the range before it. What the driver gets
    is one id for each range.
    """
    bounds = range_bounds(docs, id_col, 4 * shuffle_partitions(docs.sparkSession))
    near, first, target, place, at, copy, tie = (free_name(docs, n) for n in ("__range", "__head", "__target", "__place", "__at", "__copy", "__tie"))
    dealt = docs.withColumn(near, range_bucket(F.col(id_col), bounds))
    heads = [(r[near], r["head"]) for r in dealt.groupBy(near).agg(F.max(id_col).alias("head")).orderBy(F.desc(near)).collect()]
    targets = [(head, heads[i - 1][0]) for i, (_, head) in enumerate(heads)]
    listed = F.array(*[F.struct(F.lit(head).cast("bigint").alias(first), F.lit(to).cast("int").alias(target)) for head, to in targets])
    copies = docs.sparkSession.range(1).select(F.inline(listed.cast(f"array<struct<`{first}`: bigint, `{target}`: int>>")))
    own = F.struct(F.col(near).alias("at"), F.lit(0).alias("copy"))
    also = F.struct(F.col(target).alias("at"), F.lit(1).alias("copy"))
    places = F.when(F.col(target).isNull(), F.array(own)).otherwise(F.array(own, also))
    placed = dealt.join(F.broadcast(copies), F.col(id_col).eqNullSafe(F.col(first)), "left").withColumn(place, F.explode(places))
    # plain columns for the window, so that all columns are looked up in one window behind one exchange
    placed = placed.select(*docs.columns, F.col(place)["at"].alias(at), F.col(place)["copy"].alias(copy), F.xxhash64(*cols).alias(tie))
    order = Window.partitionBy(at).orderBy(copy, F.desc_nulls_last(id_col), tie)
    found = placed.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in cols])
    return found.filter(F.col(copy) == 0).drop(at, copy, tie)


def edited(text: Column, following: Column) -> Column:
    """The text whose last third (rounded down, in code points) is replaced by as many of the following text's first, or all of them."""
    third = F.floor(F.char_length(text) / 3).cast("int")
    return F.concat(F.substr(text, F.lit(1), F.char_length(text) - third), F.substr(following, F.lit(1), third))


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, edited, signatures, edited_signatures, next_signatures) of every row."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = with_next(with_signatures(rows, "text", "signatures"), "doc_id", ["text", "signatures"])
    found = found.withColumn("edited", edited(F.col("text"), F.col("next_text"))).drop("next_text")
    return with_signatures(found, "edited", "edited_signatures")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(members, links): (doc_id, digest) of every row; (a, b, likeness) of the digests of different sets at threshold or more."""
    rows = with_signatures(docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")), "text", "signatures").select("doc_id", digest(F.col("signatures")).alias("digest"), "signatures")
    members = written(rows, "spot-signatures")
    sets = written(members.select("digest", "signatures").dropDuplicates(["digest"]), "spot-sets")
    band = F.floor(F.log(F.size("signatures").cast("double")) / math.log(1 / threshold) + 1e-9).cast("int")
    banded = sets.select("digest", band.alias("band"), F.explode("signatures").alias("s"))
    counts = banded.groupBy("s").agg(F.count("*").alias("n"))
    ranked = banded.join(counts, "s").groupBy("digest", "band").agg(F.array_sort(F.collect_list(F.struct("n", "s"))).alias("by"))
    prefix = ranked.withColumn("s", F.explode(F.slice("by", F.lit(1), F.size("by") - F.ceil(F.size("by") * F.lit(threshold) - 1e-9).cast("int") + 1))).select("digest", "band", F.col("s.s").alias("s"))
    left = prefix.select(F.col("digest").alias("a"), F.explode(F.array("band", F.col("band") + 1)).alias("band"), "s")
    right = prefix.select(F.col("digest").alias("b"), "band", "s")
    pairs = left.join(right, ["band", "s"]).filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    one, two = sets.select(F.col("digest").alias("a"), F.col("signatures").alias("x")), sets.select(F.col("digest").alias("b"), F.col("signatures").alias("y"))
    links = pairs.join(one, "a").join(two, "b").select("a", "b", likeness(F.col("x"), F.col("y"), threshold).alias("likeness")).filter(F.col("likeness") >= threshold)
    return members.select("doc_id", "digest"), links
