"""Chat formatting: cumulative-snapshot collapse, then rendering.

Logs often hold one conversation many times, each time with more turns. A turn's hash covers its
number, role and text; the hash of a prefix is the exclusive-or of its turns' hashes, twice over with
different salts (128 bits), so a window yields the hash of every prefix in one pass. A conversation is
dropped if its whole hash is the prefix hash of a longer one (anti-join), and of equal conversations
the one with the smallest id stays. What remains is maximal; it is rendered.

Only hashes are shuffled until the maximal conversations are known. Equal prefixes and equal
conversations collapse in aggregations with map-side partial results before the joins, so neither
side of a join repeats a key.

Defined results: null roles render as "unknown" and null texts as empty, and null differs from empty
in the hash; turns of one conversation are in order of turn (null first) and role, and those equal in
both are in order of their hash in prefixes and of their text when rendered; exactly repeated rows
count once; rows with a null conv_id form one conversation; an empty table gives none.
Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkspar.llm.common import written

#: The rendering of a turn.
OPEN, AFTER_ROLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def _turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and the turn's hash without its number, once for each different row."""
    content = F.struct("turn", F.coalesce("role", F.lit("")).alias("r"), F.xxhash64("role", F.isnull("role"), "text", F.isnull("text"), F.lit("a")).alias("a"), F.xxhash64("text", F.isnull("text"), "role", F.isnull("role"), F.lit("b")).alias("b"))
    return conversations.select("conv_id", content.alias("t")).distinct().select("conv_id", "t")


def prefixes(conversations: DataFrame) -> DataFrame:
    """(conv_id, n, a, b, goes_on): the hash (a, b) of the first n turns, for every n, and whether turns follow."""
    order = Window.partitionBy("conv_id").orderBy("t")
    numbered = _turns(conversations).select("conv_id", F.row_number().over(order).alias("n"), F.lead(F.lit(True), 1, False).over(order).alias("goes_on"), "t")
    tagged = numbered.select("conv_id", "n", "goes_on", F.xxhash64("n", "t.a", "t.b", F.lit(1)).alias("x"), F.xxhash64("n", "t.b", "t.a", F.lit(2)).alias("y"))
    running = Window.partitionBy("conv_id").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    return tagged.select("conv_id", "n", F.bit_xor("x").over(running).alias("a"), F.bit_xor("y").over(running).alias("b"), "goes_on")


def maximal(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies): conversations that neither are a prefix of a longer one nor repeat one with a smaller id."""
    found = written(prefixes(conversations), "prefixes")
    different = found.filter("NOT goes_on").groupBy("n", "a", "b").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    proper = found.filter("goes_on").select("n", "a", "b").distinct()
    return different.join(proper, ["n", "a", "b"], "left_anti").select("conv_id", F.col("n").cast("bigint").alias("n_turns"), "n_copies")


def _plain(text: Column) -> Column:
    """Text that can't be taken for the rendering's own marks."""
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def render(conversations: DataFrame, kept: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies, text) of the kept conversations."""
    own = kept.select(F.col("conv_id").alias("__conv"), "n_turns", "n_copies")
    rows = conversations.select("conv_id", "turn", "role", "text").join(own, F.col("conv_id").eqNullSafe(F.col("__conv"))).select("conv_id", "n_turns", "n_copies", F.struct("turn", "role", "text").alias("t"))
    turns = rows.groupBy("conv_id", "n_turns", "n_copies").agg(F.array_sort(F.collect_set("t")).alias("turns"))
    one = lambda t: F.concat(F.lit(OPEN), _plain(F.coalesce(t["role"], F.lit("unknown"))), F.lit(AFTER_ROLE), _plain(F.coalesce(t["text"], F.lit(""))), F.lit(CLOSE))
    return turns.select("conv_id", "n_turns", "n_copies", F.concat_ws("", F.transform("turns", one)).alias("text"))


def collapse(conversations: DataFrame) -> DataFrame:
    """The rendered maximal conversations."""
    return render(conversations, maximal(conversations))
