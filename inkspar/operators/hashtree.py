"""Two tables of records compared through prefix trees of hashes: which rows differ, without sorting or collecting either.

A row belongs to the leaf that its key's hash begins with. A node's digest is the number of rows below it and the sums of two 60-bit halves of their hashes,
so the order of rows doesn't count but repeated rows do, and a node's digest is the sum of its children's. A tree has at most 16^DEPTH leaves
whatever the table's size; it can be kept, and compared later with that of another table. The descent follows differing nodes
only, level by level, and rows are read and joined below differing leaves alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Hexadecimal digits of a leaf's prefix: 65,536 leaves.
DEPTH = 4
TREE = "level int, prefix string, n long, one decimal(38,0), two decimal(38,0)"


def _value(column: str):
    value = F.col(column).cast("string")
    return F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def hashed(df: DataFrame, key: list[str]) -> DataFrame:
    """The columns of the key, its hash, and two 60-bit numbers of the row's hash. Columns need to be of simple types; nulls differ from all texts."""
    row = F.sha2(F.concat(*[_value(c) for c in sorted(df.columns)]), 256)
    number = lambda start: F.conv(F.substring(row, start, 15), 16, 10).cast("decimal(38,0)")
    return df.select(*key, F.sha2(F.concat(*[_value(c) for c in key]), 256).alias("__at"), number(1).alias("__one"), number(16).alias("__two"))


def tree(df: DataFrame, key: list[str], depth: int = DEPTH) -> DataFrame:
    """TREE of a table: one pass and one small shuffle, as leaves are added up where the rows are."""
    leaves = hashed(df, key).groupBy(F.substring("__at", 1, depth).alias("leaf")).agg(F.count("*").alias("n"), F.sum("__one").alias("one"), F.sum("__two").alias("two"))
    up = leaves.select(F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("level"), "leaf", "n", "one", "two").withColumn("prefix", F.expr("left(leaf, level)"))
    total = up.groupBy("level", "prefix").agg(F.sum("n").alias("n"), F.sum("one").alias("one"), F.sum("two").alias("two"))
    return total.select("level", "prefix", "n", F.col("one").cast("decimal(38,0)").alias("one"), F.col("two").cast("decimal(38,0)").alias("two"))


def differing(a: DataFrame, b: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(level, prefix) of the differing nodes of two trees, reached from differing parents."""
    digest = lambda t, name: t.select("level", "prefix", F.struct("n", "one", "two").alias(name))
    nodes = digest(a, "a").join(digest(b, "b"), ["level", "prefix"], "full").filter(~F.col("a").eqNullSafe(F.col("b"))).select("level", "prefix")
    found = level = nodes.filter("level = 0")
    for i in range(1, depth + 1):
        below = nodes.filter(F.col("level") == i).withColumn("above", F.expr("left(prefix, level - 1)"))
        level = below.join(level.select(F.col("prefix").alias("above")), "above", "left_semi").select("level", "prefix")
        found = found.unionByName(level)
    return found


def named(a: DataFrame, b: DataFrame, leaves: DataFrame, key: list[str], depth: int = DEPTH) -> DataFrame:
    """The key and outcome (missing: not in b, unexpected: not in a, changed) of the rows below differing leaves; equal ones are left out.

    Rows of both tables are added up by their key in one aggregation, a's with one sign and b's with the other, so no row meets another in a join and what is shuffled of a row is its key
    and seven numbers. Hashes are added in pieces of 30 bits, which keep far from a long's bounds. The leaves, at most 16^depth, are broadcast.
    """
    below = F.broadcast(leaves.filter(F.col("level") == depth).select("prefix"))
    rows = []
    for df, sign in ((a, 1), (b, -1)):
        kept = hashed(df, key).withColumn("prefix", F.substring("__at", 1, depth)).join(below, "prefix", "left_semi")
        pieces = [piece for half in (F.col("__one").cast("long"), F.col("__two").cast("long")) for piece in (F.shiftright(half, 30), half.bitwiseAND((1 << 30) - 1))]
        rows.append(kept.select(*key, F.lit(sign).alias("__sign"), *[piece.alias(f"__piece{i}") for i, piece in enumerate(pieces)]))
    both = rows[0].unionByName(rows[1])
    counted = both.groupBy(*key).agg(F.count_if(F.col("__sign") > 0).alias("__a"), F.count_if(F.col("__sign") < 0).alias("__b"), *[F.sum(F.col("__sign") * F.col(f"__piece{i}")).alias(f"__piece{i}") for i in range(4)])
    differs = reduce(lambda x, y: x | y, [F.col(f"__piece{i}") != 0 for i in range(4)], F.col("__a") != F.col("__b"))
    outcome = F.when(F.col("__b") == 0, "missing").when(F.col("__a") == 0, "unexpected").when(differs, "changed")
    return counted.select(*key, outcome.alias("outcome")).filter("outcome IS NOT NULL")


def compared(a: DataFrame, b: DataFrame, key: list[str], depth: int = DEPTH) -> DataFrame:
    """named() below the differing leaves of both tables' trees."""
    return named(a, b, differing(tree(a, key, depth), tree(b, key, depth), depth), key, depth)
