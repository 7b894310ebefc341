"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkspar.llm.common import written


def _stars(pairs: DataFrame, larger: bool) -> DataFrame:
    """One star round over pairs (u, v): the neighbours of u, and in a small star u itself, move to the least of u and them."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = pairs.join(least, "u")
    if larger:
        moved = moved.filter(F.col("v") > F.col("u")).select("v", "m")
    else:
        moved = moved.filter(F.col("v") != F.col("m")).select("v", "m").unionByName(least.filter("u != m").select(F.col("u").alias("v"), "m"))
    return moved.filter("v != m").distinct().select(F.col("v").alias("u"), F.col("m").alias("v"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v); root is the least node that can be reached.

    Each round is written to the shared folder. No node's neighbours are collected: a star moves by a
    partial minimum and a join, whose hot side adaptive execution splits. Rounds end when the edges
    stay the same; their number grows with the logarithm of the longest chain, squared at worst. Edges with a null
    end and loops are no edges; repeated ones count once; an empty table gives no rows.
    """
    edges = written(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = written(_stars(both, True), "large-star")
        edges = written(_stars(large, False), "small-star")
        before, state = state, _state(edges)
        if before == state:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
