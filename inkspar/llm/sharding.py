"""Sharding by a hierarchical weighted hash tree.

A row descends region, rack and shard levels. At each level every child draws -ln(u) / weight, where
u in (0, 1) is a hash of the row's key and the child's name, and the smallest draw wins; so a child
wins in proportion to its weight. A child's draw depends on its own name and weight only: when one
weight grows, rows move into that child and nowhere else, and in subtrees whose weights stay the same
each row keeps its place. A further shard therefore comes as a subtree of its own (a region with one
rack): no other weight changes, and rows move into the new shard only.

Defined results: null and empty texts have size 8 and checksum 0; a null key is drawn like any
other value; repeated rows get the same shard and successive slots; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkspar.llm.common import shuffle_partitions, written

REGIONS, RACKS, SHARDS_PER_RACK = 3, 2, 4


@dataclass(frozen=True)
class Node:
    """A region, rack or shard (with its number); the weight of an inner node is that of its shards."""

    name: str
    children: tuple[Node, ...] = ()
    shard: int | None = None
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight


def tree(regions: int = REGIONS, racks: int = RACKS, shards: int = SHARDS_PER_RACK) -> Node:
    """Shards 0 to regions * racks * shards - 1."""
    at = lambda i, j, k: (i * racks + j) * shards + k
    return Node("root", tuple(Node(f"r{i}", tuple(Node(f"r{i}/k{j}", tuple(Node(f"shard{at(i, j, k)}", (), at(i, j, k)) for k in range(shards))) for j in range(racks))) for i in range(regions)))


def grown(root: Node, shard: int, weight: float = 1.0) -> Node:
    """The tree with one more shard, in a region and rack of its own."""
    region = f"r+{shard}"
    return Node(root.name, (*root.children, Node(region, (Node(f"{region}/k0", (Node(f"shard{shard}", (), shard, weight),)),))))


def levels(root: Node) -> list[list[Node]]:
    """The nodes below the root, level by level; all shards are at the same depth."""
    found, level = [], list(root.children)
    while level:
        found.append(level)
        if len({bool(n.children) for n in level}) > 1:
            raise ValueError("all shards must be at the same depth")
        level = [c for n in level for c in n.children]
    return found


def _draw(key: Column, child: Column) -> Column:
    """-ln(u) / weight; u is the middle of one of 2**52 equal steps, so it's never 0 or 1."""
    step = F.shiftrightunsigned(F.xxhash64(key, child["name"]), 12)
    return -F.log((step + 0.5) / float(1 << 52)) / child["weight"]


def shard_of(key: Column, root: Node) -> Column:
    """The number of the shard where the descent from the root ends; each level draws among the children of the node reached."""
    at, parents = F.lit(0), [root]
    for level in levels(root):
        first, choices = 0, []
        for parent in parents:
            choices.append(F.array(*[F.struct(F.lit(c.name).alias("name"), F.lit(c.weight).alias("weight"), F.lit(first + i).alias("at")) for i, c in enumerate(parent.children)]))
            first += len(parent.children)
        at = F.array_min(F.transform(F.get(F.array(*choices), at), lambda c: F.struct(_draw(key, c).alias("draw"), c["at"].alias("at"))))["at"]
        parents = level
    return F.get(F.array(*[F.lit(n.shard) for n in parents]), at)


def assign(docs: DataFrame, root: Node | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, grown_shard, slot): slot is gapless from 0 within each shard.

    Slots follow blocks of each shard, and the key within a block. A block is a hash of the key and
    the text's checksum; counts of blocks, of which there are a fixed number for each shuffle
    partition, give each block's first slot. So no shard is numbered in one task.
    """
    root = root or tree()
    shards = sorted(_shards(root))
    key = F.col("doc_id").cast("string")
    bytes_ = F.coalesce(F.col("__text"), F.lit("")).cast("binary")
    more = grown(root, shards[-1] + 1)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text")).select(
        "doc_id", (F.octet_length(bytes_).cast("bigint") + 8).alias("size"), F.crc32(bytes_).alias("text_crc32"), shard_of(key, root).alias("shard"), shard_of(key, more).alias("grown_shard")
    )
    blocks = max(1, 4 * shuffle_partitions(docs.sparkSession) // len(shards))
    rows = written(rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text_crc32", F.lit("block")), F.lit(blocks)).cast("int")), "placed")
    counts = rows.groupBy("shard", "block").count()
    before = F.sum("count").over(Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    firsts = counts.select(F.col("shard").alias("s"), F.col("block").alias("b"), F.coalesce(before, F.lit(0)).cast("bigint").alias("first"))
    within = F.row_number().over(Window.partitionBy("shard", "block").orderBy("doc_id", "text_crc32", "size")).cast("bigint") - 1
    numbered = rows.withColumn("within", within)
    return numbered.join(firsts, (F.col("shard") == F.col("s")) & (F.col("block") == F.col("b"))).select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("within")).alias("slot"), "grown_shard")


def _shards(node: Node) -> list[int]:
    return [node.shard] if not node.children else [s for c in node.children for s in _shards(c)]


def write_shards(docs: DataFrame, path: str, root: Node | None = None, id_col: str = "doc_id") -> None:
    """Writes the rows as Parquet, a folder for each shard; without a shuffle, each task adds files to the folders it has rows for.

    A null id is drawn like any other value, repeated rows go to one shard, a column named shard is replaced by the
    shard, other columns stay, and an empty table gives a folder without shards.
    """
    docs.withColumn("shard", shard_of(F.col(id_col).cast("string"), root or tree())).write.partitionBy("shard").parquet(path)
