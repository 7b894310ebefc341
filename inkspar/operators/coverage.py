"""Whether records hold all that their pages show: text run by text run, and the ids that they point to."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkspar.functions.html import SILENT, parse


def runs(html: Column) -> Column:
    """The runs of text between tags, without white space at their ends; scripts, styles and empty runs are left out. Null has none. Evaluated once a page, as html.column is."""

    @F.arrow_udf("array<string>")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in batches:
            yield pa.array([[t for t in (piece.strip() for piece, _ in parse(x.as_py()).leaves(SILENT)) if t] for x in pages], pa.list_(pa.string()))

    return found.asNondeterministic()(html)


def unmapped(shown: DataFrame, held: DataFrame, key: str, known: tuple[str, ...] = ()) -> DataFrame:
    """(key, run, extra): runs that a page shows more often (extra above 0) or less often (below) than its record holds them.

    shown and held: key, runs (array). The bags are counted before they meet, so a run that comes thousands of times is one row on either side. Runs named in
    ``known``, the captions of the pages, don't count as shown.
    """
    bag = lambda df, sign: df.select(key, F.explode("runs").alias("run")).filter(~F.col("run").isin(*known) if known and sign > 0 else F.lit(True)).groupBy(key, "run").agg((F.count("*") * sign).alias("n"))
    both = bag(shown, 1).unionByName(bag(held, -1))
    return both.groupBy(key, "run").agg(F.sum("n").alias("extra")).filter("extra <> 0")


def outside_index(related: DataFrame, index: DataFrame, id_: str) -> DataFrame:
    """The different target ids of records that the index doesn't have."""
    return related.select(F.col("target_id").alias(id_)).filter(F.col(id_).isNotNull()).distinct().join(index.select(id_).distinct(), id_, "left_anti")
