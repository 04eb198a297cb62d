"""Connected components of a large edge table by alternating stars.

Each round hangs the larger neighbours of a node on its smallest neighbour, then its
smaller ones (Kiveris et al. 2014), until nothing changes. Minima are aggregates that
combine in the map tasks, edges are written to the shared folder after each round, and
only two numbers per round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    pair = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(pair)).first())


def components(edges: DataFrame) -> DataFrame:
    """``a`` and ``b``: each node that is not the smallest of its component, and that one.

    ``edges`` has ``a`` and ``b`` of one ordered type.
    """
    e = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    e = stored(e.distinct(), "edges")
    before = _state(e)
    while before[0]:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = stored(small.union(smallest.select("a", "m")).distinct(), "edges")
        after = _state(e)
        if after == before:
            break
        before = after
    return e
