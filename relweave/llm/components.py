"""Connected components of an edge list as Spark joins, for any number of nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (u, v: long); the root is the smallest node of its component.

    Neighbourhoods are contracted towards their smallest node, in turns over all
    neighbours and over the smaller ones, until only stars are left; the number of turns
    grows with the logarithm of the longest path. A minimum per node is a partial
    aggregate, and no turn holds a neighbourhood in one place. Loops, repeated edges and
    an empty table are fine; edges with a null end are left out.
    """
    e = edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = checkpoint(e)
    state = _state(e)
    while state[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(lowest, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = checkpoint(lowest.select("u", F.col("m").alias("v")).unionByName(moved).distinct())
        now = _state(e)
        if now == state:
            break
        state = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
