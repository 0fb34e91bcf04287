"""Connected components of edges by alternating large and small stars, each round stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.operators.lineage import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest around that node."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = edges.filter(F.col("u") > F.col("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter(F.col("v") > F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``u`` and the smallest node ``v`` of its component, for every node but the smallest ones.

    ``edges`` has the columns ``u`` and ``v`` of one comparable type; order, repeats and loops do not matter.
    The stars of a hot node are minima, which combine before their shuffle, and joins that adaptive execution
    splits. The rounds end when one changes nothing; their number grows with the logarithm of the
    longest chain.
    """
    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).collect()[0])

    now = cut_lineage(_small_star(edges.select("u", "v").filter(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()))
    before = state(now)
    while before[0]:
        now = cut_lineage(_small_star(_large_star(now)))
        after = state(now)
        if after == before:
            break
        before = after
    return now
