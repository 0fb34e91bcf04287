"""Cutting hot window groups into ordered blocks.

A window function needs its whole partition in one task. Rows of groups larger than a task should
take are range-partitioned by the group's keys and the full unique order, and the number of the
partition is their block: neither equal order values nor NULLs keep rows together, and no list
of cuts grows with the group. The window runs per (group, block), and one small row per block carries
what the blocks before it contribute. The blocks are stored before use, so every part of a plan
sees the same ones even when tasks are re-run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.operators.joins import join_null_safe
from smelter.operators.lineage import cut_lineage

# Largest window group left in one piece.
HOT_ROWS = 2_000_000


def hot_groups(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows; at most (all rows / hot_rows) of them."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > hot_rows)


def split_hot(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
              hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame] | None:
    """Rows of groups that fit one task, and those of hot groups with ``_rows`` and ``_block``.

    None when every group fits, which one aggregation over the keys decides; it combines before its
    shuffle. ``order`` must be unique within a group. Block numbers grow along the order.
    """
    hot = cut_lineage(hot_groups(df, keys, hot_rows))
    total = hot.agg(F.sum("_rows")).first()[0]
    if total is None:
        return None
    marked = join_null_safe(df, hot, keys, "left")
    blocks = -(-total // hot_rows)
    dealt = marked.filter(F.col("_rows").isNotNull()).repartitionByRange(blocks, *keys, *order)
    blocked = cut_lineage(dealt.withColumn("_block", F.spark_partition_id()))
    return marked.filter(F.col("_rows").isNull()).drop("_rows"), blocked
