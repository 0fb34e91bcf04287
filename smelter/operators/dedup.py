"""Deduplication with a survivor that does not depend on how data is partitioned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, keys only."""
    return df.select(*keys).distinct()


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order``, which must leave no ties.

    Spark limits each key to one row before the shuffle (window group limit), so a
    hot key sends at most one row per input partition.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(ranked)).filter(F.col("_rn") == 1).drop("_rn")


def upsert(current: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``current`` with ``updates`` merged in: the latest row of each key survives."""
    return latest_by_key(current.unionByName(updates, allowMissingColumns=True), keys, order)
