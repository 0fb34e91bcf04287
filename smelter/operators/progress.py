"""State tracking: progress through ordered steps, attempts and accuracy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def step_progress(states: DataFrame, keys: Sequence[str], step: str, completed: Column, depth: str,
                  updated: Sequence[str], steps: Sequence[str]) -> DataFrame:
    """Where each group stands in an ordered list of steps.

    ``current_step`` is the first step that has no completed row, the last one when
    all are done. ``depth`` is taken from the latest row by ``updated``. One
    aggregation that combines before its shuffle, whatever the group sizes.
    """
    done = [F.coalesce(F.max(completed & (F.col(step) == s)), F.lit(False)).alias(f"_done{i}")
            for i, s in enumerate(steps)]
    grouped = states.groupBy(*keys).agg(
        *done,
        F.count_if(completed).alias("steps_completed"),
        F.max_by(depth, F.struct(*updated)).alias("depth"),
        F.max(updated[0]).alias("updated_at"),
    )
    last = len(steps) - 1
    open_steps = [F.when(~F.col(f"_done{i}"), F.lit(i)) for i in range(len(steps))]
    index = F.coalesce(*open_steps, F.lit(last))
    names = F.array(*map(F.lit, steps))
    return grouped.select(
        *keys,
        F.lit(True).alias("started"),
        F.get(names, index).alias("current_step"),
        index.alias("current_index"),
        "steps_completed",
        F.lit(len(steps)).alias("total_steps"),
        "depth",
        "updated_at",
    )


def with_not_started(entities: DataFrame, progress: DataFrame, key: str) -> DataFrame:
    """Progress of every entity; those without any state are not started."""
    joined = entities.join(progress, key, "left")
    return joined.withColumn("started", F.coalesce("started", F.lit(False)))


def accuracy(attempts: DataFrame, keys: Sequence[str], passed: Column, used_hint: Column) -> DataFrame:
    """Attempts, passes, hints and passes over attempts (0 without attempts)."""
    counted = attempts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("attempts"),
        F.count_if(passed).alias("passes"),
        F.count_if(used_hint).alias("hints"),
    )
    return counted.withColumn(
        "accuracy", F.when(F.col("attempts") == 0, 0.0).otherwise(F.col("passes") / F.col("attempts")))


def at_depth(steps: DataFrame, depth: str, column: str = "depth") -> DataFrame:
    """Steps meant for everyone or for the chosen depth."""
    return steps.filter(F.col(column).isin("all", depth))
