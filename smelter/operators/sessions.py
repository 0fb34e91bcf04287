"""Sessions: runs of a key's events in which no gap is longer than a limit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smelter.functions.typing import epoch_micros


def sessions(events: DataFrame, keys: Sequence[str], value: str, gap_seconds: int, time: str = "ts") -> DataFrame:
    """Start, end, events and sum of ``value`` of every session per key.

    An event belongs to the session before it unless it comes more than ``gap_seconds`` after the last one. A session ends
    that long after its last event, as Spark's own session windows do. Rows without a time belong to none.

    Events of one key in the same cell of time, one gap long, are always of one session. They are combined to one row before
    the shuffle, so a key has at most one row per cell in its task, however many events it has.
    """
    at = epoch_micros(time)
    gap = gap_seconds * 1_000_000
    cells = events.filter(F.col(time).isNotNull()).groupBy(*keys, F.floor(at / F.lit(gap)).alias("_cell")).agg(
        F.min(time).alias("_first"), F.max(time).alias("_last"), F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_sum"))
    in_time = Window.partitionBy(*keys).orderBy("_cell")
    new = epoch_micros("_first") - F.lag(epoch_micros("_last")).over(in_time) > gap
    numbered = cells.withColumn("_new", F.coalesce(new, F.lit(True)).cast("bigint")).withColumn(
        "_session", F.sum("_new").over(in_time.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "_session").agg(
        F.min("_first").alias("session_start"),
        (F.max("_last") + F.make_dt_interval(secs=F.lit(gap_seconds))).alias("session_end"),
        F.sum("_n").alias("n_events"), F.sum("_sum").alias("total_value")).drop("_session")
