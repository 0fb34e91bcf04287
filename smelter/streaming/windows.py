"""Time-window aggregates, the same for batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _summary(grouped, value: str) -> DataFrame:
    return grouped.agg(F.count(F.lit(1)).alias("n_events"), F.sum(value).alias("total_value"))


def _bounds(windowed: DataFrame) -> DataFrame:
    return windowed.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                           *[c for c in windowed.columns if c != "window"])


def time_windows(events: DataFrame, key: str, value: str, length: str, slide: str | None = None,
                 time: str = "ts") -> DataFrame:
    """Tumbling windows, or sliding ones with ``slide``, per key."""
    window = F.window(time, length, slide) if slide else F.window(time, length)
    return _bounds(_summary(events.groupBy(window.alias("window"), key), value))


def session_windows(events: DataFrame, key: str, value: str, gap: str, time: str = "ts") -> DataFrame:
    """Sessions per key of a stream: windows that grow while events follow within ``gap``, and merge where a late one joins them.

    A batch has ``operators.sessions``, which combines a key's events before its shuffle.
    """
    return _bounds(_summary(events.groupBy(F.session_window(time, gap).alias("window"), key), value))


def drop_replays(events: DataFrame, keys: list[str], delay: str, time: str = "ts") -> DataFrame:
    """Stream events once each, though they may be delivered again within ``delay``."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)
