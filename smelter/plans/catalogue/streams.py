"""Streams over the events table, run until all its rows are read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.operators.lineage import scratch_folder
from smelter.plans.registry import query
from smelter.sources.readers import table
from smelter.streaming import state
from smelter.streaming.sinks import (
    read_split,
    read_totals,
    read_upserted,
    split_late_into,
    start_batches,
    start_files,
    totals_into,
    upsert_into,
)
from smelter.streaming.sources import bronze_stream, file_stream, parse_messages, with_event_time
from smelter.streaming.windows import drop_replays, session_windows, time_windows

DELAY = "10 minutes"


def _events(spark: SparkSession, sf: str) -> DataFrame:
    schema = table(spark, sf, "events").schema
    return file_stream(spark, sf, schema, pathGlobFilter="events.parquet")


def _in_files(df: DataFrame, folder: str, files: int, order: str) -> str:
    """``df`` as a few files that follow one another in ``order``."""
    df.repartitionByRange(files, order).write.parquet(folder)
    return folder


@query("""
SELECT event_id, ts, user_id, event_type, value, props, true AS has_time, 'events.parquet' AS file FROM events
""")
def stream_bronze(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_folder(spark)
    start_files(bronze_stream(_events(spark, sf)), f"{folder}/bronze", f"{folder}/state").awaitTermination()
    stored = spark.read.parquet(f"{folder}/bronze")
    return stored.withColumns({
        "has_time": F.col("_ingested_at").isNotNull(),
        "file": F.element_at(F.split("_source_file", "/"), -1),
    }).drop("_ingested_at", "_source_file")


@query("""
WITH windows AS (
    SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
           time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, event_type,
           count(*) AS n_events, round(sum(value), 2) AS total_value
    FROM events GROUP BY ALL
)
SELECT * FROM windows WHERE window_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)
""")
def stream_windows(spark: SparkSession, sf: str) -> DataFrame:
    # Append mode gives a window out once the watermark has passed its end.
    folder = scratch_folder(spark)
    timed = with_event_time(_events(spark, sf)).withWatermark("ts", DELAY)
    start_files(time_windows(timed, "event_type", "value", "1 hour"),
                f"{folder}/windows", f"{folder}/state").awaitTermination()
    stored = spark.read.parquet(f"{folder}/windows")
    return stored.withColumns({
        "window_start": F.col("window_start").cast("timestamp_ntz"),
        "window_end": F.col("window_end").cast("timestamp_ntz"),
        "total_value": F.round("total_value", 2),
    })


@query("SELECT event_id, ts, user_id, event_type, value FROM events")
def stream_replays(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_folder(spark)
    events = with_event_time(table(spark, sf, "events")).select("event_id", "ts", "user_id", "event_type", "value")
    replayed = events.unionByName(events.filter(F.pmod("event_id", F.lit(20)) == 0))
    source = _in_files(replayed, f"{folder}/source", 4, "ts")
    once = drop_replays(file_stream(spark, source, events.schema), ["event_id"], DELAY)
    start_files(once, f"{folder}/once", f"{folder}/state").awaitTermination()
    return spark.read.parquet(f"{folder}/once").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("""
SELECT user_id, event_type, event_id, ts, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
""")
def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_folder(spark)
    events = table(spark, sf, "events").select("user_id", "event_type", "event_id", "ts", "value")
    source = _in_files(events, f"{folder}/source", 3, "ts")
    stream = file_stream(spark, source, events.schema, files_per_trigger=1)
    keys, order = ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]
    start_batches(stream, upsert_into(f"{folder}/latest", keys, order), f"{folder}/state").awaitTermination()
    return read_upserted(spark, f"{folder}/latest", keys, order)


@query("""
SELECT CAST(event_id AS VARCHAR) AS _key, user_id, value, user_id IS NOT NULL AS _dq_json_valid
FROM (SELECT event_id, CASE WHEN event_id % 50 <> 0 THEN user_id END AS user_id,
             CASE WHEN event_id % 50 <> 0 THEN value END AS value FROM events)
""")
def stream_messages(spark: SparkSession, sf: str) -> DataFrame:
    # Shaped like a message queue's rows, with 2% of the values unreadable.
    folder = scratch_folder(spark)
    body = F.when(F.pmod("event_id", F.lit(50)) == 0, "not json").otherwise(F.to_json(F.struct("user_id", "value")))
    messages = with_event_time(table(spark, sf, "events")).select(
        F.col("event_id").cast("string").cast("binary").alias("key"), body.cast("binary").alias("value"),
        F.col("ts").alias("timestamp"))
    source = _in_files(messages, f"{folder}/source", 2, "timestamp")
    parsed = parse_messages(file_stream(spark, source, messages.schema, files_per_trigger=1), "user_id bigint, value double")
    start_files(parsed, f"{folder}/parsed", f"{folder}/state").awaitTermination()
    return spark.read.parquet(f"{folder}/parsed").drop("_message_at")


@query("SELECT user_id, count(*) AS n_events, round(sum(value), 2) AS total_value FROM events GROUP BY user_id")
def stream_user_counts(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_folder(spark)
    events = table(spark, sf, "events").select("user_id", "event_id", "value")
    source = _in_files(events, f"{folder}/source", 2, "event_id")
    keys, order = ["user_id"], [F.desc("n_events")]
    with state.rocksdb_state(spark):
        counts = state.event_counts(file_stream(spark, source, events.schema, files_per_trigger=1))
        start_batches(counts, upsert_into(f"{folder}/counts", keys, order), f"{folder}/state", "update").awaitTermination()
    return read_upserted(spark, f"{folder}/counts", keys, order).withColumn("total_value", F.round("total_value", 2))


@query("""
WITH newest AS (
    SELECT user_id, event_id, ts FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 3
)
SELECT user_id, string_agg(event_id, ',' ORDER BY ts, event_id) AS event_ids FROM newest GROUP BY user_id
""")
def stream_latest_events(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_folder(spark)
    events = with_event_time(table(spark, sf, "events")).select("user_id", "event_id", "ts")
    source = _in_files(events, f"{folder}/source", 2, "event_id")
    # Later states hold later or more events, so the greatest state is the newest.
    keys, order = ["user_id"], [F.desc(F.array_max("times")), F.desc(F.size("times")), F.desc(F.reverse("times"))]
    with state.rocksdb_state(spark):
        latest = state.latest_events(file_stream(spark, source, events.schema, files_per_trigger=1), keep=3)
        start_batches(latest, upsert_into(f"{folder}/latest", keys, order), f"{folder}/state", "update").awaitTermination()
    newest = read_upserted(spark, f"{folder}/latest", keys, order)
    return newest.select("user_id", F.array_join(F.col("event_ids").cast("array<string>"), ",").alias("event_ids"))


@query("""
WITH gaps AS (
    SELECT *, coalesce(epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) > 3600000000, true) AS fresh FROM events
),
islands AS (SELECT *, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM gaps)
SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL 1 HOUR AS window_end, count(*) AS n_events, round(sum(value), 2) AS total_value
FROM islands GROUP BY user_id, island
HAVING max(ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)
""")
def stream_sessions(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_folder(spark)
    timed = with_event_time(_events(spark, sf)).withWatermark("ts", DELAY)
    start_files(session_windows(timed, "user_id", "value", "1 hour"), f"{folder}/sessions", f"{folder}/state").awaitTermination()
    stored = spark.read.parquet(f"{folder}/sessions")
    return stored.withColumns({
        "window_start": F.col("window_start").cast("timestamp_ntz"),
        "window_end": F.col("window_end").cast("timestamp_ntz"),
        "total_value": F.round("total_value", 2),
    })


CUT = "2024-01-20 00:00:00"


def _in_two_drops(events: DataFrame, second: Column, source: str, run: Callable[[], None]) -> None:
    """``run`` a stream over ``source`` once for the events that come first, and once more for the others."""
    for drop, rows in (("first", ~second), ("second", second)):
        events.filter(rows).write.parquet(f"{source}/{drop}")
        run()


@query("""
WITH timed AS (SELECT user_id, event_id, epoch_us(ts) // 1000 AS ms FROM events),
gaps AS (SELECT *, coalesce(ms - lag(ms) OVER (PARTITION BY user_id ORDER BY ms) > 1800000, true) AS fresh FROM timed),
islands AS (SELECT *, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ms, event_id) AS island FROM gaps)
SELECT user_id, make_timestamp(min(ms) * 1000) AS started_at, make_timestamp(max(ms) * 1000) AS last_at, count(*) AS n_events
FROM islands GROUP BY user_id, island HAVING max(ms) + 1800000 <= (SELECT max(ms) - 600000 FROM timed)
""")
def stream_activities(spark: SparkSession, sf: str) -> DataFrame:
    # A user's activity is closed 30 minutes of event time after its last event; what is still open stays in the state.
    folder = scratch_folder(spark)
    source, keys, order = f"{folder}/source", ["user_id", "started_at"], [F.desc("n_events")]
    events = with_event_time(table(spark, sf, "events")).select("user_id", "event_id", "ts")

    def run() -> None:
        stream = file_stream(spark, source, events.schema, recursiveFileLookup=True).withWatermark("ts", DELAY)
        closed = state.closed_activities(stream, 1_800_000)
        start_batches(closed, upsert_into(f"{folder}/closed", keys, order), f"{folder}/state", "update").awaitTermination()

    with state.rocksdb_state(spark):
        _in_two_drops(events, F.col("ts") >= F.lit(CUT).cast("timestamp"), source, run)
    found = read_upserted(spark, f"{folder}/closed", keys, order)
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("started_at", "last_at")})


@query("SELECT event_type, count(*) AS n_events, round(sum(value), 2) AS total_value FROM events GROUP BY event_type")
def stream_totals(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_folder(spark)
    events = table(spark, sf, "events").select("event_type", "event_id", "value")
    source = _in_files(events, f"{folder}/source", 3, "event_id")
    totals = file_stream(spark, source, events.schema, files_per_trigger=1).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("total_value"))
    start_batches(totals, totals_into(f"{folder}/totals"), f"{folder}/state", "complete").awaitTermination()
    return read_totals(spark, f"{folder}/totals").withColumn("total_value", F.round("total_value", 2))


@query(f"""
WITH first AS (SELECT max(ts) - INTERVAL 10 MINUTE AS bound FROM events WHERE ts < TIMESTAMP '{CUT}' AND event_id % 50 <> 0)
SELECT event_id, ts, user_id, value, NOT (ts < TIMESTAMP '{CUT}' AND event_id % 50 <> 0) AND ts < bound AS is_late FROM events, first
""")
def stream_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    # Every fiftieth event comes with the second drop, most of them behind the watermark by then.
    folder = scratch_folder(spark)
    source, split = f"{folder}/source", f"{folder}/split"
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "value")

    def run() -> None:
        stream = file_stream(spark, source, events.schema, recursiveFileLookup=True)
        start_batches(stream, split_late_into(split, DELAY), f"{folder}/state").awaitTermination()

    late_drop = (F.col("ts") >= F.lit(CUT).cast("timestamp_ntz")) | (F.pmod("event_id", F.lit(50)) == 0)
    _in_two_drops(events, late_drop, source, run)
    return read_split(spark, split, False).withColumn("is_late", F.lit(False)).unionByName(
        read_split(spark, split, True).withColumn("is_late", F.lit(True)))
