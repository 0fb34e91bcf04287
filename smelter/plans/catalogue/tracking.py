"""Latest state, progress, incremental reads and time windows over events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.operators.dedup import upsert
from smelter.operators.progress import accuracy, step_progress, with_not_started
from smelter.plans.registry import query
from smelter.sources.incremental import rows_since
from smelter.sources.readers import table
from smelter.streaming.windows import time_windows

STEPS = ("view", "click", "signup", "purchase")
DONE_FROM = 5.0
CUT = "2024-01-20 00:00:00"


@query("""
SELECT user_id, event_type, event_id, ts, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
""")
def user_state_latest(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("user_id", "event_type", "event_id", "ts", "value")
    cut = F.lit(CUT).cast("timestamp_ntz")
    return upsert(events.filter(F.col("ts") < cut), events.filter(F.col("ts") >= cut),
                  ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")])


def _progress_sql(keys: str) -> str:
    """Progress by the step list, from one state row per step."""
    done = [f"coalesce(bool_or(completed AND event_type = '{s}'), false)" for s in STEPS]
    whens = " ".join(f"WHEN NOT {d} THEN {i}" for i, d in enumerate(done))
    names = ", ".join(f"'{s}'" for s in STEPS)
    return f"""
progress AS (
    SELECT {keys}, true AS started, CAST(CASE {whens} ELSE {len(STEPS) - 1} END AS INTEGER) AS current_index,
           count(*) FILTER (WHERE completed) AS steps_completed, {len(STEPS)} AS total_steps,
           arg_max(event_type, updated_at) AS depth, max(updated_at) AS updated_at
    FROM states GROUP BY {keys}
),
named AS (SELECT *, [{names}][current_index + 1] AS current_step FROM progress)"""


def _states(spark: SparkSession, sf: str, *keys) -> DataFrame:
    return table(spark, sf, "events").groupBy(*keys, "event_type").agg(
        (F.max("value") >= DONE_FROM).alias("completed"), F.max("ts").alias("updated_at"))


@query(f"""
WITH states AS (
    SELECT user_id, CAST(ts AS DATE) AS day, event_type, max(value) >= {DONE_FROM} AS completed,
           max(ts) AS updated_at
    FROM events GROUP BY ALL
), {_progress_sql('user_id, day')}
SELECT * FROM named
""")
def funnel_progress(spark: SparkSession, sf: str) -> DataFrame:
    states = _states(spark, sf, "user_id", F.to_date("ts").alias("day"))
    return step_progress(states, ["user_id", "day"], "event_type", F.col("completed"), "event_type",
                         ["updated_at"], STEPS)


@query(f"""
WITH states AS (
    SELECT user_id AS c_custkey, event_type, max(value) >= {DONE_FROM} AS completed, max(ts) AS updated_at
    FROM events GROUP BY ALL
), {_progress_sql('c_custkey')}
SELECT c_custkey, coalesce(started, false) AS started, current_step, current_index, steps_completed, total_steps,
       depth, updated_at
FROM customer LEFT JOIN named USING (c_custkey)
""")
def customer_progress(spark: SparkSession, sf: str) -> DataFrame:
    states = _states(spark, sf, F.col("user_id").alias("c_custkey"))
    progress = step_progress(states, ["c_custkey"], "event_type", F.col("completed"), "event_type",
                             ["updated_at"], STEPS)
    return with_not_started(table(spark, sf, "customer").select("c_custkey"), progress, "c_custkey")


@query("""
SELECT user_id, count(*) AS attempts, count(*) FILTER (WHERE event_type = 'purchase') AS passes,
       count(*) FILTER (WHERE event_type = 'error') AS hints,
       count(*) FILTER (WHERE event_type = 'purchase') / count(*) AS accuracy
FROM events GROUP BY user_id
""")
def user_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    return accuracy(table(spark, sf, "events"), ["user_id"], kind == "purchase", kind == "error")


@query(f"""
SELECT * FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '{CUT}')
""")
def incremental_since(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    loaded = events.filter(F.col("ts") < F.lit(CUT).cast("timestamp_ntz"))
    return rows_since(events, loaded, "ts")


@query("""
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR
           AS window_end, event_type, count(*) AS n_events, round(sum(value), 2) AS total_value
FROM events GROUP BY ALL
""")
def event_windows_tumbling(spark: SparkSession, sf: str) -> DataFrame:
    windows = time_windows(table(spark, sf, "events"), "event_type", "value", "1 hour")
    return windows.withColumn("total_value", F.round("total_value", 2))


@query("""
WITH placed AS (
    SELECT event_type, value, unnest([time_bucket(INTERVAL 30 MINUTE, ts),
                                      time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]) AS window_start
    FROM events
)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS n_events,
       round(sum(value), 2) AS total_value
FROM placed GROUP BY ALL
""")
def event_windows_sliding(spark: SparkSession, sf: str) -> DataFrame:
    windows = time_windows(table(spark, sf, "events"), "event_type", "value", "1 hour", "30 minutes")
    return windows.withColumn("total_value", F.round("total_value", 2))
