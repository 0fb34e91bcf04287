"""Window functions over ordered groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from smelter.functions.typing import epoch_micros, epoch_seconds
from smelter.operators import windows
from smelter.operators.sessions import sessions
from smelter.plans.registry import query
from smelter.sources.readers import table


@query("""
SELECT event_id, user_id, ts, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS running_total
FROM events
""")
def running_total(spark: SparkSession, sf: str, hot_rows: int = windows.HOT_ROWS) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    total = windows.running_total(events, ["user_id"], ["ts", "event_id"], "value", "running_total", hot_rows)
    return total.select("event_id", "user_id", "ts", F.round("running_total", 2).alias("running_total"))


@query("""
WITH daily AS (
    SELECT event_type, CAST(ts AS DATE) AS day, round(sum(value), 2) AS total FROM events GROUP BY ALL
)
SELECT event_type, day, total, round(sum(total) OVER w, 2) / count(*) OVER w AS moving_avg
FROM daily WINDOW w AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
""")
def moving_avg(spark: SparkSession, sf: str) -> DataFrame:
    daily = table(spark, sf, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.round(F.sum("value"), 2).alias("total"))
    # One row per type and day by now: a window holds as many rows as there are days.
    week = Window.partitionBy("event_type").orderBy("day").rowsBetween(-6, 0)
    return daily.withColumn("moving_avg", F.round(F.sum("total").over(week), 2) / F.count("*").over(week))


@query("""
SELECT p_partkey, p_brand,
       row_number() OVER u AS row_number, rank() OVER w AS rank, dense_rank() OVER w AS dense_rank,
       percent_rank() OVER w AS percent_rank,
       CAST(ntile(4) OVER u AS INTEGER) AS ntile, cume_dist() OVER w AS cume_dist
FROM part
WINDOW w AS (PARTITION BY p_brand ORDER BY p_size),
       u AS (PARTITION BY p_brand ORDER BY p_size, p_partkey)
""")
def rank_family(spark: SparkSession, sf: str, hot_rows: int = windows.HOT_ROWS) -> DataFrame:
    parts = table(spark, sf, "part").select("p_partkey", "p_brand", "p_size")
    return windows.rank_family(parts, ["p_brand"], "p_size", "p_partkey", 4, hot_rows).drop("p_size")


@query("""
SELECT event_id, user_id, epoch_us(ts) - epoch_us(lag(ts) OVER w) AS since_previous,
       epoch_us(lead(ts) OVER w) - epoch_us(ts) AS until_next
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""")
def event_gaps(spark: SparkSession, sf: str, hot_rows: int = windows.HOT_ROWS) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", epoch_micros("ts").alias("at"))
    beside = windows.neighbours(events, ["user_id"], ["ts", "event_id"], "at", "previous", "following", hot_rows)
    return beside.select("event_id", "user_id", (F.col("at") - F.col("previous")).alias("since_previous"),
                         (F.col("following") - F.col("at")).alias("until_next"))


@query("""
SELECT event_id, user_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY CAST(floor(epoch(ts)) AS BIGINT)
           RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW), 2) AS last_hour
FROM events
""")
def trailing_hour_sum(spark: SparkSession, sf: str, hot_rows: int = windows.TRAILING_HOT_ROWS) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "user_id", epoch_seconds("ts").alias("second"), "value")
    total = windows.trailing_sum(events, ["user_id"], "second", "value", 3600, "last_hour", hot_rows)
    return total.select("event_id", "user_id", F.round("last_hour", 2).alias("last_hour"))


@query("""
SELECT event_id, user_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
           ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 4) AS moving_avg
FROM events
""")
def moving_avg_user(spark: SparkSession, sf: str, hot_rows: int = windows.HOT_ROWS) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    mean = windows.moving_average(events, ["user_id"], ["ts", "event_id"], "value", 7, "moving_avg", hot_rows)
    return mean.select("event_id", "user_id", F.round("moving_avg", 4).alias("moving_avg"))


@query("""
SELECT l_orderkey, l_linenumber, l_extendedprice,
       row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_extendedprice) AS line_id
FROM lineitem
""")
def numbered_lines(spark: SparkSession, sf: str, block_rows: int = windows.HOT_ROWS) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return windows.numbered(lines, ["l_orderkey", "l_linenumber", "l_extendedprice"], "line_id", block_rows)


@query("SELECT 16 AS n_partitions, count(*) AS n_rows, true AS is_even FROM lineitem")
def partition_report(spark: SparkSession, sf: str) -> DataFrame:
    # Dealt by a hash of the order: no partition has more than twice its share.
    dealt = table(spark, sf, "lineitem").select("l_orderkey").repartition(16, "l_orderkey")
    report = windows.rows_per_partition(dealt)
    return report.agg(F.count(F.lit(1)).cast("int").alias("n_partitions"), F.sum("n_rows").alias("n_rows"),
                      (F.max("share") <= 2 / 16).alias("is_even"))


SESSION_GAP = 6 * 3600


@query(f"""
WITH gaps AS (
    SELECT *, coalesce(epoch_us(ts) - epoch_us(lag(ts) OVER w) > {SESSION_GAP * 1_000_000}, true) AS fresh
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)
),
islands AS (SELECT *, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM gaps)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL {SESSION_GAP} SECOND AS session_end, count(*) AS n_events,
       round(sum(value), 2) AS total_value
FROM islands GROUP BY user_id, island
""")
def event_sessions(spark: SparkSession, sf: str) -> DataFrame:
    found = sessions(table(spark, sf, "events"), ["user_id"], "value", SESSION_GAP)
    return found.withColumn("total_value", F.round("total_value", 2))
