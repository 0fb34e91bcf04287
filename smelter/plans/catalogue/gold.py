"""Aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.operators.aggregates import profile, salted_sum, share_of_group_max, share_of_max
from smelter.operators.joins import enrich
from smelter.operators.udfs import discount
from smelter.plans.registry import query
from smelter.sources.readers import table


@query("""
SELECT l_partkey AS product, sum(CAST(l_quantity AS BIGINT))::BIGINT AS total_qty,
       round(sum(l_extendedprice * l_quantity), 2) AS revenue
FROM lineitem GROUP BY l_partkey
""")
def product_qty_revenue(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("product")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("total_qty"),
        F.round(F.sum(F.col("l_extendedprice") * F.col("l_quantity")), 2).alias("revenue"))


@query("""
SELECT CAST(hour(ts) AS INTEGER) AS event_hour, count(*) AS event_count, round(sum(value), 2) AS total_value,
       count(DISTINCT user_id) AS unique_users
FROM events GROUP BY 1 ORDER BY 1
""")
def hourly_summary(spark: SparkSession, sf: str) -> DataFrame:
    # Spark plans the distinct count as (hour, user) groups first, which spreads and
    # shrinks the data before it is brought together per hour.
    return (
        table(spark, sf, "events")
        .groupBy(F.hour("ts").alias("event_hour"))
        .agg(F.count("*").alias("event_count"), F.round(F.sum("value"), 2).alias("total_value"),
             F.count_distinct("user_id").alias("unique_users"))
        .orderBy("event_hour")
    )


@query("""
SELECT p_brand, count(*) AS n_parts, min(p_retailprice) AS min_price, max(p_retailprice) AS max_price,
       round(sum(p_retailprice), 2) / count(*) AS mean_price
FROM part GROUP BY p_brand
""")
def price_stats(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").groupBy("p_brand").agg(
        F.count("*").alias("n_parts"), F.min("p_retailprice").alias("min_price"),
        F.max("p_retailprice").alias("max_price"),
        (F.round(F.sum("p_retailprice"), 2) / F.count("*")).alias("mean_price"))


@query("""
SELECT p_brand, round(sum(l_extendedprice), 2) AS revenue, count(*) AS row_count,
       round(sum(l_extendedprice), 2) / count(l_extendedprice) AS avg_revenue
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY p_brand
""")
def salted_revenue(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    brands = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    sums = salted_sum(enrich(lines, brands, "l_partkey"), ["p_brand"], ["l_orderkey", "l_linenumber"],
                      "l_extendedprice", "revenue")
    # The rounded sum over the count, so that the order of summing leaves no trace.
    return sums.select("p_brand", F.round("revenue", 2).alias("revenue"), "row_count",
                       (F.round("revenue", 2) / F.col("row_count")).alias("avg_revenue"))


@query("""
WITH daily AS (
    SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL
),
lists AS (
    SELECT user_id, string_agg(n, ',' ORDER BY day) AS daily_counts FROM daily GROUP BY user_id
),
sets AS (
    SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS event_types,
           arg_min(event_type, ts) AS first_type, arg_max(event_type, ts) AS last_type, count(*) AS n_events
    FROM events GROUP BY user_id
)
SELECT user_id, event_types, daily_counts, first_type, last_type, n_events FROM sets JOIN lists USING (user_id)
""")
def user_event_sets(spark: SparkSession, sf: str) -> DataFrame:
    # Lists hold one entry per day, not per event, so no user's list grows with the data.
    day = F.to_date("ts").alias("day")
    daily = table(spark, sf, "events").groupBy("user_id", day).agg(
        F.count("*").alias("n"),
        F.collect_set("event_type").alias("types"),
        F.min(F.struct("ts", "event_type")).alias("first"),
        F.max(F.struct("ts", "event_type")).alias("last"))
    in_days = F.array_sort(F.collect_list(F.struct("day", "n")))
    return daily.groupBy("user_id").agg(
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("types")))), ",").alias("event_types"),
        F.array_join(F.transform(in_days, lambda d: d["n"].cast("string")), ",").alias("daily_counts"),
        F.min("first")["event_type"].alias("first_type"),
        F.max("last")["event_type"].alias("last_type"),
        F.sum("n").alias("n_events"))


PROFILED = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(" UNION ALL ".join(f"""
SELECT '{c}' AS column_name, count({c}) AS n, count(*) - count({c}) AS n_null, round(avg({c}), 7) AS mean,
       round(stddev_samp({c}), 6) AS stddev, min({c}) AS min, max({c}) AS max FROM lineitem""" for c in PROFILED))
def profile_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return profile(table(spark, sf, "lineitem"), PROFILED).withColumns(
        {"mean": F.round("mean", 7), "stddev": F.round("stddev", 6)})


@query("SELECT p_partkey, p_retailprice / (SELECT max(p_retailprice) FROM part) AS share FROM part")
def normalize_global(spark: SparkSession, sf: str) -> DataFrame:
    return share_of_max(table(spark, sf, "part").select("p_partkey", "p_retailprice"), "p_retailprice",
                        "share").drop("p_retailprice")


@query("""
SELECT p_partkey, p_brand, p_retailprice / max(p_retailprice) OVER (PARTITION BY p_brand) AS share FROM part
""")
def normalize_by_brand(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select("p_partkey", "p_brand", "p_retailprice")
    return share_of_group_max(parts, ["p_brand"], "p_retailprice", "share").drop("p_retailprice")


@query("SELECT p_partkey, p_retailprice * 0.9::DOUBLE AS sale_price FROM part")
def discount_udf(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", discount("p_retailprice").alias("sale_price"))
