"""The medallion pipeline over lineitem: raw order lines as text, then bronze, silver, gold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.functions.quality import is_positive
from smelter.operators.aggregates import summary_from_parts, summary_parts
from smelter.operators.joins import enrich
from smelter.plans.medallion import bronze_orders, quarantined_orders, ranked, silver_orders, typed_orders
from smelter.plans.registry import query
from smelter.sources.readers import table

# The raw lines as SQL: about 1% of prices and 0.4% of quantities are no numbers.
RAW_SQL = """
raw AS (
    SELECT l_orderkey, l_linenumber, l_extendedprice,
           concat(l_orderkey, '-', l_linenumber) AS order_id,
           CAST(l_partkey AS VARCHAR) AS product,
           CASE WHEN (l_orderkey * 7 + l_linenumber) % 100 = 0 THEN 'N/A'
                ELSE CAST(l_extendedprice AS VARCHAR) END AS price,
           CASE WHEN (l_orderkey * 3 + l_linenumber) % 250 = 0 THEN 'several'
                ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
           strftime(l_shipdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS order_ts
    FROM lineitem
)"""
BRONZE_SQL = RAW_SQL + """,
bronze AS (
    SELECT order_id, product, price, quantity, order_ts FROM (
        SELECT *, row_number() OVER (PARTITION BY order_id
                                     ORDER BY l_extendedprice DESC, product DESC, order_ts DESC) AS rn
        FROM raw
    ) WHERE rn = 1
)"""
# A quantity is only an int when it is written as one; DuckDB would also round '2.5'.
TYPED_SQL = BRONZE_SQL + """,
typed AS (
    SELECT order_id, product, try_cast(price AS DOUBLE) AS price,
           CASE WHEN regexp_full_match(quantity, '[+-]?[0-9]+') THEN try_cast(quantity AS INTEGER) END AS quantity,
           order_ts
    FROM bronze
)"""
SILVER_SQL = TYPED_SQL + """,
silver AS (
    SELECT order_id, product, price, quantity, order_ts, price * quantity AS total,
           CAST(hour(try_cast(order_ts AS TIMESTAMP)) AS INTEGER) AS order_hour
    FROM typed WHERE price IS NOT NULL
)"""


def raw_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as a source might deliver them: everything is text."""
    lines = table(spark, sf, "lineitem")
    key, number = F.col("l_orderkey"), F.col("l_linenumber")
    bad_price = F.pmod(key * 7 + number, F.lit(100)) == 0
    bad_quantity = F.pmod(key * 3 + number, F.lit(250)) == 0
    hours = F.make_dt_interval(hours=F.pmod(key, F.lit(24)).cast("int"))
    return lines.select(
        F.concat_ws("-", key, number).alias("order_id"),
        F.col("l_partkey").cast("string").alias("product"),
        F.when(bad_price, "N/A").otherwise(F.col("l_extendedprice").cast("string")).alias("price"),
        F.when(bad_quantity, "several").otherwise(F.col("l_quantity").cast("int").cast("string")).alias("quantity"),
        (F.col("l_shipdate") + hours).cast("string").alias("order_ts"),
        F.col("l_extendedprice").alias("_listed"),
    )


def bronze_lines(spark: SparkSession, sf: str) -> DataFrame:
    order = [F.desc("_listed"), F.desc("product"), F.desc("order_ts")]
    return bronze_orders(raw_lines(spark, sf), ["order_id"], order).drop("_listed")


@query(f"WITH {BRONZE_SQL} SELECT * FROM bronze")
def medallion_bronze(spark: SparkSession, sf: str) -> DataFrame:
    return bronze_lines(spark, sf)


@query(f"WITH {SILVER_SQL} SELECT * FROM silver")
def medallion_silver(spark: SparkSession, sf: str) -> DataFrame:
    return silver_orders(bronze_lines(spark, sf))


@query(f"""
WITH {SILVER_SQL},
summary AS (
    SELECT p_type AS product, count(*) AS order_count, round(sum(total), 2) AS total_revenue,
           round(sum(total), 2) / count(total) AS avg_order_value
    FROM silver LEFT JOIN part ON silver.product = CAST(p_partkey AS VARCHAR)
    GROUP BY p_type
)
SELECT product, order_count, total_revenue, round(avg_order_value, 4) AS avg_order_value,
       rank() OVER (ORDER BY total_revenue DESC) AS revenue_rank
FROM summary
""")
def medallion_gold(spark: SparkSession, sf: str) -> DataFrame:
    # Counted and summed per part before the join: fewer rows, and no hot part.
    per_part = summary_parts(silver_orders(bronze_lines(spark, sf)), ["product"], "total")
    types = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("product"), "p_type")
    summary = summary_from_parts(enrich(per_part, types, "product"), "p_type")
    rounded = summary.select(
        F.col("p_type").alias("product"), "order_count",
        F.round("total_revenue", 2).alias("total_revenue"),
        F.round("avg_order_value", 4).alias("avg_order_value"))
    return ranked(rounded)


@query(f"WITH {TYPED_SQL} SELECT order_id, price, quantity, price * quantity AS total FROM typed")
def silver_typed(spark: SparkSession, sf: str) -> DataFrame:
    return typed_orders(bronze_lines(spark, sf)).select("order_id", "price", "quantity", "total")


@query(f"""
WITH {BRONZE_SQL}
SELECT *, CASE WHEN try_cast(price AS DOUBLE) IS NULL THEN 'price' ELSE 'quantity' END AS _reason
FROM bronze
WHERE try_cast(price AS DOUBLE) IS NULL OR try_cast(quantity AS INTEGER) IS NULL
""")
def silver_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    return quarantined_orders(bronze_lines(spark, sf))


FLAGS_SQL = TYPED_SQL + """,
flags AS (
    SELECT order_id, coalesce(price > 0, false) AS _dq_price_valid,
           coalesce(quantity > 0, false) AS _dq_quantity_valid
    FROM typed
)"""


@query(f"WITH {FLAGS_SQL} SELECT * FROM flags")
def dq_flags(spark: SparkSession, sf: str) -> DataFrame:
    return typed_orders(bronze_lines(spark, sf)).select(
        "order_id",
        is_positive("price").alias("_dq_price_valid"),
        is_positive("quantity").alias("_dq_quantity_valid"),
    )


@query(f"""
WITH {FLAGS_SQL}
SELECT _dq_price_valid, _dq_quantity_valid, count(*) AS n_rows FROM flags GROUP BY ALL
""")
def dq_summary(spark: SparkSession, sf: str) -> DataFrame:
    return dq_flags(spark, sf).groupBy("_dq_price_valid", "_dq_quantity_valid").agg(
        F.count(F.lit(1)).alias("n_rows"))
