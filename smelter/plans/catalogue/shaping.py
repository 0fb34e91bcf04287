"""Projections, filters, derived columns and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.operators.dedup import distinct_keys
from smelter.plans.registry import query
from smelter.sources.readers import table

PREMIUM_PRICE = 950
THIS_YEARS_PRICE = 2000


@query("SELECT event_id, ts, user_id, value FROM events WHERE event_type = 'purchase'")
def purchases_extract(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    return events.filter(F.col("event_type") == "purchase").select("event_id", "ts", "user_id", "value")


@query("""
SELECT p.p_brand, round(sum(l.l_extendedprice * (1 - l.l_discount)), 4) AS revenue, count(*) AS n_lines,
       count(*) FILTER (l.l_quantity >= 10) AS n_large
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY p.p_brand
""")
def sql_product_revenue(spark: SparkSession, sf: str) -> DataFrame:
    # Summing per part first combines before the shuffle, so a hot part is one row by
    # the time it meets the join.
    return spark.sql(
        """
        WITH per_part AS (
            SELECT l_partkey, sum(l_extendedprice * (1 - l_discount)) AS revenue, count(*) AS n_lines,
                   count_if(l_quantity >= :least) AS n_large
            FROM {lineitem} GROUP BY l_partkey
        )
        SELECT p_brand, round(sum(revenue), 4) AS revenue, sum(n_lines) AS n_lines, sum(n_large) AS n_large
        FROM per_part JOIN {part} ON l_partkey = p_partkey
        GROUP BY p_brand
        """,
        args={"least": 10},
        lineitem=table(spark, sf, "lineitem"),
        part=table(spark, sf, "part"),
    )


@query("SELECT p_name, p_retailprice FROM part")
def project_part(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_name", "p_retailprice")


@query("SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_retailprice > 950.0")
def filter_price(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").filter(F.col("p_retailprice") > PREMIUM_PRICE).select(
        "p_partkey", "p_name", "p_retailprice")


@query("SELECT l_orderkey, l_linenumber, l_extendedprice * l_quantity AS total FROM lineitem")
def line_total(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    return lines.withColumn("total", F.col("l_extendedprice") * F.col("l_quantity")).select(
        "l_orderkey", "l_linenumber", "total")


@query("SELECT p_partkey, 2000 - p_retailprice AS gap FROM part")
def price_gap(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        "p_partkey", (F.lit(THIS_YEARS_PRICE) - F.col("p_retailprice")).alias("gap"))


@query("""
SELECT p_partkey, CASE WHEN p_retailprice >= 950 THEN 'premium' ELSE 'standard' END AS tier FROM part
""")
def price_tier(spark: SparkSession, sf: str) -> DataFrame:
    tier = F.when(F.col("p_retailprice") >= PREMIUM_PRICE, "premium").otherwise("standard")
    return table(spark, sf, "part").select("p_partkey", tier.alias("tier"))


@query("""
SELECT l_returnflag,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2)) * CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE)
           AS revenue
FROM lineitem GROUP BY l_returnflag
""")
def revenue_decimal(spark: SparkSession, sf: str) -> DataFrame:
    exact = F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_quantity").cast("decimal(18,2)")
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.sum(exact).cast("double").alias("revenue"))


@query("SELECT p_partkey AS product_id, p_name AS product, p_type AS category, p_retailprice AS price FROM part")
def part_renamed(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "part")
        .withColumnRenamed("p_partkey", "product_id")
        .withColumnsRenamed({"p_name": "product", "p_type": "category", "p_retailprice": "price"})
        .drop("p_brand", "p_size")
    )


@query("""
SELECT p_partkey,
       p_name LIKE '%bolt%' AS is_bolt,
       regexp_matches(p_brand, '^Brand#1[0-9]$') AS is_teen_brand,
       starts_with(p_name, 'red') AS is_red,
       ends_with(p_name, 'ring') AS is_ring,
       contains(p_name, 'blue') AS has_blue,
       p_size BETWEEN 10 AND 20 AS is_medium,
       p_type IN ('PROMO', 'SMALL') AS is_listed,
       p_name IS NULL AS no_name,
       isnan(p_retailprice) AS not_a_price,
       coalesce(nullif(p_type, 'PROMO'), 'none') AS type_or_none,
       p_type IS NOT NULL AND p_size > 1 AS is_sized
FROM part
""")
def predicate_pack(spark: SparkSession, sf: str) -> DataFrame:
    name = F.col("p_name")
    return (
        table(spark, sf, "part")
        .select(
            "p_partkey",
            name.like("%bolt%").alias("is_bolt"),
            F.col("p_brand").rlike("^Brand#1[0-9]$").alias("is_teen_brand"),
            name.startswith("red").alias("is_red"),
            name.endswith("ring").alias("is_ring"),
            name.contains("blue").alias("has_blue"),
            F.col("p_size").between(10, 20).alias("is_medium"),
            F.col("p_type").isin("PROMO", "SMALL").alias("is_listed"),
            F.isnull(name).alias("no_name"),
            F.isnan("p_retailprice").alias("not_a_price"),
            F.coalesce(F.nullif("p_type", F.lit("PROMO")), F.lit("none")).alias("type_or_none"),
            (F.col("p_type").isNotNull() & (F.col("p_size") > 1)).alias("is_sized"),
        )
    )


@query("""
SELECT 'customer' AS party, c_custkey AS party_key, c_name AS name, c_nationkey AS nation_key,
       c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL
SELECT 'supplier', s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier
""")
def union_parties(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select(
        F.lit("customer").alias("party"), F.col("c_custkey").alias("party_key"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation_key"), F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"))
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("party_key"), F.col("s_name").alias("name"), F.lit("supplier").alias("party"),
        F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation_key"))
    return customers.unionByName(suppliers, allowMissingColumns=True)


@query("SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem")
def new_keys_except(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey").subtract(table(spark, sf, "lineitem").select("l_orderkey"))


@query("SELECT DISTINCT source, lang FROM documents")
def distinct_sources(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_keys(table(spark, sf, "documents"), ["source", "lang"])


@query("""
SELECT l_partkey, round(sum(l_extendedprice), 2) AS revenue
FROM lineitem GROUP BY l_partkey ORDER BY revenue DESC, l_partkey LIMIT 10
""")
def top_products(spark: SparkSession, sf: str) -> DataFrame:
    revenue = table(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.round(F.sum("l_extendedprice"), 2).alias("revenue"))
    return revenue.orderBy(F.desc("revenue"), "l_partkey").limit(10)
