"""Deduplication and joins on keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.operators.dedup import distinct_keys, latest_by_key
from smelter.operators.joins import as_of_version, build_history, enrich, matching, missing
from smelter.plans.registry import query
from smelter.sources.readers import table


@query("SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def dedup_keys(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                 ORDER BY l_extendedprice DESC, l_partkey DESC, l_suppkey DESC) AS rn
    FROM lineitem
) WHERE rn = 1
""")
def dedup_latest(spark: SparkSession, sf: str) -> DataFrame:
    order = [F.desc("l_extendedprice"), F.desc("l_partkey"), F.desc("l_suppkey")]
    return latest_by_key(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], order)


@query("""
SELECT o.o_orderkey, o.o_totalprice, c.c_name, c.c_mktsegment
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
""")
def orders_customers(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.col("o_custkey").alias("c_custkey"))
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return enrich(orders, customers, "c_custkey", "inner").drop("c_custkey")


@query("""
SELECT c_custkey, c_name, count(o_orderkey) AS n_orders, round(coalesce(sum(o_totalprice), 0), 2) AS spent
FROM customer LEFT JOIN orders ON c_custkey = o_custkey
GROUP BY c_custkey, c_name
""")
def customer_orders_left(spark: SparkSession, sf: str) -> DataFrame:
    # Orders are summed per customer before the join, so it meets each key once.
    spent = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("spent"))
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    return customers.join(spent, "c_custkey", "left").select(
        "c_custkey", "c_name",
        F.coalesce("n_orders", F.lit(0)).alias("n_orders"),
        F.round(F.coalesce("spent", F.lit(0.0)), 2).alias("spent"))


@query("""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_extendedprice, p.p_brand, p.p_type
FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
""")
def enrich_broadcast(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type")
    return enrich(lines, parts, "l_partkey")


HISTORY_SQL = """
daily AS (
    SELECT o_custkey, o_orderdate, arg_min(o_orderpriority, o_orderkey) AS o_orderpriority
    FROM orders GROUP BY o_custkey, o_orderdate
),
changed AS (
    SELECT * FROM (
        SELECT *, lag(o_orderpriority) OVER w AS before, row_number() OVER w AS n
        FROM daily WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate)
    ) WHERE n = 1 OR o_orderpriority IS DISTINCT FROM before
),
history AS (
    SELECT o_custkey, o_orderpriority, o_orderdate AS valid_from,
           lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS valid_to
    FROM changed
)"""


@query(f"WITH {HISTORY_SQL} SELECT * FROM history")
def scd2_build(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderpriority", "o_orderkey")
    return build_history(orders, "o_custkey", "o_orderdate", "o_orderpriority", "o_orderkey")


@query(f"""
WITH {HISTORY_SQL}
SELECT l.l_orderkey, l.l_linenumber, l.l_extendedprice, l.l_shipdate, o.o_custkey,
       h.o_orderpriority AS priority_in_force, h.valid_from, h.valid_to
FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN history h ON o.o_custkey = h.o_custkey AND l.l_shipdate >= h.valid_from
                   AND (h.valid_to IS NULL OR l.l_shipdate < h.valid_to)
""")
def scd2_enrich(spark: SparkSession, sf: str) -> DataFrame:
    owners = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate")
    facts = lines.join(owners, "l_orderkey", "left")
    found = as_of_version(facts, scd2_build(spark, sf), "o_custkey", "l_shipdate")
    return found.withColumnRenamed("o_orderpriority", "priority_in_force")


@query("""
SELECT r.r_name, n.n_name, count(DISTINCT c.c_custkey) AS n_customers, count(DISTINCT s.s_suppkey) AS n_suppliers
FROM region r JOIN nation n ON n.n_regionkey = r.r_regionkey
LEFT JOIN customer c ON c.c_nationkey = n.n_nationkey
LEFT JOIN supplier s ON s.s_nationkey = n.n_nationkey
GROUP BY r.r_name, n.n_name
""")
def region_nation_grid(spark: SparkSession, sf: str) -> DataFrame:
    regions = table(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    customers = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.count(F.lit(1)).alias("n_customers"))
    suppliers = table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(
        F.count(F.lit(1)).alias("n_suppliers"))
    nations = table(spark, sf, "nation").join(regions, "n_regionkey")
    counted = nations.join(customers, "n_nationkey", "left").join(suppliers, "n_nationkey", "left")
    return counted.select("r_name", "n_name", F.coalesce("n_customers", F.lit(0)).alias("n_customers"),
                          F.coalesce("n_suppliers", F.lit(0)).alias("n_suppliers"))


@query("""
SELECT c_custkey, c_name FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders
                  WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')
""")
def customers_without_urgent_finished_orders(spark: SparkSession, sf: str) -> DataFrame:
    return missing(*_customers_and_urgent(spark, sf), "c_custkey")


@query("""
SELECT c_custkey, c_name FROM customer
WHERE EXISTS (SELECT 1 FROM orders
              WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')
""")
def customers_with_urgent_finished_orders(spark: SparkSession, sf: str) -> DataFrame:
    return matching(*_customers_and_urgent(spark, sf), "c_custkey")


def _customers_and_urgent(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    urgent = table(spark, sf, "orders").filter(
        (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F"))
    return (table(spark, sf, "customer").select("c_custkey", "c_name"),
            urgent.select(F.col("o_custkey").alias("c_custkey")).distinct())


@query("""
SELECT o_orderkey, o_totalprice FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
""")
def orders_without_lines(spark: SparkSession, sf: str) -> DataFrame:
    return missing(*_orders_and_lines(spark, sf), "o_orderkey")


@query("""
SELECT o_orderkey, o_totalprice FROM orders
WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
""")
def orders_with_lines(spark: SparkSession, sf: str) -> DataFrame:
    return matching(*_orders_and_lines(spark, sf), "o_orderkey")


def _orders_and_lines(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), lines
