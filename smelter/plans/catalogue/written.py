"""Formats, write modes, catalog tables and small operators that end in a table read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.operators.lineage import kept, scratch_folder
from smelter.operators.progress import at_depth
from smelter.operators.udfs import discount_row
from smelter.plans.registry import query
from smelter.sources.readers import read_any, read_csv_inferred, table
from smelter.sources.snapshots import with_bucket
from smelter.sources.writers import append_to_table, write_parquet

FORMATS = {"orc": {}, "json": {}, "xml": {"rowTag": "event"}}


@query(f"""
SELECT format, event_id, user_id, event_type, round(value, 4) AS value
FROM events, (SELECT unnest({['csv', *FORMATS, 'text']}) AS format)
""")
def formats_read(spark: SparkSession, sf: str) -> DataFrame:
    """The same events from every text and column format: CSV with guessed types, a schema for the others, lines for text."""
    folder = scratch_folder(spark)
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", F.round("value", 4).alias("value"))
    events.write.csv(f"{folder}/csv", header=True)
    read = [read_csv_inferred(spark, f"{folder}/csv").select(
        F.lit("csv").alias("format"), F.col("event_id").cast("bigint").alias("event_id"), F.col("user_id").cast("bigint").alias("user_id"),
        "event_type", F.col("value").cast("double").alias("value"))]
    for name, options in FORMATS.items():
        events.write.format(name).options(**options).save(f"{folder}/{name}")
        read.append(read_any(spark, name, f"{folder}/{name}", events.schema, **options).select(F.lit(name).alias("format"), *events.columns))
    events.select(F.concat_ws("|", *events.columns).alias("value")).write.text(f"{folder}/text")
    fields = F.split("value", r"\|")
    kinds = dict(events.dtypes)
    read.append(read_any(spark, "text", f"{folder}/text").select(
        F.lit("text").alias("format"), *(fields[i].cast(kinds[c]).alias(c) for i, c in enumerate(events.columns))))
    both = read[0]
    for more in read[1:]:
        both = both.unionByName(more)
    return both.withColumn("value", F.round("value", 4))


@query("""
SELECT o_orderkey, o_orderpriority, mode
FROM orders, (VALUES ('append'), ('append'), ('ignore'), ('overwrite')) AS modes(mode)
WHERE mode <> 'ignore' OR year(o_orderdate) < 1998
""")
def write_modes(spark: SparkSession, sf: str) -> DataFrame:
    """A second write of all orders: appended, ignored as older ones are there, or in their place."""
    folder, orders = scratch_folder(spark), table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    old, found = orders.filter(F.year("o_orderdate") < 1998), []
    for mode, first in (("append", orders), ("ignore", old), ("overwrite", old)):
        write_parquet(first, f"{folder}/{mode}")
        write_parquet(orders, f"{folder}/{mode}", mode)
        found.append(spark.read.parquet(f"{folder}/{mode}").select("o_orderkey", "o_orderpriority", F.lit(mode).alias("mode")))
    return found[0].unionByName(found[1]).unionByName(found[2])


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier")
def table_inserts(spark: SparkSession, sf: str) -> DataFrame:
    """A catalog table of customers, to which suppliers are inserted by position; its files stay where the path says."""
    name = f"parties_{uuid.uuid4().hex[:12]}"
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    customers.write.option("path", scratch_folder(spark)).saveAsTable(name)
    append_to_table(table(spark, sf, "supplier").select(
        F.lit(None).cast("string").alias("c_mktsegment"), F.col("s_name").alias("c_name"), F.col("s_suppkey").alias("c_custkey")), name)
    return spark.table(name)


@query("SELECT p_partkey, round(p_retailprice * 0.9, 6) AS sale_price FROM part")
def discount_rows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", F.round(discount_row("p_retailprice"), 6).alias("sale_price"))


@query("""
SELECT p_partkey, p_size, CASE WHEN p_size <= 10 THEN 'all' WHEN p_size <= 30 THEN 'beginner' ELSE 'advanced' END AS depth
FROM part WHERE p_size <= 10 OR p_size > 30
""")
def parts_at_depth(spark: SparkSession, sf: str) -> DataFrame:
    depth = F.when(F.col("p_size") <= 10, "all").when(F.col("p_size") <= 30, "beginner").otherwise("advanced")
    return at_depth(table(spark, sf, "part").select("p_partkey", "p_size", depth.alias("depth")), "advanced")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey % 10 = 7")
def bucket_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """Orders laid out by a hash of the customer; for some customers only their buckets are read."""
    folder = scratch_folder(spark)
    orders = with_bucket(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), "o_custkey", 16)
    orders.write.partitionBy("_bucket").parquet(folder)
    wanted = table(spark, sf, "customer").filter(F.pmod("c_custkey", F.lit(10)) == 7).select(F.col("c_custkey").alias("o_custkey"))
    return spark.read.parquet(folder).join(with_bucket(wanted, "o_custkey", 16), ["_bucket", "o_custkey"], "left_semi").select(
        "o_orderkey", "o_totalprice")


@query("""
SELECT l_returnflag AS kind, count(*) AS n_rows, round(sum(l_quantity), 2) AS total FROM lineitem GROUP BY l_returnflag
UNION ALL SELECT l_linestatus, count(*), round(sum(l_extendedprice), 2) FROM lineitem GROUP BY l_linestatus
""")
def silver_reused(spark: SparkSession, sf: str) -> DataFrame:
    """Two golds from one silver, which is kept for both and released after they are written."""
    folder = scratch_folder(spark)
    with kept(table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice")) as silver:
        for key, value in (("l_returnflag", "l_quantity"), ("l_linestatus", "l_extendedprice")):
            silver.groupBy(F.col(key).alias("kind")).agg(
                F.count(F.lit(1)).alias("n_rows"), F.round(F.sum(value), 2).alias("total")).write.parquet(f"{folder}/{key}")
    return spark.read.parquet(f"{folder}/l_returnflag", f"{folder}/l_linestatus")


@query("""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS ordered, datediff('day', CAST(o_orderdate AS DATE), current_date) AS days_ago FROM orders
""")
def order_age(spark: SparkSession, sf: str) -> DataFrame:
    ordered = F.to_date("o_orderdate")
    return table(spark, sf, "orders").select("o_orderkey", ordered.alias("ordered"),
                                             F.datediff(F.current_date(), ordered).cast("bigint").alias("days_ago"))
