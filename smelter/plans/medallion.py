"""The order pipeline: bronze as it came, silver typed and clean, gold summarised."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.functions.quality import first_reason
from smelter.functions.typing import to_double, to_int, to_timestamp
from smelter.operators.aggregates import product_summary
from smelter.operators.dedup import latest_by_key
from smelter.operators.windows import rank_all
from smelter.plans.flows import Flows
from smelter.sources.readers import all_strings, read_csv, with_lineage

# The columns of a raw order, all strings.
ORDER_COLUMNS = ("order_id", "product", "price", "quantity", "order_ts")


def bronze_orders(raw: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Raw rows once per key, values untouched."""
    return latest_by_key(raw, keys, order)


def bronze_orders_csv(spark: SparkSession, path: str | list[str],
                      order: Sequence[str] = ("_source_file", *ORDER_COLUMNS[1:])) -> DataFrame:
    """CSV files with lineage; of rows with one order id the last in ``order`` stays."""
    scan = with_lineage(read_csv(spark, path, all_strings(ORDER_COLUMNS)))
    return bronze_orders(scan, ["order_id"], [F.desc(c) for c in order])


def typed_orders(bronze: DataFrame) -> DataFrame:
    """Prices, quantities and totals as numbers; NULL where the text is none."""
    return bronze.withColumns({"price": to_double("price"), "quantity": to_int("quantity")}).withColumn(
        "total", F.col("price") * F.col("quantity"))


def silver_orders(bronze: DataFrame) -> DataFrame:
    """Orders with a readable price. A bad quantity stays, with a NULL total."""
    clean = typed_orders(bronze).filter(F.col("price").isNotNull())
    return clean.withColumn("order_hour", F.hour(to_timestamp("order_ts")))


def quarantined_orders(bronze: DataFrame) -> DataFrame:
    """Bronze rows with something unreadable, as they came, and why."""
    reason = first_reason({
        "price": to_double("price").isNotNull(),
        "quantity": to_int("quantity").isNotNull(),
        "order_ts": to_timestamp("order_ts").isNotNull(),
    })
    return bronze.withColumn("_reason", reason).filter(F.col("_reason").isNotNull())


def ranked(summary: DataFrame) -> DataFrame:
    return rank_all(summary, "total_revenue", "revenue_rank")


def gold_product_summary(silver: DataFrame) -> DataFrame:
    """Count, revenue and average order value per product, ranked by revenue."""
    return ranked(product_summary(silver, "product", "total"))


def order_flows(spark: SparkSession, csv_path: str, output_path: str, **bronze_options) -> Flows:
    """The three layers as flows over CSV files."""
    flows = Flows(spark, output_path)
    flows.add("bronze_orders", lambda session: bronze_orders_csv(session, csv_path, **bronze_options))
    flows.add("silver_orders", lambda session: silver_orders(session.table("bronze_orders")), ["bronze_orders"])
    flows.add("gold_product_summary", lambda session: gold_product_summary(session.table("silver_orders")),
              ["silver_orders"])
    return flows
