"""The worked examples of the order pipeline, with ANSI mode on."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smelter.plans.flows import Flows
from smelter.plans.medallion import (
    bronze_orders,
    bronze_orders_csv,
    gold_product_summary,
    order_flows,
    quarantined_orders,
    silver_orders,
)
from smelter.sources.readers import all_strings, read_csv, with_lineage

# The orders of the worked example.
ORDERS = """order_id,product,price,quantity,order_ts
1,widget,9.99,2,2026-01-15 14:30:00
2,gadget,24.99,1,2026-01-15 09:15:00
3,widget,9.99,5,2026-01-15 16:00:00
4,gizmo,4.99,10,2026-01-15 11:00:00
5,widget,N/A,1,2026-01-15 20:00:00
1,widget,9.99,2,2026-01-15 14:30:00
"""


@pytest.fixture(autouse=True)
def ansi_is_on(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_two_flows(spark, tmp_path):
    flows = Flows(spark, str(tmp_path))

    @flows.materialized_view(depends_on=["first_orders"])
    def second_orders(spark):
        return spark.table("first_orders").withColumn("total", F.col("price") * F.col("qty"))

    @flows.materialized_view()
    def first_orders(spark):
        # The rows of the worked example.
        return spark.createDataFrame([("1", "widget", 9.99, 2), ("2", "gadget", 24.99, 1)],
                                     "order_id string, product string, price double, qty bigint")

    assert flows.order() == ["first_orders", "second_orders"]
    assert [tuple(r)[:3] for r in flows.run().collect()] == [
        ("first_orders", "success", 2), ("second_orders", "success", 2)]
    assert {r.order_id: r.total for r in spark.table("second_orders").collect()} == {"1": 19.98, "2": 24.99}


def test_bronze(spark, tmp_path):
    path = tmp_path / "orders.csv"
    # The lines of the worked example.
    path.write_text("order_id,product,price,quantity\n1,widget,9.99,2\n2,gadget,24.99,1\n1,widget,9.99,2\n")
    raw = with_lineage(read_csv(spark, str(path), all_strings(["order_id", "product", "price", "quantity"])))
    bronze = bronze_orders(raw, ["order_id"], [F.desc("_source_file"), F.desc("price")])
    assert bronze.count() == 2
    assert bronze.schema["price"].dataType == T.StringType()
    assert bronze.schema["_ingested_at"].dataType == T.TimestampType()
    assert bronze.select("_source_file").distinct().first()[0].endswith("/orders.csv")


def _bronze_rows(spark):
    # The rows of the worked example.
    return spark.createDataFrame(
        [("1", "widget", "9.99", "2", "2026-01-15 14:30:00"),
         ("2", "gadget", "24.99", "1", "2026-01-15 09:15:00"),
         ("3", "doohickey", "N/A", "3", "2026-01-15 22:00:00")],
        ["order_id", "product", "price", "quantity", "order_ts"],
    ).withColumn("_ingested_at", F.current_timestamp())


def test_silver(spark):
    silver = silver_orders(_bronze_rows(spark))
    assert silver.count() == 2
    first = silver.filter("order_id = '1'").first()
    assert first.total == pytest.approx(19.98)
    assert first.order_hour == 14


def test_quarantine_takes_what_silver_drops(spark):
    rows = quarantined_orders(_bronze_rows(spark)).collect()
    assert [(r.order_id, r.price, r._reason) for r in rows] == [("3", "N/A", "price")]


def test_bad_quantity_stays_without_total(spark):
    rows = spark.createDataFrame([("1", "a", "2.0", "2.5", "x"), ("2", "a", "NaN", "1", "x"), ("3", "a", "1", "4", "x")],
                                 ["order_id", "product", "price", "quantity", "order_ts"])
    assert [(r.order_id, r.total, r.order_hour) for r in silver_orders(rows).orderBy("order_id").collect()] == [
        ("1", None, None), ("3", 4.0, None)]
    summary = gold_product_summary(silver_orders(rows)).first()
    assert (summary.order_count, summary.total_revenue, summary.avg_order_value) == (2, 4.0, 4.0)


def test_gold(spark):
    # The rows of the worked example.
    silver = spark.createDataFrame(
        [("1", "widget", 9.99, 2, 19.98, 14), ("2", "gadget", 24.99, 1, 24.99, 9),
         ("3", "widget", 9.99, 5, 49.95, 16), ("4", "gizmo", 4.99, 10, 49.90, 11)],
        ["order_id", "product", "price", "quantity", "total", "order_hour"])
    gold = gold_product_summary(silver).orderBy("revenue_rank").collect()
    assert [(r.product, round(r.total_revenue, 2), r.revenue_rank) for r in gold] == [
        ("widget", 69.93, 1), ("gizmo", 49.90, 2), ("gadget", 24.99, 3)]


def test_whole_pipeline(spark, tmp_path):
    (tmp_path / "orders.csv").write_text(ORDERS)
    flows = order_flows(spark, str(tmp_path / "orders.csv"), str(tmp_path / "layers"))
    report = {r.name: r.rows for r in flows.run().collect()}
    assert report == {"bronze_orders": 5, "silver_orders": 4, "gold_product_summary": 3}
    assert {"bronze_orders", "silver_orders", "gold_product_summary"} <= {
        t.name for t in spark.catalog.listTables()}
    first = sorted(map(tuple, spark.table("gold_product_summary").collect()))
    flows.run()
    assert sorted(map(tuple, spark.table("gold_product_summary").collect())) == first


def test_last_file_wins(spark, tmp_path):
    (tmp_path / "a.csv").write_text("order_id,product,price,quantity,order_ts\n1,old,9,1,x\n")
    (tmp_path / "b.csv").write_text("order_id,product,price,quantity,order_ts\n1,new,1,1,x\n")
    assert bronze_orders_csv(spark, str(tmp_path)).first().product == "new"
