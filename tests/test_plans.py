"""Plans: what is read, what is shuffled, and what never happens."""

from __future__ import annotations

import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  (registers the queries)
from smelter.operators.joins import broadcast_checked, enrich, join_null_safe
from smelter.operators.lineage import kept
from smelter.plans.registry import QUERIES

WRITING = {"flows_gold", "partition_pruned", "incremental_files", "json_bronze", "csv_rejects"}
READ_ONLY = [n for n in sorted(QUERIES)
             if not n.startswith(("stream_", "snapshot_")) and n not in WRITING]


def plan_of(spark, name) -> str:
    return QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan_of(spark, name) for name in READ_ONLY}


def test_no_query_pairs_everything_with_everything(plans):
    for name, plan in plans.items():
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_one_task_only_for_small_results(plans):
    """A single partition holds an aggregate of few rows, or a counted small table; never raw rows."""
    single = {name for name, plan in plans.items() if "Exchange SinglePartition" in plan}
    assert single <= {"medallion_gold", "profile_lineitem", "normalize_global", "incremental_since",
                      "incremental_overlap", "scd2_enrich"}


def test_no_row_at_a_time_python(plans):
    for name, plan in plans.items():
        assert "BatchEvalPython" not in plan, name
    assert [n for n, p in plans.items() if "ArrowEvalPython" in p] == ["discount_udf"]


@pytest.mark.parametrize("name, filters", [
    ("purchases_extract", "EqualTo(event_type,purchase)"), ("filter_price", "GreaterThan(p_retailprice,950.0)"),
    ("incremental_since", "GreaterThan(ts,")])
def test_filters_reach_the_scan(plans, name, filters):
    assert any(filters in f for f in re.findall(r"PushedFilters: \[.*?\], ReadSchema", plans[name], re.S)), plans[name]


@pytest.mark.parametrize("name, columns", [
    ("project_part", {"p_name", "p_retailprice"}), ("dedup_keys", {"l_orderkey", "l_linenumber"}),
    ("hourly_summary", {"ts", "user_id", "value"}), ("distinct_sources", {"lang", "source"}),
    ("norm_text_dups", {"doc_id", "text"}), ("user_accuracy", {"user_id", "event_type"})])
def test_only_needed_columns_are_read(plans, name, columns):
    read = re.findall(r"ReadSchema: struct<(.*?)>", plans[name])
    assert {c.split(":")[0] for part in read for c in part.split(",")} == columns


@pytest.mark.parametrize("name", ["enrich_broadcast", "orders_customers", "salted_revenue", "normalize_by_brand"])
def test_small_side_is_broadcast(plans, name):
    assert "BroadcastHashJoin" in plans[name] and "SortMergeJoin" not in plans[name]


@pytest.mark.parametrize("name", ["enrich_broadcast", "orders_customers"])
def test_large_side_is_not_broadcast(spark, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert "SortMergeJoin" in plan_of(spark, name)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", ["dedup_latest", "medallion_bronze", "user_state_latest"])
def test_latest_row_is_chosen_before_the_shuffle(plans, name):
    assert re.search(r"Exchange hashpartitioning[^\n]*\n[^\n]*WindowGroupLimit[^\n]*Partial", plans[name])


def test_top_k_does_not_sort_everything(plans):
    assert "TakeOrderedAndProject(limit=10" in plans["top_products"]


@pytest.mark.parametrize("name", ["line_total", "price_math", "price_tier", "events_props_flat", "code_tags", "log_rule_hits"])
def test_maps_do_not_shuffle(plans, name):
    assert "Exchange" not in plans[name]


def test_log_rules_are_worked_out_once(plans):
    """No filter repeats the expression that gives the findings, or the log that it reads."""
    from smelter.plans.catalogue.texts import LOG_KINDS

    assert plans["log_rule_hits"].count("get_json_object") == len(LOG_KINDS)


def test_no_sketch_per_value(plans):
    """An estimate of distinct values has a sketch per group, not one beside every value that is counted exactly."""
    grouped = re.findall(r"keys=\[([^\]]*)\], functions=\[[^\]]*approx_count_distinct", plans["approx_orders"])
    assert grouped and not any("l_orderkey" in keys for keys in grouped)


def test_facts_are_shuffled_once_for_their_version(spark):
    """Once to find the owner, once for the history; versions are not repeated for the months they cover."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = plan_of(spark, "scd2_enrich")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("SortMergeJoin") == 2 and "Generate" not in plan


@pytest.mark.parametrize("name, exchanges", [
    ("running_total", 1), ("rank_family", 1), ("event_gaps", 1), ("trailing_hour_sum", 1), ("scd2_build", 2),
    ("doc_rule_hits", 0), ("doc_tokens", 1), ("norm_text_dups", 1), ("medallion_silver", 1), ("funnel_progress", 2)])
def test_shuffles_are_as_few_as_can_be(plans, name, exchanges):
    assert plans[name].count("Exchange hashpartitioning") == exchanges, plans[name]


def test_a_hot_join_key_is_split(spark):
    """The part of a sort-merge join that holds a third of the facts runs as several tasks."""
    facts = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    dimension = spark.range(-1, 300_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = enrich(facts, dimension, "k", max_bytes=10)
        assert joined.filter("w IS NULL").count() == 0
        joined.write.format("noop").mode("overwrite").save()
        assert len(joined.collect()) == 300_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_checked_broadcast_survives_a_null_safe_join(spark):
    small = broadcast_checked(spark.range(10).select(F.col("id").alias("k"), F.lit(1).alias("w")), 1000)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = join_null_safe(spark.range(1000).select((F.col("id") % 20).alias("k")), small, ["k"], "left")
        assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_kept_only_inside_its_block(spark):
    silver = spark.range(10).withColumn("x", F.col("id") * 2)
    with kept(silver) as held:
        assert held.groupBy().sum("x").first()[0] == 90
        assert "InMemoryTableScan" in held.filter("x > 4")._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryTableScan" not in silver.filter("x > 4")._jdf.queryExecution().executedPlan().toString()


def test_bucketed_join_needs_no_shuffle(spark):
    from smelter.plans.catalogue.stored import BUCKETS, bucketed_tables, order_lines

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders, lines = bucketed_tables(spark, SMALL)
        joined = order_lines(spark, orders, lines)
        plan = joined._jdf.queryExecution().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan.split("== Physical Plan ==")[1]
        summed = joined.groupBy("o_orderkey").count()
        assert "Exchange" not in summed._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
        one = spark.table(lines).filter("l_orderkey = 7")
        assert f"SelectedBucketsCount: 1 out of {BUCKETS}" in one._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
