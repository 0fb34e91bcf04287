from __future__ import annotations

import logging

import pytest
from pyspark.sql import functions as F

from smelter.plans.flows import Flows, read_flow


@pytest.fixture
def flows(spark, tmp_path):
    return Flows(spark, str(tmp_path))


def numbers(n):
    return lambda spark: spark.range(n)


def test_order_follows_dependencies(flows):
    flows.add("c", numbers(1), ["b", "a", "b"])
    flows.add("b", numbers(1), ["a", "an_external_table"])
    flows.add("a", numbers(1))
    assert flows.order() == ["a", "b", "c"]


def test_circle(flows):
    flows.add("a", numbers(1), ["b"])
    flows.add("b", numbers(1), ["a"])
    with pytest.raises(ValueError, match="circle"):
        flows.run()


def broken(spark):
    return spark.range(3).select(F.raise_error(F.lit("no luck")).alias("x"))


def test_error_stops_the_run(flows, caplog):
    flows.add("bad", broken)
    flows.add("after", numbers(1), ["bad"])
    with caplog.at_level(logging.ERROR), pytest.raises(Exception, match="no luck"):
        flows.run()
    assert "bad failed" in caplog.text


def test_skip_what_needs_the_failed_flow(flows):
    flows.add("bad", broken)
    flows.add("child", numbers(1), ["bad"])
    flows.add("grandchild", numbers(1), ["child"])
    flows.add("other", numbers(4))
    report = {r.name: r for r in flows.run(on_error="skip").collect()}
    assert {n: r.status for n, r in report.items()} == {
        "bad": "error", "child": "skipped", "grandchild": "skipped", "other": "success"}
    assert report["other"].rows == 4 and "no luck" in report["bad"].error


def test_unknown_policy(flows):
    with pytest.raises(ValueError):
        flows.run(on_error="ignore")


def test_flows_are_written_once_and_replaced(spark, flows):
    flows.add("stamped", lambda s: s.range(2).withColumn("at", F.current_timestamp()))
    flows.run()
    first = sorted(map(tuple, spark.table("stamped").collect()))
    assert sorted(map(tuple, spark.table("stamped").collect())) == first
    flows.run()
    assert spark.table("stamped").count() == 2


def test_empty_flow(flows):
    flows.add("nothing", numbers(0))
    assert flows.run().first().rows == 0


def test_a_broken_run_leaves_the_last_result(spark, flows, tmp_path):
    flows.add("once", numbers(3))
    flows.run()
    before = spark.table("once").inputFiles()
    flows.add("once", lambda session: session.range(9).select(F.assert_true(F.col("id") < 5), "id"))
    with pytest.raises(Exception):
        flows.run()
    assert spark.table("once").inputFiles() == before and spark.table("once").count() == 3
    assert read_flow(spark, str(tmp_path), "once").count() == 3
    for n in (5, 6, 7):
        flows.add("once", numbers(n))
        flows.run()
        assert spark.table("once").count() == read_flow(spark, str(tmp_path), "once").count() == n
    assert len(list(tmp_path.glob("once/_run=*/_SUCCESS"))) == 2
    with pytest.raises(ValueError):
        read_flow(spark, str(tmp_path), "never")


def test_a_flow_may_read_its_own_last_result(spark, flows):
    flows.add("grows", numbers(2))
    flows.run()
    flows.add("grows", lambda session: session.table("grows").union(session.range(1)))
    assert flows.run().first().rows == 3 and spark.table("grows").count() == 3
