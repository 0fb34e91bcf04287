"""Every query with a SQL twin gives what DuckDB gives on the same tables."""

from __future__ import annotations

import pytest
from compare import connect, differences, duck_result, spark_result
from conftest import SF, SMALL

import __spark_entry__ as contract
from smelter.plans.registry import ORACLES, QUERIES

SLOW_TO_START = {name for name in QUERIES if name.startswith("stream_")}
SPLITTABLE = ["running_total", "rank_family", "event_gaps", "trailing_hour_sum", "moving_avg_user"]
# What sketches estimate has no SQL; each has a twin with its bound, and a test here.
ESTIMATES = {"users_estimated", "quantiles_lineitem"}


@pytest.fixture(scope="module")
def small_duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, duck, small_duck, name):
    sf, con = (SMALL, small_duck) if name in SLOW_TO_START else (SF, duck)
    result = spark_result(contract.queries()[name](spark, sf))
    assert differences(result, duck_result(con, contract.oracle_sql()[name])) == []
    assert result[2], "a query without rows shows nothing"


@pytest.mark.parametrize("hot_rows", [5, 60])
@pytest.mark.parametrize("name", SPLITTABLE)
def test_same_when_groups_are_cut(spark, duck, name, hot_rows):
    result = spark_result(contract.queries()[name](spark, SF, hot_rows=hot_rows))
    assert differences(result, duck_result(duck, contract.oracle_sql()[name])) == []


def test_every_query_has_a_twin():
    assert set(QUERIES) - ESTIMATES == set(ORACLES) and {f"{n}_bound" for n in ESTIMATES} <= set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())


def test_numbers_in_blocks(spark, duck):
    result = spark_result(contract.queries()["numbered_lines"](spark, SF, block_rows=700))
    assert differences(result, duck_result(duck, contract.oracle_sql()["numbered_lines"])) == []


def test_estimates_are_near(spark, duck):
    exact = {(r[0], r[1]): r[2] for r in duck.sql(contract.oracle_sql()["users_estimated_bound"]).fetchall()}
    found = contract.queries()["users_estimated"](spark, SF).collect()
    assert {(r.month, r.event_type): r.n_users for r in found} == exact
    assert all(abs(r.estimated - r.n_users) == pytest.approx(r.relative_error * r.n_users) and r.relative_error <= 0.05 for r in found)
    for r in contract.queries()["quantiles_lineitem"](spark, SF).collect():
        below, upto = duck.sql(f"SELECT count(*) FILTER ({r.column_name} < {r.value}), count(*) FILTER ({r.column_name} <= {r.value}) FROM lineitem").fetchall()[0]
        rank = r["quantile"] * r.n
        assert r.rank_error == pytest.approx(max(below - rank, rank - upto, 0) / r.n, abs=1e-12) and r.rank_error <= 1e-4


def test_entry(spark):
    assert contract.entry(spark).count() == 6


@pytest.mark.parametrize("name", ["medallion_gold", "scd2_build", "salted_revenue", "rank_family"])
def test_same_for_any_number_of_partitions(spark, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for partitions in (1, 4, 64):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            results.append(spark_result(contract.queries()[name](spark, SMALL)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] == results[2]
