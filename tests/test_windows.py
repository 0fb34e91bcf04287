"""Windows over cut groups give what plain windows give, also for one huge group."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from smelter.operators import windows
from smelter.operators.blocks import split_hot
from smelter.operators.sessions import sessions


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, a third under the NULL key, many ties, NULL orders and values."""
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{rnd.randrange(40)}"
        at = None if rnd.random() < 0.02 else int(rnd.paretovariate(0.7) * 50) % 400_000
        value = None if rnd.random() < 0.1 else rnd.randrange(-50, 1000) / 4
        rows.append((i, key, at, value))
    return spark.createDataFrame(rows, "id bigint, key string, at bigint, value double").cache()


def _same(left, right):
    assert sorted(map(repr, left.collect())) == sorted(map(repr, right.select(*left.columns).collect()))


HOT = pytest.mark.parametrize("hot_rows", [7, 100, 900])


@HOT
def test_groups_are_cut_evenly(skewed, hot_rows):
    cold, hot = split_hot(skewed, ["key"], ["at", "id"], hot_rows)
    assert hot.groupBy("key", "_block").count().agg(F.max("count")).first()[0] <= 2 * hot_rows
    assert cold.count() + hot.count() == 3000
    if hot_rows > 80:
        assert cold.filter("key LIKE 'k%'").count() == cold.count() > 0


def test_small_groups_are_left_whole(skewed):
    assert split_hot(skewed, ["key"], ["id"], 10_000) is None


@pytest.mark.parametrize("at", ["5", "CAST(NULL AS INT)"])
def test_equal_order_values_are_cut(spark, at):
    same = spark.range(1000).select(F.lit("k").alias("key"), F.expr(at).alias("at"), "id")
    _, hot = split_hot(same, ["key"], ["at", "id"], 10)
    assert hot.groupBy("key", "_block").count().agg(F.max("count")).first()[0] <= 20
    ranks = windows.rank_family(same, ["key"], "at", "id", 4, 10)
    assert dict(ranks.dtypes)["row_number"] == dict(ranks.dtypes)["dense_rank"] == "bigint"
    _same(windows.rank_family(same, ["key"], "at", "id", 4, 10_000), ranks)


@HOT
def test_running_total(skewed, hot_rows):
    window = Window.partitionBy("key").orderBy("at", "id").rowsBetween(Window.unboundedPreceding, 0)
    plain = skewed.withColumn("total", F.sum("value").over(window))
    cut = windows.running_total(skewed, ["key"], ["at", "id"], "value", "total", hot_rows)
    _same(plain, cut)


@HOT
def test_neighbours(skewed, hot_rows):
    window = Window.partitionBy("key").orderBy("at", "id")
    plain = skewed.withColumns({"before": F.lag("value").over(window), "after": F.lead("value").over(window)})
    cut = windows.neighbours(skewed, ["key"], ["at", "id"], "value", "before", "after", hot_rows)
    _same(plain, cut)


@HOT
@pytest.mark.parametrize("tiles", [1, 4, 13])
def test_rank_family(skewed, hot_rows, tiles):
    plain = windows.rank_family(skewed, ["key"], "at", "id", tiles, 10_000)
    cut = windows.rank_family(skewed, ["key"], "at", "id", tiles, hot_rows)
    _same(plain, cut)


def test_more_tiles_than_rows(skewed):
    some = skewed.filter("id < 20")
    _same(windows.rank_family(some, ["key"], "at", "id", 50, 100), windows.rank_family(some, ["key"], "at", "id", 50, 3))


@HOT
def test_rank_all(skewed, hot_rows):
    plain = skewed.withColumn("rank", F.rank().over(Window.orderBy(F.desc("value"))))
    _same(plain, windows.rank_all(skewed, "value", "rank", hot_rows))


@HOT
@pytest.mark.parametrize("seconds", [0, 30, 100_000])
def test_trailing_sum(skewed, hot_rows, seconds):
    frame = Window.partitionBy("key").orderBy("at").rangeBetween(-seconds, 0)
    plain = skewed.withColumn("total", F.sum("value").over(frame))
    _same(plain, windows.trailing_sum(skewed, ["key"], "at", "value", seconds, "total", hot_rows))


def test_all_rows_at_one_time(spark):
    same = spark.range(500).select(F.lit("k").alias("key"), F.lit(5).alias("at"), "id", F.lit(1.0).alias("value"))
    total = windows.running_total(same, ["key"], ["at", "id"], "value", "total", 50)
    assert sorted(r.total for r in total.collect()) == [float(i) for i in range(1, 501)]


@HOT
@pytest.mark.parametrize("rows", [1, 3, 150])
def test_moving_average(skewed, hot_rows, rows):
    window = Window.partitionBy("key").orderBy("at", "id").rowsBetween(-(rows - 1), 0)
    plain = skewed.withColumn("mean", F.avg("value").over(window))
    found = windows.moving_average(skewed, ["key"], ["at", "id"], "value", rows, "mean", hot_rows)
    _same(found.withColumn("mean", F.round("mean", 6)), plain.withColumn("mean", F.round("mean", 6)))


@pytest.mark.parametrize("block_rows", [1, 100, 10_000])
def test_rows_are_numbered_without_gaps(skewed, block_rows):
    plain = skewed.withColumn("n", F.row_number().over(Window.orderBy("at", "id")).cast("bigint"))
    _same(windows.numbered(skewed, ["at", "id"], "n", block_rows), plain)
    assert windows.numbered(skewed.filter("id < 0"), ["id"], "n").count() == 0


def test_rows_per_partition(spark):
    report = windows.rows_per_partition(spark.range(0, 30, 1, 3).filter("id < 20 AND id NOT BETWEEN 8 AND 12")).collect()
    assert sorted((r.partition_id, r.n_rows, r.share) for r in report) == [(0, 8, 8 / 15), (1, 7, 7 / 15)]


@pytest.mark.parametrize("gap", [1, 5, 60])
def test_sessions_equal_sparks_own(spark, gap):
    rnd = random.Random(gap)
    start = dt.datetime(2024, 1, 1)
    rows = [(None if i % 40 == 0 else rnd.choice(["hot"] * 5 + ["a", "b"]),
             None if i % 97 == 0 else start + dt.timedelta(microseconds=rnd.choice([0, 1_000_000, 999_999]), seconds=rnd.randrange(3000)),
             float(i)) for i in range(2000)]
    rows += [("edge", start + dt.timedelta(seconds=gap * i), 1.0) for i in range(5)] + [("edge", start + dt.timedelta(seconds=gap * 5, microseconds=1), 1.0)]
    events = spark.createDataFrame(rows, "key string, ts timestamp, value double").repartition(5)
    plain = events.groupBy(F.session_window("ts", f"{gap} seconds").alias("w"), "key").agg(
        F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("total_value"))
    found = sessions(events, ["key"], "value", gap)
    _same(found, plain.select("key", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n_events", "total_value"))
