"""Joins to dimensions: size-checked broadcast, existence checks, SCD-2 history."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def broadcast_checked(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Hint a broadcast when the plan's own size of ``df`` is within a limit, else leave the choice to Spark.

    The limit defaults to the session's ``spark.sql.autoBroadcastJoinThreshold``. No job runs for the check: the
    size is that of the files and columns read, and of computed sides an estimate that errs upwards. Past
    the limit adaptive execution decides by the bytes it has measured, and a sort-merge join's
    skewed partitions are split.
    """
    if max_bytes is None:
        max_bytes = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if size <= max_bytes else df


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where NULL equals NULL, as it does in grouping."""
    same = reduce(and_, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
    added = [f"r.{c}" for c in right.columns if c not in keys]
    return left.alias("l").join(right.alias("r"), same, how).select("l.*", *added)


def enrich(facts: DataFrame, dimension: DataFrame, on: str | Sequence[str], how: str = "left",
           max_bytes: int | None = None) -> DataFrame:
    """Add a dimension's columns to facts without shuffling the facts when it is small."""
    return facts.join(broadcast_checked(dimension, max_bytes), on=on, how=how)


def matching(df: DataFrame, other: DataFrame, on: Column | str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` with at least one match."""
    return df.join(other, on, "left_semi")


def missing(df: DataFrame, other: DataFrame, on: Column | str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` with no match."""
    return df.join(other, on, "left_anti")


def build_history(changes: DataFrame, key: str, day: str, attribute: str, tie: str) -> DataFrame:
    """SCD-2 rows ``(key, attribute, valid_from, valid_to)`` from dated observations.

    Of several observations on one day the lowest ``tie`` counts; repeated values are
    merged and the latest version has a NULL ``valid_to``. The first aggregation
    combines before the shuffle and leaves one row per key and day, so the windows
    see no more rows per key than there are days, however hot the key is.
    """
    daily = changes.groupBy(key, day).agg(F.min_by(attribute, tie).alias(attribute))
    in_time = Window.partitionBy(key).orderBy(day)
    changed = (
        daily.withColumn("_first", F.row_number().over(in_time) == 1)
        .withColumn("_before", F.lag(attribute).over(in_time))
        .filter(F.col("_first") | ~F.col(attribute).eqNullSafe(F.col("_before")))
    )
    return changed.select(
        key, attribute, F.col(day).alias("valid_from"), F.lead(day).over(in_time).alias("valid_to")
    )


# Versions that a fact looks through one by one, in ``as_of_version``.
BLOCK = 64


def overlapping_versions(history: DataFrame, key: str) -> DataFrame:
    """Versions that start before their predecessor ends; empty for a sound history."""
    in_time = Window.partitionBy(key).orderBy("valid_from")
    end_before = F.lag(F.coalesce("valid_to", F.lit("9999-12-31").cast("timestamp_ntz"))).over(in_time)
    return (
        history.withColumn("_end_before", end_before)
        .filter(F.col("valid_from") < F.col("_end_before"))
        .drop("_end_before")
    )


def as_of_version(facts: DataFrame, history: DataFrame, key: str, day: str) -> DataFrame:
    """Left join each fact to the version in force on its day (half-open validity); the history must be sound.

    A key's versions, at most one per day, come as one list in order, so that each fact is shuffled once and meets one row; versions
    are not repeated for the time they cover. The list is held in blocks of ``BLOCK`` versions, and a fact looks into the last block
    that has begun. Facts are read once; adaptive execution splits what a hot key leaves in one place, since the fact side of
    a left join can be split. That needs a history shuffled for the join, which the second join column sees to.
    """
    columns = [c for c in history.columns if c != key]
    sound = history.filter((F.col("valid_to") > F.col("valid_from")) | F.col("valid_to").isNull()).filter(
        F.col("valid_from").isNotNull() & F.col(key).isNotNull())
    # In order of the start, which comes first in the struct; no two versions of a sound history start together.
    version = F.struct("valid_from", *[c for c in columns if c != "valid_from"])
    listed = sound.groupBy(F.col(key).alias("_key")).agg(F.sort_array(F.collect_list(version)).alias("_all"))
    blocks = F.transform(F.sequence(F.lit(0), F.size("_all") - 1, F.lit(BLOCK)), lambda i: F.struct(
        F.get("_all", i)["valid_from"].alias("begun"), F.slice("_all", i + 1, F.lit(BLOCK)).alias("versions")))

    def side(c: str) -> Column:
        return F.pmod(F.hash(F.col(c)), F.lit(2)).cast("byte")

    met = facts.withColumn("_side", side(key)).join(
        listed.select("_key", side("_key").alias("_of"), blocks.alias("_blocks")),
        (F.col(key) == F.col("_key")) & (F.col("_side") == F.col("_of")), "left")
    block = F.try_element_at(F.filter("_blocks", lambda b: b["begun"] <= F.col(day)), F.lit(-1))["versions"]
    found = met.withColumn("_block", block).withColumn(
        "_found", F.try_element_at(F.filter("_block", lambda v: (v["valid_from"] <= F.col(day)) & (
            v["valid_to"].isNull() | (F.col(day) < v["valid_to"]))), F.lit(-1)))
    return found.select(*facts.columns, *[F.col(f"_found.{c}").alias(c) for c in columns])
