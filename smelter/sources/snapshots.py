"""Reading versions of a table whose snapshots are partitions, by a log of them.

The rows of snapshot n lie in ``_snapshot_id=n`` below a path. The log has a row per snapshot: its
``snapshot_id``, the ``base_id`` that it builds on (its own number when it replaced everything) and
``committed_at``. A snapshot consists of the partitions from its base up to itself. Only those are
read, so its schema is its own, whatever was committed before its base or after it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SNAPSHOT = "_snapshot_id"


def _rows(spark: SparkSession, path: str, log: DataFrame, condition: Column, what: str) -> DataFrame:
    newest = log.filter(condition).orderBy(F.desc("snapshot_id")).select("snapshot_id", "base_id").first()
    if newest is None:
        raise ValueError(f"no snapshot {what} in {path}")
    # One number per commit since the base.
    parts = log.filter(F.col("snapshot_id").between(newest["base_id"], newest["snapshot_id"])).select("snapshot_id").collect()
    folders = [f"{path}/{SNAPSHOT}={row[0]}" for row in sorted(parts)]
    return spark.read.option("mergeSchema", True).option("basePath", path).parquet(*folders).drop(SNAPSHOT)


def snapshot_rows(spark: SparkSession, path: str, log: DataFrame, number: int) -> DataFrame:
    """The rows of one snapshot, with the columns it had."""
    return _rows(spark, path, log, F.col("snapshot_id") == number, str(number))


def rows_as_of(spark: SparkSession, path: str, log: DataFrame, when: dt.datetime) -> DataFrame:
    """The rows of the newest snapshot committed at or before ``when``."""
    return _rows(spark, path, log, F.col("committed_at") <= F.lit(when), f"at {when}")


def evolve(df: DataFrame, renamed: dict[str, str] | None = None, dropped: tuple[str, ...] = ()) -> DataFrame:
    """Rename and drop columns at read time, without rewriting data."""
    return df.withColumnsRenamed(renamed or {}).drop(*dropped)


def with_bucket(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """A partition column ``_bucket`` from a hash of the key."""
    return df.withColumn("_bucket", F.pmod(F.hash(key), F.lit(buckets)))
