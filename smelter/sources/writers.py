"""Batch writers: modes, partitioned and bucketed layouts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_parquet(df: DataFrame, path: str, mode: str = "error", partition_by: Sequence[str] = ()) -> None:
    """``mode``: overwrite, append, error or ignore."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Overwrite only the partitions that ``df`` has rows for."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def write_by_partition(df: DataFrame, path: str, partition_by: Sequence[str], mode: str = "overwrite") -> None:
    """Few files per partition: rows are first brought together by partition value.

    Rebalancing, unlike repartitioning, splits a partition value that holds much more
    than the others over several tasks.
    """
    df.hint("rebalance", *partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)


def save_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, mode: str = "overwrite",
                  path: str | None = None) -> None:
    """A catalog table bucketed and sorted by ``keys``: joins on them need no shuffle.

    Rows are first brought together by bucket, so that each bucket is one file. With ``path`` its files lie there
    and stay when the table is dropped.
    """
    dealt = df.repartition(buckets, *keys)
    writer = dealt.write.mode(mode).bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def append_to_table(df: DataFrame, name: str) -> None:
    """Insert by position into an existing catalog table."""
    columns = df.sparkSession.table(name).columns
    df.select(*columns).write.insertInto(name)
