"""Batch readers. Scans that feed bronze add lineage columns in the scan itself."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def all_strings(columns: Sequence[str]) -> T.StructType:
    """The bronze schema: keep every value as it came, type it in silver."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """For exploration: an extra pass over the data guesses the types."""
    return spark.read.csv(path, header=True, inferSchema=True)


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Fields that do not fit ``schema`` become NULL."""
    return spark.read.csv(path, header=True, schema=schema, mode="PERMISSIVE")


def read_json(spark: SparkSession, path: str | list[str], schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_any(spark: SparkSession, fmt: str, path: str | list[str] | None = None,
             schema: T.StructType | str | None = None, **options: Any) -> DataFrame:
    """Any format Spark has a reader for: csv, json, parquet, orc, xml, text, jdbc, ..."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def with_lineage(scan: DataFrame) -> DataFrame:
    """Add ``_ingested_at`` and ``_source_file``; call on a file scan, before anything else."""
    return scan.select("*", F.current_timestamp().alias("_ingested_at"),
                       F.col("_metadata.file_path").alias("_source_file"))


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")
