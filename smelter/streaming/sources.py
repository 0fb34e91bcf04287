"""Streaming sources and the bronze step."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Files of a micro-batch unless the caller says otherwise.
FILES_PER_TRIGGER = 1000


def file_stream(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet",
                files_per_trigger: int = FILES_PER_TRIGGER, **options) -> DataFrame:
    """New files under ``path``; the checkpoint remembers which were read.

    A micro-batch takes at most ``files_per_trigger`` files, so a backlog is worked off in batches.
    """
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    return reader.option("maxFilesPerTrigger", files_per_trigger).load(path)


def bronze_stream(files: DataFrame) -> DataFrame:
    """A file stream with lineage columns."""
    return files.select("*", F.current_timestamp().alias("_ingested_at"),
                        F.col("_metadata.file_path").alias("_source_file"))


def kafka_stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Needs Spark's Kafka connector on the class path."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).options(**options).load())


def parse_messages(messages: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Fields of JSON message values, with key, time and whether the value could be read."""
    parsed = messages.select(
        F.col("key").cast("string").alias("_key"),
        F.col("timestamp").alias("_message_at"),
        F.col("value").cast("string").alias("_value"),
    ).withColumn("_parsed", F.from_json("_value", schema))
    names = parsed.schema["_parsed"].dataType.fieldNames()
    any_field = F.lit(False)
    for name in names:
        any_field = any_field | F.col(f"_parsed.{name}").isNotNull()
    return parsed.select("_key", "_message_at", "_parsed.*", any_field.alias("_dq_json_valid"))


def with_event_time(events: DataFrame, column: str = "ts") -> DataFrame:
    """Event time as TIMESTAMP: watermarks do not take TIMESTAMP_NTZ."""
    return events.withColumn(column, F.col(column).cast("timestamp"))
