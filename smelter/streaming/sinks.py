"""Streaming sinks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from smelter.operators.dedup import latest_by_key
from smelter.operators.lineage import remove_scratch

# Partition column of the deltas.
BATCH = "_batch_id"


def start_files(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                trigger: dict | None = None) -> StreamingQuery:
    """Append to files, exactly once. ``trigger``: {'availableNow': True} by default,
    or for instance {'processingTime': '10 seconds'}."""
    return (stream.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start(path))


def start_batches(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
                  mode: str = "append", trigger: dict | None = None) -> StreamingQuery:
    """Hand every micro-batch to ``write``, which may see a batch again after a failure."""
    return (stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def upsert_into(path: str, keys: Sequence[str], order: Sequence[Column]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer that keeps the latest row per key of every batch as a delta of its own.

    A batch writes its own rows only, to its own folder, and a replayed batch writes that folder anew: nothing
    written before is touched, so a failure between two writes loses nothing. ``read_upserted`` merges.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        latest_by_key(batch, keys, order).write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return write


def read_upserted(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The latest row per key over all deltas; of equal ones the latest batch's counts."""
    deltas = spark.read.parquet(path)
    return latest_by_key(deltas, keys, [*order, F.desc(BATCH)]).drop(BATCH)


def compact_upserted(spark: SparkSession, path: str, target: str, keys: Sequence[str], order: Sequence[Column]) -> None:
    """All deltas merged into one in a new folder, which may take later batches; the old one stays as it is."""
    newest = spark.read.parquet(path).agg(F.max(BATCH)).first()[0]
    read_upserted(spark, path, keys, order).write.parquet(f"{target}/{BATCH}={newest}")


def _complete_batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches whose folder below ``path`` is complete."""
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    files = jvm.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = files.globStatus(jvm.Path(f"{path}/{BATCH}=*/_SUCCESS"))
    return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in done or ())


def totals_into(path: str, keep: int = 2) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer for complete mode: every batch writes its full result to a folder of its own.

    A replayed batch writes its folder anew. ``read_totals`` takes the newest folder whose write came to its end, so readers never
    see a half-written result; all but the newest ``keep`` are deleted after a batch, for readers that have begun on one.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")
        for old in _complete_batches(batch.sparkSession, path)[:-keep]:
            remove_scratch(batch.sparkSession, f"{path}/{BATCH}={old}")

    return write


def read_totals(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete result below ``path``."""
    done = _complete_batches(spark, path)
    if not done:
        raise ValueError(f"no complete batch in {path}")
    return spark.read.parquet(f"{path}/{BATCH}={done[-1]}")


# Partition column of rows that came behind the watermark.
LATE = "_is_late"


def split_late_into(path: str, delay: str, time: str = "ts") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer that keeps rows behind the watermark apart instead of losing them.

    The watermark of a batch is the greatest time of all batches before it less ``delay`` (say '10 minutes'), as the engine's own
    is. It is stored with each batch, so a replayed batch splits alike, and a batch is written once, in one pass. Rows without
    a time are on time. ``read_split`` gives both sides.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = [n for n in _complete_batches(spark, f"{path}/progress") if n < batch_id]
        newest = spark.read.parquet(f"{path}/progress/{BATCH}={known[-1]}").first()[0] if known else None
        kind = batch.schema[time].dataType
        bound = F.lit(newest).cast(kind) - F.expr(f"INTERVAL {delay}")
        seen = Observation(f"batch-{batch_id}")
        split = batch.withColumn(LATE, F.coalesce(F.col(time) < bound, F.lit(False))).observe(seen, F.max(time).alias("newest"))
        split.write.mode("overwrite").partitionBy(LATE).parquet(f"{path}/rows/{BATCH}={batch_id}")
        top = max((t for t in (newest, seen.get["newest"]) if t is not None), default=None)
        (spark.createDataFrame([(top,)], T.StructType([T.StructField("newest", kind)])).coalesce(1)
         .write.mode("overwrite").parquet(f"{path}/progress/{BATCH}={batch_id}"))

    return write


def read_split(spark: SparkSession, path: str, late: bool) -> DataFrame:
    """The rows that came in time, or those that came behind the watermark, of all batches."""
    return spark.read.parquet(f"{path}/rows").filter(F.col(LATE) == late).drop(LATE, BATCH)
