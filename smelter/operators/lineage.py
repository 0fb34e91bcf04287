"""Computing a DataFrame once for several uses: stored, or kept for the length of a block."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's shared checkpoint folder: ``spark.checkpoint.dir``, or one below the warehouse."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` computed once and stored where a lost executor cannot take it along."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def scratch_folder(spark: SparkSession) -> str:
    """A new folder for intermediate tables, next to the checkpoints."""
    return f"{ensure_checkpoint_dir(spark)}/smelter-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession, folder: str) -> None:
    """Delete a scratch folder that nothing reads any more, through the file system it lies in."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def kept(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """``df`` persisted inside a ``with`` block and released after it.

    For several actions on one input, such as the golds of one silver. What is lost
    with an executor is computed again.
    """
    held = df.persist(level)
    try:
        yield held
    finally:
        held.unpersist()
