"""The size of the Arrow batches in which texts reach Python, and memory that workers give back."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import SparkSession

Batch = TypeVar("Batch")

_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 * 1024 * 1024


def bound_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Let Arrow batches end after ``most`` bytes where the session allows more.

    Batches are cut by rows otherwise, and 10,000 long documents are more than a Python worker should hold.
    A session that has set fewer bytes keeps its own value.
    """
    now = spark.conf.get(_SETTING)
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    text = now.lower().rstrip("b")
    if int(text.rstrip("kmg")) * units.get(text[-1:], 1) > most:
        spark.conf.set(_SETTING, str(most))


def giving_back(batches: Iterator[Batch]) -> Iterator[Batch]:
    """``batches``, and after the last one the memory that making them took goes back to the system.

    A Python worker outlives its task and waits for the next stage; what it has freed would stay with it meanwhile.
    """
    yield from batches
    del batches
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
