"""Keeping or dropping documents by a table of their keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.operators.lineage import cut_lineage

#: Keys are sent to the scan of the documents below this size; beyond it, both sides are shuffled.
BROADCAST_BYTES = 16 * 1024 * 1024
KEY_BYTES = 64


def sendable(keys: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Stored keys of a few fixed-size columns, marked for broadcast if their counted size allows it."""
    stored = cut_lineage(keys)
    return F.broadcast(stored) if stored.count() * KEY_BYTES <= limit else stored


def drop_keys(docs: DataFrame, keys: DataFrame, key: str = "doc_id", limit: int = BROADCAST_BYTES) -> DataFrame:
    """The rows whose key is not among ``keys`` (one column of distinct values; null equals null)."""
    gone = sendable(keys.select(F.col(key).alias("_gone")), limit)
    return docs.join(gone, docs[key].eqNullSafe(gone["_gone"]), "left_anti").select(*docs.columns)


def keep_keys(docs: DataFrame, keys: DataFrame, key: str = "doc_id", limit: int = BROADCAST_BYTES) -> DataFrame:
    """The rows whose key is among ``keys`` (one column of distinct values; null equals null)."""
    kept = sendable(keys.select(F.col(key).alias("_kept")), limit)
    return docs.join(kept, docs[key].eqNullSafe(kept["_kept"]), "left_semi").select(*docs.columns)
