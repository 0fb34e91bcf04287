"""Reading only what earlier runs have not read."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from smelter.operators.joins import join_null_safe


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """One row per file; the files' content is not read."""
    files = spark.read.format("binaryFile").options(pathGlobFilter=pattern, recursiveFileLookup=True).load(path)
    return files.select(F.col("_metadata.file_path").alias("_source_file"),
                        F.col("_metadata.file_modification_time").alias("_modified_at"))


def new_files(files: DataFrame, processed: DataFrame) -> DataFrame:
    """Files that no row of ``processed`` came from."""
    seen = processed.select("_source_file").distinct()
    return files.join(seen, "_source_file", "left_anti")


def read_unseen(spark: SparkSession, path: str, ledger: str, read: Callable[[DataFrameReader, str], DataFrame],
                pattern: str = "*", overlap: str = "1 hour") -> DataFrame:
    """Rows of the files below ``path`` that the ledger does not list, with ``_source_file`` and ``_modified_at``.

    ``read`` applies format, schema and options, for instance ``lambda reader, path: reader.schema(s).csv(path)``. Files older than
    the newest listed one by more than ``overlap`` are left out by the scan's own listing; of the others, those listed are
    left out by a join. The driver sees one time and no path. ``note_files`` lists what has been stored.
    """
    reader = spark.read.options(pathGlobFilter=pattern, recursiveFileLookup=True)
    listed = _ledger(spark, ledger)
    if listed is not None:
        since = F.max("_modified_at") - F.expr(f"INTERVAL {overlap}")
        newest = listed.agg(F.date_format(since, "yyyy-MM-dd'T'HH:mm:ss").alias("at"), since.alias("since")).first()
        reader = reader.option("modifiedAfter", newest["at"])
        listed = listed.filter(F.col("_modified_at") >= F.date_trunc("second", F.lit(newest["since"]))).select("_source_file").distinct()
    rows = read(reader, path).select("*", F.col("_metadata.file_path").alias("_source_file"),
                                     F.col("_metadata.file_modification_time").alias("_modified_at"))
    return rows if listed is None else rows.join(listed, "_source_file", "left_anti")


def note_files(stored: DataFrame, ledger: str) -> None:
    """Append the files that ``stored`` rows came from to the ledger; call it once the rows are safe.

    Rows stored whose files were not listed, because a run broke in between, are read again: store them by key or by run.
    """
    files = stored.groupBy("_source_file").agg(F.max("_modified_at").alias("_modified_at"), F.count(F.lit(1)).alias("n_rows"))
    files.write.mode("append").parquet(ledger)


def _ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """The files listed so far; None before the first."""
    try:
        listed = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return None if listed.isEmpty() else listed


def rows_since(source: DataFrame, target: DataFrame, column: str, keys: Sequence[str] = ()) -> DataFrame:
    """Source rows strictly newer than the newest row of ``target``; all timed ones when it has none.

    Rows without a time cannot be told from loaded ones by it. With ``keys`` those whose keys ``target`` has no untimed row
    of are taken as well; without, they are left out.
    """
    loaded = target.filter(F.col(column).isNotNull())
    # A bare comparison with the subquery, so that it reaches the scan as a filter.
    timed = source.filter(F.col(column).isNotNull() if loaded.isEmpty() else F.col(column) > loaded.agg(F.max(column)).scalar())
    if not keys:
        return timed
    untimed = source.filter(F.col(column).isNull())
    known = target.filter(F.col(column).isNull()).select(*keys).distinct()
    return timed.unionByName(join_null_safe(untimed, known, keys, "left_anti"))


def rows_since_with_overlap(source: DataFrame, target: DataFrame, column: str, keys: Sequence[str],
                            overlap: str) -> DataFrame:
    """As ``rows_since``, but looks back by ``overlap`` (say '2 hours') for late rows.

    Rows of the overlap and rows without a time that the target already has, by ``keys``, are left out.
    """
    loaded = target.filter(F.col(column).isNotNull())
    if loaded.isEmpty():
        return source.join(target.select(*keys), list(keys), "left_anti")
    back_to = loaded.agg(F.max(column) - F.expr(f"INTERVAL {overlap}")).scalar()
    open_still = (F.col(column) > back_to) | F.col(column).isNull()
    return source.filter(open_still).join(target.filter(open_still).select(*keys), list(keys), "left_anti")
