"""Line deduplication: lines that many documents share stay in one of them only.

Lines are exploded with their positions, and those long enough are kept as 128-bit hashes of their keys. Per hash the
distinct documents are counted, in two steps that both combine before their shuffle. Hashes over the threshold go back to the
lines, heavy ones apart from the others, and give the positions that each document loses. The document is put together
from the runs of lines between them. Texts are shuffled once, to meet their positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.llm.apart import join_heavy_apart
from smelter.operators.lineage import cut_lineage, remove_scratch, scratch_folder

#: What is stripped from both ends of a line to make its key.
BLANKS = " \t\n\x0b\x0c\r"
MIN_CHARS = 40
MIN_DOCS = 5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    r"""The lines of a text, cut at ``\n``; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z lower-cased."""
    bare = F.btrim(line, F.lit(BLANKS))
    ascii_only = F.octet_length(bare) == F.length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def _row_key(doc_id: Column, text: Column) -> Column:
    """Tells rows of one doc_id apart by their texts."""
    return F.xxhash64(doc_id.cast("string"), text)


def _long_lines(rows: DataFrame, min_chars: int) -> DataFrame:
    """doc_id, row, position and the two halves of the key's hash, for every line whose key is long enough."""
    cut = rows.select("doc_id", "row", F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    # A key is never longer than its line, so short lines need no key.
    keyed = cut.filter(F.length("line") >= min_chars).select("doc_id", "row", "pos", line_key(F.col("line")).alias("key"))
    return keyed.filter(F.length("key") >= min_chars).select(
        "doc_id", "row", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def _shared(lines: DataFrame, min_docs: int) -> DataFrame:
    """Hashes in enough documents, the document that keeps them, and how many lines have them."""
    found = lines.groupBy("h1", "h2").agg(
        (F.count_distinct("doc_id") + F.max(F.when(F.col("doc_id").isNull(), 1).otherwise(0))).alias("docs"),
        F.max("doc_id").alias("keeper"), F.count(F.lit(1)).alias("n_lines"))
    return found.filter(F.col("docs") >= min_docs).select("h1", "h2", "keeper", "n_lines")


def _between(lines: Column, dropped: Column) -> Column:
    """The lines but those at the ``dropped`` positions (ascending), taken as the runs between them."""
    starts = F.concat(F.array(F.lit(0)), F.transform(dropped, lambda p: p + 1))
    ends = F.concat(dropped, F.array(F.size(lines)))
    return F.flatten(F.zip_with(starts, ends, lambda s, e: F.slice(lines, s + 1, e - s)))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
                min_docs: int = MIN_DOCS) -> DataFrame:
    r"""doc_id, text (what is left), n_lines (before) and n_dropped of every row.

    A line whose key has at least ``min_chars`` code points and occurs in at least ``min_docs`` documents is dropped, wherever it
    stands, from all documents but that with the largest id among them; there all its repeats stay. Other lines stay, joined
    by ``\n``. A document whose every line goes has an empty text.

    A null or empty text is one empty line and gives an empty text. Rows that repeat an id count as one document and stay rows
    of their own, each with its own lines; rows without an id count as one document, smaller than all others. An empty
    table gives no rows; further columns are left out. Hashes of keys have 128 bits.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                       _row_key(F.col(doc_id), F.col(text)).alias("row"))
    folder = scratch_folder(spark)
    _long_lines(rows, min_chars).write.parquet(folder)
    lines = spark.read.parquet(folder)
    shared = cut_lineage(_shared(lines, min_docs))
    lost = join_heavy_apart(lines, shared, ["h1", "h2"], "n_lines").filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    dropped = cut_lineage(lost.groupBy("doc_id", "row").agg(F.array_sort(F.collect_set("pos")).alias("dropped")))
    remove_scratch(spark, folder)

    gone = dropped.select(F.col("doc_id").alias("_doc_id"), F.col("row").alias("_row"), "dropped")
    met = rows.join(gone, rows["doc_id"].eqNullSafe(gone["_doc_id"]) & (rows["row"] == gone["_row"]), "left")
    lines_now = met.select("doc_id", lines_of(F.col("text")).alias("lines"),
                           F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"))
    return lines_now.select(
        "doc_id", F.array_join(_between(F.col("lines"), F.col("dropped")), "\n").alias("text"),
        F.size("lines").cast("bigint").alias("n_lines"), F.size("dropped").cast("bigint").alias("n_dropped"))
