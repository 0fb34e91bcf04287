"""A training corpus from documents: five stages, each one operator over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame; all but the last give the columns of
documents. ``run`` writes what a stage gives to the session's shared folder and reads it again for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.llm import bpe, decontam, langid, ngram_join, pii
from smelter.llm.keys import drop_keys, keep_keys
from smelter.operators.lineage import cut_lineage, scratch_folder
from smelter.sources.readers import table

RANKS = "byte_bpe_multi_50k.tiktoken"


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told by compression; those without letters or with too narrow a margin go."""
    found = langid.identify(docs, langid.fit_dictionaries(docs))
    return found.filter("accepted").select(*docs.columns)


def text_key(text: Column) -> Column:
    """16 bytes of a digest of the text; null for null."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group that shares 80 of 100 five-word shingles, link by link, one row: that with the smallest id.

    Rows are told apart by id and text, so rows that repeat an id are linked by their texts alone. Null ids come
    after all others; of equal ids the smallest digest of the text stays, and of rows equal in both
    the smallest by the other columns. Documents without words stay.
    """
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), text_key(F.col("text")).alias("key"))
    keyed = docs.withColumn("_row", order)
    groups = cut_lineage(ngram_join.jaccard_groups(keyed, doc_id="_row", n=5, needed=80, out_of=100).filter("n_shingles > 0"))
    others = groups.filter("component_id <> doc_id").select(F.col("doc_id").alias("_row")).distinct()
    repeated = groups.filter("component_id = doc_id").groupBy(F.col("doc_id").alias("_row")).agg(
        F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("_row")
    single = drop_keys(keyed, others.unionByName(repeated), key="_row")
    first = keep_keys(keyed, repeated, key="_row").groupBy("_row").agg(F.min(F.struct(*docs.columns)).alias("first"))
    return single.select(*docs.columns).unionByName(first.select("first.*"))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose own text contains no item of the benchmark, whatever the ids of both and however short the item."""
    keyed = docs.withColumn("_text", text_key(F.col("text")))
    found = decontam.find_contained(keyed, table(spark, sf_dir, "benchmark"), doc_id="_text")
    leaks = decontam.contaminated_ids(found).withColumnRenamed("doc_id", "_text")
    return drop_keys(keyed, leaks, key="_text").select(*docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every span of personal data replaced by its kind; n_chars follows."""
    text = pii.personal_data(F.col("text"))["masked"]
    masked = docs.withColumn("text", text)
    return masked.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether they decode to the text again."""
    path = public_tokenizers.path(RANKS)
    encoded = bpe.encode(docs, path, public_tokenizers.PATTERN, decoded=True)
    return encoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids",
        F.sha2("decoded", 256).alias("text_sha256"))


STAGES = [
    ("language_id", keep_identified),
    ("ngram_join", keep_one_of_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("pii", mask_personal_data),
    ("bpe", tokenize),
]

#: Compression, a trained field and a tokenizer's merges have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = f"{scratch_folder(spark)}-{name}"
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
