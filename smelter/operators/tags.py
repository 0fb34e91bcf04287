"""Tagging texts with labels for the substrings they contain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values: (substrings, label) of API calls, in label order. A text gets the
# label when it contains any of the substrings.
SESSION_LABELS = (
    (("SparkSession.builder",), "SparkSession.builder (builder pattern)"),
    ((".appName(",), ".appName() — set application name"),
)
API_LABELS = (
    ((".getOrCreate()",), ".getOrCreate() — create or reuse session"),
    (("spark.read",), "spark.read — batch data reader"),
    (("spark.readStream",), "spark.readStream — streaming reader"),
    ((".write.", ".save("), "DataFrame.write — output writer"),
    ((".groupBy(",), ".groupBy() — aggregation"),
    ((".join(",), ".join() — combining DataFrames"),
    ((".filter(", ".where("), ".filter() / .where() — row filtering"),
    ((".withColumn(",), ".withColumn() — add/replace column"),
    (("createDataFrame",), "spark.createDataFrame() — create from local data"),
)
# Patterns that name something, and the label for each name found.
CONFIG_KEY = r"""\.config\(['"]([^'"]+)['"]"""
CONFIG_LABEL = ".config('%s', ...) — configuration key"
CLASS_NAME = r"class\s+(\w+)"
CLASS_LABEL = "class %s — define a class"
FUNCTION_NAME = r"def\s+(\w+)"
FUNCTION_LABEL = "def %s() — define a function"
CONSTRUCTOR = "__init__"


def _fixed(text: Column, labels) -> Column:
    return F.array_compact(F.array(*[
        F.when(F.exists(F.array(*map(F.lit, parts)), text.contains), F.lit(label)) for parts, label in labels
    ]))


def _named(text: Column, pattern: str, label: str) -> Column:
    names = F.regexp_extract_all(text, F.lit("(?U)" + pattern), F.lit(1))
    return F.transform(F.filter(names, lambda n: n != CONSTRUCTOR) if label == FUNCTION_LABEL else names,
                       lambda n: F.format_string(label, n))


def labels_of(text: Column) -> Column:
    """All labels of a text, in a fixed order; an empty array when there are none."""
    none = F.array().cast("array<string>")
    has_class = text.contains("class ")
    labels = F.concat(
        _fixed(text, SESSION_LABELS),
        F.when(text.contains(".config("), _named(text, CONFIG_KEY, CONFIG_LABEL)).otherwise(none),
        _fixed(text, API_LABELS),
        F.when(has_class, _named(text, CLASS_NAME, CLASS_LABEL)).otherwise(none),
        F.when(~has_class & text.contains("def "), _named(text, FUNCTION_NAME, FUNCTION_LABEL)).otherwise(none),
    )
    return F.coalesce(labels, none)


def tag(df: DataFrame, text: str) -> DataFrame:
    """One row per (text, label), with the label's position in the text's list."""
    kept = [c for c in df.columns if c != text]
    return df.select(*kept, F.posexplode(labels_of(F.col(text))).alias("position", "label"))
