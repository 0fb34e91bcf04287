"""Grouped summaries, two-phase salted sums, profiles and normalisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.operators.joins import join_null_safe


def product_summary(df: DataFrame, product: str, total: str) -> DataFrame:
    """Row count, revenue and average order value per product."""
    return df.groupBy(product).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum(total).alias("total_revenue"),
        F.avg(total).alias("avg_order_value"),
    )


def summary_parts(df: DataFrame, keys: Sequence[str], total: str) -> DataFrame:
    """Counts and sums that can be added up again over coarser keys."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), F.count(total).alias("_values"), F.sum(total).alias("_sum")
    )


def summary_from_parts(parts: DataFrame, product: str) -> DataFrame:
    """The product summary of the rows behind ``parts``."""
    return parts.groupBy(product).agg(
        F.sum("_rows").alias("order_count"),
        F.sum("_sum").alias("total_revenue"),
        F.try_divide(F.sum("_sum"), F.sum("_values")).alias("avg_order_value"),
    )


def salted_sum(df: DataFrame, keys: Sequence[str], row_key: Sequence[str], value: str, name: str,
               salts: int = 64) -> DataFrame:
    """Sum, count and average of ``value`` in two phases that spread a hot key.

    The salt comes from a hash of the row's own key, so a re-run task gives the same one.
    """
    salt = F.pmod(F.xxhash64(*row_key), F.lit(salts))
    partial = summary_parts(df.withColumn("_salt", salt), [*keys, "_salt"], value)
    return partial.groupBy(*keys).agg(
        F.sum("_sum").alias(name),
        F.sum("_rows").alias("row_count"),
        F.try_divide(F.sum("_sum"), F.sum("_values")).alias(f"avg_{name}"),
    )


def share_of_max(df: DataFrame, value: str, name: str) -> DataFrame:
    """``value`` over the largest value of the whole table."""
    return df.withColumn(name, F.try_divide(F.col(value), df.agg(F.max(value)).scalar()))


def share_of_group_max(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """``value`` over the largest value of its group.

    The maximum is aggregated first and joined back, so a hot group is never sorted
    or collected in one task; how to join it is left to adaptive execution.
    """
    top = df.groupBy(*keys).agg(F.max(value).alias("_max"))
    joined = join_null_safe(df, top, keys)
    return joined.select(*df.columns, F.try_divide(value, "_max").alias(name))


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per numeric column: count, nulls, mean, sample deviation, min, max; one pass."""
    def stats(c: str) -> Column:
        v = F.col(c).cast("double")
        return F.struct(
            F.lit(c).alias("column_name"),
            F.count(v).alias("n"),
            F.count_if(v.isNull()).alias("n_null"),
            F.avg(v).alias("mean"),
            F.stddev_samp(v).alias("stddev"),
            F.min(v).alias("min"),
            F.max(v).alias("max"),
        )

    return df.agg(F.array(*[stats(c) for c in columns]).alias("_stats")).select(F.inline("_stats"))
