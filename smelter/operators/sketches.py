"""Mergeable sketches: distinct counts stored once per period and combined over any range, and quantiles with a rank bound."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Registers of a sketch as a power of two; a sketch takes at most about so many bytes.
LG_REGISTERS = 12
#: Ranks are met within one in so many rows.
ACCURACY = 10_000


def error_bound(lg_registers: int = LG_REGISTERS) -> float:
    """Three relative standard deviations of an estimate from this many registers."""
    return 3 * 1.04 / (1 << lg_registers) ** 0.5


def distinct_sketches(df: DataFrame, keys: Sequence[str], value: str, name: str = "sketch",
                      lg_registers: int = LG_REGISTERS) -> DataFrame:
    """One sketch of the distinct values per key (usually a day and something else); NULL is no value.

    A sketch has a fixed size whatever it has seen, so hot keys combine to one before the shuffle.
    """
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, lg_registers).alias(name))


def merged_sketches(sketches: DataFrame, keys: Sequence[str], name: str = "sketch") -> DataFrame:
    """Sketches over coarser keys; periods may overlap, as a value seen twice counts once."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg(name).alias(name))


def estimate(sketch: Column | str) -> Column:
    """The distinct values a sketch stands for, within ``error_bound`` in 99.7 of 100 cases."""
    return F.hll_sketch_estimate(sketch)


def quantile_profile(df: DataFrame, columns: Sequence[str], quantiles: Sequence[float] = (0.25, 0.5, 0.75),
                     accuracy: int = ACCURACY) -> DataFrame:
    """Column, quantile, value and rows (not NULL) of every numeric column and quantile, in one pass.

    A value's rank is within ``rows / accuracy`` of the quantile's. The sketches merge, and their size depends on the
    accuracy, not on the rows; a column without values has NULL quantiles.
    """
    points = [float(q) for q in quantiles]

    def one(c: str) -> Column:
        v = F.col(c).cast("double")
        found = F.percentile_approx(v, points, accuracy)
        return F.array(*(F.struct(F.lit(c).alias("column_name"), F.lit(q).alias("quantile"), F.get(found, F.lit(i)).alias("value"),
                                  F.count(v).alias("n")) for i, q in enumerate(points)))

    return df.agg(F.flatten(F.array(*map(one, columns))).alias("_found")).select(F.inline("_found"))


def rank_errors(df: DataFrame, profile: DataFrame) -> DataFrame:
    """The profile with ``rank_error``: how far each quantile's rank lies outside the ranks that its value has, over the rows.

    One more pass, which counts the rows below and up to each value.
    """
    found = profile.collect()
    kept = [(i, r) for i, r in enumerate(found) if r["value"] is not None]
    counts = [F.count_if(test(F.col(r["column_name"]).cast("double"), r["value"])).alias(f"{name}_{i}")
              for i, r in kept for name, test in (("below", Column.__lt__), ("upto", Column.__le__))]
    counted = df.agg(*counts).first() if kept else None
    rows = []
    for i, r in enumerate(found):
        rank = r["quantile"] * r["n"]
        outside = max(counted[f"below_{i}"] - rank, rank - counted[f"upto_{i}"], 0.0) if r["value"] is not None else None
        rows.append((*r, None if outside is None else outside / r["n"]))
    return df.sparkSession.createDataFrame(
        rows, "column_name string, quantile double, value double, n bigint, rank_error double")
