"""A bounded sample of every group by hash, without bringing a group together."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Hashes under the cutoff are this many times as many as wanted, on average, so that enough are there.
SPARE = 4


def smallest_hashes(rows: DataFrame, group: str, most: int, hashed: str = "h", groups: int = 256) -> DataFrame:
    """The rows with the ``most`` smallest hashes of each of at most ``groups`` groups, those with the most distinct hashes.

    ``hashed`` holds 64-bit hashes. How many distinct ones a group has is estimated by sketches, which combine before their
    shuffle; only hashes below a cutoff that leaves a few times ``most`` of them are ranked. Rows of equal hash stay together.
    """
    sizes = rows.groupBy(group).agg(F.approx_count_distinct(hashed).alias("_distinct"))
    largest = sizes.orderBy(F.desc("_distinct"), group).limit(groups)
    # Hashes are spread evenly over all bigints: so far from the smallest one lie about SPARE * most of them.
    share = F.least(F.lit(1.0), SPARE * most / F.greatest(F.col("_distinct"), F.lit(1)))
    cutoffs = largest.select(F.col(group).alias("_group"), F.when(share >= 1, F.lit((1 << 63) - 1)).otherwise(
        (share * 2.0 ** 64 - 2.0 ** 63).cast("bigint")).alias("_cutoff"))
    under = rows.join(F.broadcast(cutoffs), (F.col(group) == F.col("_group")) & (F.col(hashed) <= F.col("_cutoff")))
    place = F.dense_rank().over(Window.partitionBy(group).orderBy(hashed))
    distinct = under.select(group, hashed).distinct().withColumn("_place", place).filter(F.col("_place") <= most)
    return under.join(F.broadcast(distinct), [group, hashed]).select(*rows.columns)
