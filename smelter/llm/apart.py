"""A join to a table of unique keys in which no key's rows meet in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key that holds more than one in so many of the counted rows is heavy; so there are at most so many heavy keys.
HEAVY_SHARE = 1 << 14


def join_heavy_apart(rows: DataFrame, keyed: DataFrame, on: list[str], weight: str, share: int = HEAVY_SHARE) -> DataFrame:
    """Inner join of ``rows`` with ``keyed``, whose keys are unique and never null; ``weight`` is left out.

    ``keyed`` is a stored table; its ``weight`` is how many of the rows hold the key. Keys with more than one ``share``-th of
    the total weight are fewer than ``share``, whatever the size of the tables, so they are sent to the rows. The others are
    joined by shuffle, where none of them can outgrow its task. ``rows`` is read twice.
    """
    total = keyed.agg(F.coalesce(F.sum(weight), F.lit(0)).cast("bigint").alias("n")).collect()[0]["n"]
    is_heavy = F.col(weight).cast("decimal(38,0)") * share > F.lit(total)
    heavy = F.broadcast(keyed.filter(is_heavy).drop(weight))
    light = keyed.filter(~is_heavy).drop(weight)
    rest = rows.join(heavy.select(*on), on, "left_anti")
    both = rows.join(heavy, on)
    return both.unionByName(rest.join(light, on))
