"""Window functions that keep working when one group holds most of the rows.

Each function uses the plain Spark window as long as every group fits a task, which
one cheap count per group decides, and otherwise runs it per block (see ``blocks``).
Positions are bigint either way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smelter.operators.blocks import HOT_ROWS, hot_groups, split_hot
from smelter.operators.joins import join_null_safe
from smelter.operators.lineage import cut_lineage

# Largest group whose trailing sums Spark takes row by row. Every row adds up its whole
# frame there, so this is lower than for windows that look at each row once.
TRAILING_HOT_ROWS = 100_000
# Length in seconds of the pieces in which trailing sums of a hot group are taken.
CHUNK_SECONDS = 86_400


def _with_carry(blocked: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each row with what the blocks before and after its own contribute: one row per block."""
    return join_null_safe(blocked, carry, [*keys, "_block"], "left")


def _before(keys: Sequence[str]) -> Window:
    return Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)


def running_total(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str,
                  hot_rows: int = HOT_ROWS) -> DataFrame:
    """Sum of ``value`` from the group's first row to this one; ``order`` must be unique."""
    upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    parts = split_hot(df, keys, order, hot_rows)
    if parts is None:
        return df.withColumn(name, F.sum(value).over(upto))
    cold, hot = parts
    in_block = Window.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    carry = hot.groupBy(*keys, "_block").agg(F.sum(value).alias("_sum")).select(
        *keys, "_block", F.sum("_sum").over(_before(keys)).alias("_carry"))
    local = hot.withColumn("_local", F.sum(value).over(in_block))
    # NULL only while neither this block nor an earlier one has had a value.
    total = F.coalesce(F.col("_local") + F.col("_carry"), "_local", "_carry")
    placed = _with_carry(local, carry, keys).select(*df.columns, total.alias(name))
    return cold.withColumn(name, F.sum(value).over(upto)).unionByName(placed)


def neighbours(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, before: str, after: str,
               hot_rows: int = HOT_ROWS) -> DataFrame:
    """``value`` of the previous and the next row of the group; ``order`` must be unique."""
    in_order = Window.partitionBy(*keys).orderBy(*order)
    beside = {before: F.lag(value).over(in_order), after: F.lead(value).over(in_order)}
    parts = split_hot(df, keys, order, hot_rows)
    if parts is None:
        return df.withColumns(beside)
    cold, hot = parts
    block = Window.partitionBy(*keys, "_block")
    in_block = block.orderBy(*order)
    across = Window.partitionBy(*keys).orderBy("_block")
    position = F.struct(*order)
    carry = (
        hot.groupBy(*keys, "_block").agg(
            F.min_by(F.struct(value), position).alias("_first"),
            F.max_by(F.struct(value), position).alias("_last"))
        .select(*keys, "_block",
                F.lag(f"_last.{value}").over(across).alias("_before"),
                F.lead(f"_first.{value}").over(across).alias("_after"))
    )
    local = hot.withColumns({
        "_n": F.row_number().over(in_block),
        "_of": F.count(F.lit(1)).over(block),
        before: F.lag(value).over(in_block),
        after: F.lead(value).over(in_block),
    })
    placed = _with_carry(local, carry, keys).select(
        *df.columns,
        F.when(F.col("_n") == 1, F.col("_before")).otherwise(F.col(before)).alias(before),
        F.when(F.col("_n") == F.col("_of"), F.col("_after")).otherwise(F.col(after)).alias(after),
    )
    return cold.withColumns(beside).unionByName(placed)


def _long_positions(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in ("row_number", "rank", "dense_rank")})


def _ranked(df: DataFrame, keys: Sequence[str], by: str, order: Column, tie: Column, tiles: int) -> DataFrame:
    in_order = Window.partitionBy(*keys).orderBy(order)
    unique = Window.partitionBy(*keys).orderBy(order, tie)
    return _long_positions(df.withColumns({
        "row_number": F.row_number().over(unique),
        "rank": F.rank().over(in_order),
        "dense_rank": F.dense_rank().over(in_order),
        "percent_rank": F.percent_rank().over(in_order),
        "ntile": F.ntile(tiles).over(unique),
        "cume_dist": F.cume_dist().over(in_order),
    }))


def _ranked_in_blocks(hot: DataFrame, keys: Sequence[str], by: str, order: Column, tie: Column,
                      tiles: int) -> DataFrame:
    """All ranks of rows in blocks, from counts per block and per value.

    A value may run through several blocks. Its rank follows from the block where it begins, and
    how many rows lie up to it from the block where it ends; such values are at most as many as blocks.
    """
    in_block = Window.partitionBy(*keys, "_block")
    values = hot.groupBy(*keys, "_block", by).agg(F.count(F.lit(1)).alias("_n"))
    blocks = values.groupBy(*keys, "_block").agg(F.sum("_n").alias("_in"), F.count(F.lit(1)).alias("_d"))
    before = blocks.select(*keys, "_block", "_in", "_d",
                           F.coalesce(F.sum("_in").over(_before(keys)), F.lit(0)).alias("_n_before"))
    spans = (values.groupBy(*keys, by).agg(F.min("_block").alias("_lo"), F.max("_block").alias("_hi"))
             .filter("_lo < _hi"))
    at_lo = join_null_safe(spans.withColumnRenamed("_lo", "_block"), values, [*keys, "_block", by])
    at_lo = join_null_safe(at_lo, before, [*keys, "_block"]).select(
        *keys, by, (F.col("_n_before") + F.col("_in") - F.col("_n") + 1).alias("_span_rank"), F.col("_block").alias("_lo"))
    at_hi = join_null_safe(spans.withColumnRenamed("_hi", "_block"), values, [*keys, "_block", by])
    at_hi = join_null_safe(at_hi, before, [*keys, "_block"]).select(
        *keys, by, (F.col("_n_before") + F.col("_n")).alias("_span_upto"), F.col("_block").alias("_hi"))
    ranges = join_null_safe(at_lo, at_hi, [*keys, by])
    # A block that goes on with the value before it counts that value once more.
    again = ranges.select(*keys, F.explode(F.sequence(F.col("_lo") + 1, "_hi")).alias("_block"))
    again = again.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_again"))
    upto = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, 0)
    carry = join_null_safe(before, again, [*keys, "_block"], "left").select(
        *keys, "_block", "_n_before",
        (F.coalesce(F.sum("_d").over(_before(keys)), F.lit(0))
         - F.sum(F.coalesce("_again", F.lit(0))).over(upto)).alias("_d_before"))
    local = hot.withColumns({
        "_rn": F.row_number().over(in_block.orderBy(order, tie)),
        "_rk": F.rank().over(in_block.orderBy(order)),
        "_dr": F.dense_rank().over(in_block.orderBy(order)),
        "_upto": F.count(F.lit(1)).over(in_block.orderBy(order).rangeBetween(Window.unboundedPreceding, 0)),
    })
    placed = join_null_safe(_with_carry(local, cut_lineage(carry), keys),
                            cut_lineage(ranges.drop("_lo", "_hi")), [*keys, by], "left").withColumns({
        "row_number": F.col("_rn") + F.col("_n_before"),
        "rank": F.coalesce("_span_rank", F.col("_rk") + F.col("_n_before")),
        "dense_rank": F.col("_dr") + F.col("_d_before"),
        "cume_dist": F.coalesce("_span_upto", F.col("_upto") + F.col("_n_before")) / F.col("_rows"),
    })
    small = F.floor(F.col("_rows") / tiles)
    larger = F.col("_rows") % tiles
    in_larger = larger * (small + 1)
    tile = F.when(
        F.col("row_number") <= in_larger, F.floor((F.col("row_number") - 1) / (small + 1)) + 1
    ).otherwise(larger + F.floor((F.col("row_number") - 1 - in_larger) / F.greatest(small, F.lit(1))) + 1)
    return _long_positions(placed.withColumns({
        "percent_rank": F.when(F.col("_rows") > 1, (F.col("rank") - 1) / (F.col("_rows") - 1)).otherwise(F.lit(0.0)),
        "ntile": tile.cast("int"),
    }))


def rank_family(df: DataFrame, keys: Sequence[str], by: str, tie: str, tiles: int,
                hot_rows: int = HOT_ROWS) -> DataFrame:
    """All ranking functions over a column, ascending.

    ``row_number`` and ``ntile`` order ties by ``tie``, which makes the order unique; the others let ties share.
    """
    ranks = ["row_number", "rank", "dense_rank", "percent_rank", "ntile", "cume_dist"]
    order, last = F.asc(by), F.asc(tie)
    parts = split_hot(df, keys, [order, last], hot_rows)
    if parts is None:
        return _ranked(df, keys, by, order, last, tiles)
    cold, hot = parts
    return _ranked(cold, keys, by, order, last, tiles).unionByName(
        _ranked_in_blocks(hot, keys, by, order, last, tiles).select(*df.columns, *ranks))


def rank_all(df: DataFrame, by: str, name: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rank over the whole of ``df``, highest ``by`` first, ties sharing a rank.

    ``df`` is stored first, since it is usually an aggregate that would otherwise be
    computed once to count its rows and again to rank them.
    """
    stored = cut_lineage(df)
    whole = stored.withColumns({"_whole": F.lit(0), "_tie": F.monotonically_increasing_id()})
    parts = split_hot(whole, ["_whole"], [F.desc(by), F.asc("_tie")], hot_rows)
    if parts is None:
        return stored.withColumn(name, F.rank().over(Window.orderBy(F.desc(by))).cast("bigint"))
    ranked = _ranked_in_blocks(parts[1], ["_whole"], by, F.desc(by), F.asc("_tie"), 1)
    return ranked.select(*df.columns, F.col("rank").alias(name))


def trailing_sum(df: DataFrame, keys: Sequence[str], second: str, value: str, seconds: int, name: str,
                 hot_rows: int = TRAILING_HOT_ROWS) -> DataFrame:
    """Sum of ``value`` over the group's rows of the last ``seconds`` up to and with this second.

    A hot group is first summed per second, which combines before the shuffle, and cut
    into chunks that each also get the rows their frame reaches back to: no task holds
    more than one chunk plus one frame of seconds. The sums then join back per second.
    """
    frame = Window.partitionBy(*keys).orderBy(second).rangeBetween(-seconds, 0)
    hot = hot_groups(df, keys, hot_rows)
    if hot.agg(F.max("_rows")).first()[0] is None:
        return df.withColumn(name, F.sum(value).over(frame))
    marked = join_null_safe(df, cut_lineage(hot), keys, "left")
    cold = marked.filter(F.col("_rows").isNull()).drop("_rows").withColumn(name, F.sum(value).over(frame))
    hot_rows_only = marked.filter(F.col("_rows").isNotNull()).drop("_rows")
    length = max(CHUNK_SECONDS, seconds)
    chunk = F.floor(F.col(second) / length)
    last_chunk = F.floor((F.col(second) + seconds) / length)
    per_second = (
        hot_rows_only.filter(F.col(second).isNotNull())
        .groupBy(*keys, second).agg(F.sum(value).alias("_sum"))
        .withColumn("_chunk", F.explode(F.sequence(chunk, last_chunk)))
    )
    in_chunk = Window.partitionBy(*keys, "_chunk").orderBy(second).rangeBetween(-seconds, 0)
    sums = (
        per_second.withColumn(name, F.sum("_sum").over(in_chunk))
        .filter(F.col("_chunk") == chunk)
        .select(*keys, second, name)
    )
    # Rows without a time form a frame of their own, as in the plain window.
    untimed = hot_rows_only.filter(F.col(second).isNull())
    per_key = cut_lineage(untimed.groupBy(*keys).agg(F.sum(value).alias(name)))
    timed = join_null_safe(hot_rows_only.filter(F.col(second).isNotNull()), sums, [*keys, second])
    return (
        cold.unionByName(timed)
        .unionByName(join_null_safe(untimed, per_key, keys))
        .select(*df.columns, name)
    )


def _placed(hot: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows in blocks with ``_place``, their number (from 1) in their group."""
    counts = hot.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = cut_lineage(counts.select(*keys, "_block", F.coalesce(F.sum("_n").over(_before(keys)), F.lit(0)).alias("_n_before")))
    local = hot.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys, "_block").orderBy(*order)))
    return _with_carry(local, before, keys).withColumn("_place", F.col("_rn") + F.col("_n_before")).drop("_rn", "_n_before")


def moving_average(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, rows: int, name: str,
                   hot_rows: int = HOT_ROWS) -> DataFrame:
    """Mean of ``value`` over this row and the ``rows - 1`` before it in its group; ``order`` must be unique.

    A hot group is numbered through and cut into chunks of equal length, each with a halo: the last ``rows - 1`` rows of the chunk
    before it, which only serve its first frames. No task holds more than one chunk and its halo.
    """
    last = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-(rows - 1), 0)
    parts = split_hot(df, keys, order, hot_rows)
    if parts is None:
        return df.withColumn(name, F.avg(value).over(last))
    cold, hot = parts
    length = max(hot_rows, rows)
    place = F.col("_place") - 1
    chunk = F.floor(place / F.lit(length))
    served = F.when(F.pmod(place, F.lit(length)) > length - rows, F.array(chunk, chunk + 1)).otherwise(F.array(chunk))
    chunked = _placed(hot, keys, order).withColumn("_own", chunk).withColumn("_chunk", F.explode(served))
    in_chunk = Window.partitionBy(*keys, "_chunk").orderBy("_place").rowsBetween(-(rows - 1), 0)
    found = chunked.withColumn(name, F.avg(value).over(in_chunk)).filter(F.col("_own") == F.col("_chunk"))
    return cold.withColumn(name, F.avg(value).over(last)).unionByName(found.select(*df.columns, name))


def numbered(df: DataFrame, order: Sequence[str], name: str, block_rows: int = HOT_ROWS) -> DataFrame:
    """All rows numbered from 1 without gaps along ``order``, which must be unique.

    Rows are dealt to ranges and stored, counted per range, and numbered there; one small row per range carries how many come
    before it. No task sorts the table.
    """
    ranges = max(1, -(-df.count() // block_rows))
    dealt = df.repartitionByRange(ranges, *order)
    stored = cut_lineage(dealt.withColumns({"_block": F.spark_partition_id(), "_whole": F.lit(0)}))
    return _placed(stored, ["_whole"], order).withColumn(name, F.col("_place")).select(*df.columns, name)


def rows_per_partition(df: DataFrame) -> DataFrame:
    """How many rows each partition holds that has any, with its share of all rows: an audit of how ``df`` is dealt out."""
    counts = cut_lineage(df.groupBy(F.spark_partition_id().alias("partition_id")).agg(F.count(F.lit(1)).alias("n_rows")))
    return counts.withColumn("share", F.col("n_rows") / counts.agg(F.sum("n_rows")).scalar())
