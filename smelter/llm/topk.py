"""Exact top-k by inner product in three phases with a uniform threshold.

A vector's components are cut into groups; the score of a pair is the sum of one partial score
per group, and each (block of rows, group) is a node with its own list of partial scores.

1. Every node gives its best entries per query and its smallest partial score. The pairs in those
   lists are scored in full; the k-th best of them is a score that the result cannot fall below.
2. That score, less the sums of the smallest partials, is spread evenly over the groups: a pair whose
   partials all lie under the cutoff cannot reach it. Each node gives the entries at or over the cutoff,
   without those whose upper bound (cutoffs stand for missing partials) stays under the floor.
3. The partials that are still missing are computed for those entries, and the best k are kept.

Row blocks and query blocks meet by an equi-join on the pair of block numbers, so a task holds one
block of each, whatever the size of the table.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from smelter.operators.lineage import cut_lineage

GROUPS = 4
BLOCK_ROWS = 4096
QUERY_ROWS = 512
#: Vectors with a scaled component beyond this are wide: their scores could leave bigint, so they are taken in Python's integers.
LARGEST = float(2 ** 28)
#: Scores have so many digits at most while they are compared; beyond that they tie. Given out, they end where bigint does.
DIGITS = 38

PAIR_TYPE = "query_id bigint, vec_id bigint, score bigint"
WIDE_TYPE = f"query_id bigint, vec_id bigint, score decimal({DIGITS},0)"


def takes_part(embedding: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers; an empty one is."""
    finite = F.forall(embedding, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    return F.coalesce(finite, F.lit(False))


def is_wide(embedding: Column, scale: int = 1024) -> Column:
    return F.exists(embedding, lambda x: F.abs(x.cast("double")) * scale > LARGEST)


def scaled(embedding: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of every component as bigint, of a vector that is not wide."""
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * scale))


def _integers(embedding: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of every component in Python's integers; exact, as every double is a fraction."""
    out = np.empty(len(embedding), object)
    for i, x in enumerate(embedding):
        numerator, denominator = float(x).as_integer_ratio()
        out[i] = scale * numerator // denominator
    return out


def _blocked(vectors: DataFrame, rows: int, name: str) -> tuple[DataFrame, Column]:
    """Vectors with a block number that follows from id and components, about ``rows`` to a block; all numbers."""
    blocks = max(1, -(-vectors.count() // rows))
    number = F.pmod(F.xxhash64("vec_id", "parts"), F.lit(blocks)).cast("int")
    return vectors.withColumn(name, number), F.sequence(F.lit(0), F.lit(blocks - 1))


def _matrix(frame: pd.DataFrame, width: int) -> np.ndarray:
    """Components as exact floats, short vectors filled up with zeros."""
    out = np.zeros((len(frame), width))
    for i, parts in enumerate(frame["parts"]):
        out[i, :len(parts)] = parts
    return out


def _partials(left: pd.DataFrame, right: pd.DataFrame, groups: int) -> np.ndarray:
    """Partial scores: group, query, row. Sums beyond 2**53 are taken in integers instead of floats."""
    width = max(1, max(map(len, left["parts"])), max(map(len, right["parts"])))
    a, b = _matrix(left, width), _matrix(right, width)
    if np.abs(a).max() * np.abs(b).max() * width >= 2 ** 53:
        a, b = a.astype(np.int64), b.astype(np.int64)
    cuts = np.linspace(0, width, groups + 1).astype(int)
    return np.stack([(a[:, s:e] @ b[:, s:e].T).astype(np.int64) for s, e in zip(cuts, cuts[1:])])


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding",
          scale: int = 1024, groups: int = GROUPS, block_rows: int = BLOCK_ROWS,
          query_rows: int = QUERY_ROWS) -> DataFrame:
    """The ``k`` best rows for each query: query_id, rank, vec_id, score; ties go to the smaller vec_id.

    A query's own row is any row with its id. Rows that repeat an id with the same or other components
    count as rows of their own; equal ids among the queries with equal components are one query, and of
    those with different components the smallest is taken. Null ids, null vectors and vectors with a null or
    non-finite component take no part. With fewer than ``k`` rows all are given; empty tables give no rows. Vectors of
    unequal length are compared as if filled up with zeros, so an empty vector scores 0. Further columns are left out.

    Pairs with a wide vector are scored in Python's integers, each block of the wide ones against all blocks of the other side;
    of a score outside bigint the end of bigint is given out, in the order of the true scores.
    """
    def taking_part(df: DataFrame) -> DataFrame:
        whole = df.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"))
        return whole.filter(F.col("vec_id").isNotNull() & takes_part(F.col("embedding"))).withColumn("wide", is_wide(F.col("embedding"), scale))

    every, distinct = taking_part(vectors), taking_part(queries).groupBy("vec_id").agg(
        F.min(F.struct("embedding", "wide")).alias("q")).select("vec_id", "q.*")

    def narrow(df: DataFrame) -> DataFrame:
        return df.filter(~F.col("wide")).select("vec_id", scaled(F.col("embedding"), scale).alias("parts"))

    rows, row_blocks = _blocked(narrow(every), block_rows, "row_block")
    asked, query_blocks = _blocked(narrow(distinct), query_rows, "query_block")
    best = _search(rows.withColumn("query_block", F.explode(query_blocks)), asked, row_blocks, k, groups)
    wide_rows, wide_queries = (df.filter("wide") for df in (every, distinct))
    pairs = [(side, queries_of) for side, queries_of in ((wide_rows, distinct), (every.filter(~F.col("wide")), wide_queries))
             if not (wide_rows if queries_of is distinct else wide_queries).isEmpty()]
    if not pairs:
        return best
    best = best.select("query_id", "vec_id", F.col("score").cast(f"decimal({DIGITS},0)").alias("score"))
    for side, queries_of in pairs:
        best = best.unionByName(_search_wide(side, queries_of, k, scale, block_rows, query_rows))
    low, high = (F.lit(x).cast(f"decimal({DIGITS},0)") for x in (-(1 << 63), (1 << 63) - 1))
    ranked = best.withColumn("rank", F.row_number().over(_by_score())).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", F.least(F.greatest("score", low), high).cast("bigint").alias("score"))


def _search_wide(rows: DataFrame, asked: DataFrame, k: int, scale: int, block_rows: int, query_rows: int) -> DataFrame:
    """The best pairs of each pair of blocks in exact integers."""
    most = 10 ** DIGITS - 1

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            ids, vectors = right["vec_id"].to_numpy(), [_integers(e, scale) for e in right["embedding"]]
            for own, embedding in zip(left["vec_id"], left["embedding"]):
                query = _integers(embedding, scale)
                scores = [(-min(max(int(sum(query[:len(v)] * v[:len(query)])), -most), most), int(i)) for i, v in zip(ids, vectors) if i != own]
                out += [(own, i, Decimal(-s)) for s, i in sorted(scores)[:k]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    dealt, row_blocks = _blocked(rows.withColumnRenamed("embedding", "parts"), block_rows, "row_block")
    wanted, query_blocks = _blocked(asked.withColumnRenamed("embedding", "parts"), query_rows, "query_block")
    pair = ["row_block", "query_block"]
    left = wanted.withColumnRenamed("parts", "embedding").withColumn("row_block", F.explode(row_blocks)).drop("wide")
    right = dealt.withColumnRenamed("parts", "embedding").withColumn("query_block", F.explode(query_blocks)).drop("wide")
    return left.groupBy(*pair).cogroup(right.groupBy(*pair)).applyInPandas(best, WIDE_TYPE)


def _search(dealt_rows: DataFrame, asked: DataFrame, row_blocks: Column, k: int, groups: int) -> DataFrame:
    dealt_queries = asked.withColumn("row_block", F.explode(row_blocks))
    nothing = pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
    pair = ["row_block", "query_block"]

    def local_lists(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """Per query: best local entries of each group, scored in full, and the smallest partials."""
        if left.empty or right.empty:
            return nothing.assign(smallest=None)
        partial = _partials(left, right, groups)
        ids, own = right["vec_id"].to_numpy(), left["vec_id"].to_numpy()
        full, smallest = partial.sum(axis=0), partial.min(axis=2)
        out = []
        for q in range(len(left)):
            others = np.flatnonzero(ids != own[q])
            if not len(others):
                continue
            best = set()
            for g in range(groups):
                scores = partial[g, q, others]
                best.update(others[np.argpartition(-scores, min(k, len(others)) - 1)[:k]].tolist())
            best = sorted(best)
            out.append(pd.DataFrame({"query_id": own[q], "vec_id": ids[best], "score": full[q, best],
                                     "smallest": [smallest[:, q].tolist()] * len(best)}))
        return pd.concat(out) if out else nothing.assign(smallest=None)

    lists = cut_lineage(dealt_queries.groupBy(*pair).cogroup(dealt_rows.groupBy(*pair)).applyInPandas(
        local_lists, f"{PAIR_TYPE}, smallest array<bigint>"))
    floors = (lists.withColumn("place", F.row_number().over(_by_score())).filter(F.col("place") <= k)
              .groupBy("query_id").agg(F.min("score").alias("lowest"), F.max("place").alias("places")))
    least = lists.groupBy("query_id").agg(*(F.min(F.get("smallest", F.lit(g))).alias(f"least_{g}") for g in range(groups)))
    cutoffs = floors.join(least, "query_id").select(
        F.col("query_id").alias("vec_id"), F.when(F.col("places") >= k, F.col("lowest")).alias("floor"),
        F.array(*(F.col(f"least_{g}") for g in range(groups))).alias("least"))
    with_cutoffs = asked.join(cutoffs, "vec_id").withColumn("row_block", F.explode(row_blocks))

    def sufficient(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """Entries at or over the uniform cutoff whose upper bound reaches the floor, scored in full."""
        if left.empty or right.empty:
            return nothing
        partial = _partials(left, right, groups)
        ids = right["vec_id"].to_numpy()
        out = []
        for q, (own, floor, least) in enumerate(zip(left["vec_id"], left["floor"], left["least"])):
            seen = np.ones((groups, len(ids)), dtype=bool)
            candidates = ids != own
            if not pd.isna(floor):
                floor, least = int(floor), [int(x) for x in least]
                spread = (floor - sum(least)) // groups
                cutoff = np.array([x + spread for x in least])[:, None]
                seen = partial[:, q] >= cutoff
                upper = np.where(seen, partial[:, q], cutoff).sum(axis=0)
                candidates &= seen.any(axis=0) & (upper >= floor)
            chosen = np.flatnonzero(candidates)
            known = np.where(seen[:, chosen], partial[:, q, chosen], 0).sum(axis=0)
            missing = np.where(seen[:, chosen], 0, partial[:, q, chosen]).sum(axis=0)
            scores = known + missing
            best = np.lexsort((ids[chosen], -scores))[:k]
            out.append(pd.DataFrame({"query_id": own, "vec_id": ids[chosen][best], "score": scores[best]}))
        return pd.concat(out)

    entries = with_cutoffs.groupBy(*pair).cogroup(dealt_rows.groupBy(*pair)).applyInPandas(sufficient, PAIR_TYPE)
    return (entries.withColumn("rank", F.row_number().over(_by_score())).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _by_score() -> WindowSpec:
    return Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
