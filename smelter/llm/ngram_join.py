"""N-gram Jaccard join: which texts share nearly all of their word n-grams, and the groups they form.

Texts with the same set of shingles form a class and count once. The shingles of a set are ordered rare first,
by a table of counts over all documents. Two sets over the threshold must share a shingle among the first few of
each (prefix filter; the smaller set needs an even shorter one), and that shingle's places and the sizes
bound how much they can share at all (length and positional filters). What is left is verified once per
pair, unless the counts of their hashes in parts of the hash space rule it out (suffix filter).

Copies by the thousand never become pairs of all with all. First each shingle's list is compared with one
of its sets only, the one with the fewest rarer shingles, which is nearest to what the others were copied
from. The links found there merge into components. Then only pairs of different components are left to
test, and those are all tested, so no link between components is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.llm.batches import bound_batches, giving_back
from smelter.llm.components import connected_components
from smelter.llm.hashing import chunks, distinct_per_text, shingle_hashes, word_hashes
from smelter.llm.keys import BROADCAST_BYTES, keep_keys
from smelter.operators.lineage import cut_lineage

#: Counters of the table that orders shingles; its size is fixed, so it can be sent to every task.
COUNTERS = 1 << 22
_SHIFT = np.uint64(64 - 22)
_SLICE = 1 << 16
#: Parts of the hash space in which a set's hashes are counted for the suffix filter.
PARTS = 64


def _text_sets(texts: list[str | None], n: int) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text, sorted."""
    for _, raws in chunks(texts):
        hashes, counts = distinct_per_text(*shingle_hashes(*word_hashes(raws), n))
        yield from np.split(hashes, np.cumsum(counts)[:-1])


def _digest(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def _strings(batch: pd.Series) -> list[str | None]:
    return [t if isinstance(t, str) else None for t in batch]


def _sets_and_counts(text: Column, n: int) -> Column:
    """Digest and size of each set; the last row of a task also has the counters of all its texts."""
    def seen(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counters, held = np.zeros(COUNTERS, np.uint32), None
        for batch in batches:
            if held is not None:
                yield held
            digests, sizes = [], []
            for shingles in _text_sets(_strings(batch), n):
                np.add.at(counters, (shingles >> _SHIFT).astype(np.int64), 1)
                digests.append(_digest(shingles))
                sizes.append(len(shingles))
            held = pd.DataFrame({"digest": digests, "size": sizes, "counted": [None] * len(batch)})
        if held is not None:
            if len(held):
                packer, kind = zstandard.ZstdCompressor(level=1), np.min_scalar_type(int(counters.max()))
                held.at[len(held) - 1, "counted"] = [
                    packer.compress(counters[i:i + _SLICE].astype(kind).tobytes()) for i in range(0, COUNTERS, _SLICE)]
            yield held

    @F.pandas_udf("digest binary, size bigint, counted array<binary>")
    def look(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from giving_back(seen(batches))

    # Not to be evaluated once more for a filter on its result.
    return look.asNondeterministic()(text)


def _order_table(seen: DataFrame) -> np.ndarray:
    """The counters of all tasks summed, in two steps of about equally many rows each."""
    parts = seen.filter("counted IS NOT NULL").select("digest", F.posexplode("counted").alias("slice", "packed"))
    tasks = parts.count() // (COUNTERS // _SLICE)
    salts = max(1, int(tasks ** 0.5))

    def added(frame: pd.DataFrame) -> pd.DataFrame:
        opener = zstandard.ZstdDecompressor()
        total = np.zeros(_SLICE, np.uint64)
        for packed in frame["packed"]:
            raw = opener.decompress(packed)
            total += np.frombuffer(raw, f"u{len(raw) // _SLICE}")
        return pd.DataFrame({"slice": [int(frame["slice"].iloc[0])],
                             "packed": [zstandard.ZstdCompressor(level=1).compress(total.tobytes())]})

    kind = "slice int, packed binary"
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("digest", "packed"), F.lit(salts)))
    summed = (salted.groupBy("slice", "salt").applyInPandas(added, kind).groupBy("slice").applyInPandas(added, kind)
              .collect())
    table = np.zeros(COUNTERS, np.uint64)
    for row in summed:
        table[row["slice"] * _SLICE:(row["slice"] + 1) * _SLICE] = np.frombuffer(
            zstandard.ZstdDecompressor().decompress(row["packed"]), np.uint64)
    return np.minimum(table, 2 ** 32 - 1).astype(np.uint32)


def prefix_length(size: np.ndarray | int, needed: int, out_of: int):
    """How many of its rarest shingles a set shows to larger or smaller ones."""
    return size - -(-needed * size // out_of) + 1


def _prefixes(text: Column, n: int, needed: int, out_of: int, table) -> Column:
    """Digest, size and the rarest shingles, rarest first, of each text that has any."""
    def shown(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counts = table.value
        for batch in batches:
            digests, sizes, grams, spreads = [], [], [], []
            for shingles in _text_sets(_strings(batch), n):
                most = prefix_length(len(shingles), needed, out_of) if len(shingles) else 0
                rarity = counts[(shingles >> _SHIFT).astype(np.int64)]
                digests.append(_digest(shingles))
                sizes.append(len(shingles))
                grams.append(shingles[np.argsort(rarity, kind="stable")[:most]].astype(np.int64))
                spreads.append(_spread(shingles))
            yield pd.DataFrame({"digest": digests, "size": sizes, "grams": grams, "spread": spreads})

    @F.pandas_udf("digest binary, size bigint, grams array<bigint>, spread binary")
    def look(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from giving_back(shown(batches))

    # Not to be evaluated once more for a filter on its result.
    return look.asNondeterministic()(text)


def _may_link(a: str, b: str, needed: int, out_of: int) -> Column:
    """Length and positional filters for two postings of one shingle."""
    def of(side: str, name: str) -> Column:
        return F.col(f"{side}_{name}")

    both = of(a, "size") + of(b, "size")
    most = F.least(of(a, "size") - of(a, "pos"), of(b, "size") - of(b, "pos"))
    a_smaller = F.struct(of(a, "size"), of(a, "digest")) < F.struct(of(b, "size"), of(b, "digest"))
    small_size, small_pos = (F.when(a_smaller, of(a, c)).otherwise(of(b, c)) for c in ("size", "pos"))
    return ((F.least(of(a, "size"), of(b, "size")) * out_of >= F.greatest(of(a, "size"), of(b, "size")) * needed)
            & (most * (needed + out_of) >= both * needed)
            & ((small_size - small_pos) * (needed + out_of) >= 2 * small_size * needed))


def _pairs(joined: DataFrame) -> DataFrame:
    """Each pair once, the smaller digest first."""
    return joined.select(F.least("a_digest", "b_digest").alias("a"), F.greatest("a_digest", "b_digest").alias("b")).distinct()


def _side(df: DataFrame, side: str) -> DataFrame:
    return df.select(*(F.col(c).alias(c if c == "gram" else f"{side}_{c}") for c in df.columns))


def _spread(shingles: np.ndarray) -> bytes:
    """How many hashes of a sorted set lie in each part of the hash space."""
    cuts = np.arange(1, PARTS, dtype=np.uint64) * np.uint64((1 << 64) // PARTS)
    return np.diff(np.concatenate(([0], np.searchsorted(shingles, cuts), [len(shingles)]))).astype(np.uint32).tobytes()


def _suffix_filter(pairs: DataFrame, prefixes: DataFrame, needed: int, out_of: int) -> DataFrame:
    """Pairs that can share enough: in each part of the hash space at most what the smaller has there."""
    @F.pandas_udf("boolean")
    def possible(left: pd.Series, right: pd.Series) -> pd.Series:
        a, b = (np.frombuffer(b"".join(x), np.uint32).reshape(-1, PARTS).astype(np.int64) for x in (left, right))
        both = a.sum(axis=1) + b.sum(axis=1)
        return pd.Series(np.minimum(a, b).sum(axis=1) * (needed + out_of) >= both * needed)

    spreads = prefixes.select("digest", "spread")
    seen = (pairs.join(spreads.select(F.col("digest").alias("b"), F.col("spread").alias("b_spread")), "b")
            .join(spreads.select(F.col("digest").alias("a"), F.col("spread").alias("a_spread")), "a"))
    return seen.filter(possible("a_spread", "b_spread")).select("a", "b")


def shares_enough(a: np.ndarray, b: np.ndarray, needed: int, out_of: int) -> bool:
    """Whether two sorted sets reach the threshold."""
    least = -(-needed * (len(a) + len(b)) // (needed + out_of))
    return len(np.intersect1d(a, b, assume_unique=True)) >= least


def _verify(pairs: DataFrame, docs: DataFrame, classes: DataFrame, prefixes: DataFrame, n: int, needed: int,
            out_of: int, broadcast_bytes: int) -> DataFrame:
    """The pairs that reach the threshold, as stored edges u, v. Only sets that pass the suffix filter are fetched."""
    pairs = cut_lineage(_suffix_filter(pairs, prefixes, needed, out_of))
    wanted = pairs.select(F.col("a").alias("digest")).unionByName(pairs.select(F.col("b").alias("digest"))).distinct()
    keys = cut_lineage(wanted.join(classes, "digest").select("digest", "rep"))

    def whole_sets(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = list(_text_sets(_strings(batch), n))
            yield pd.DataFrame({"digest": list(map(_digest, found)), "shingles": [s.tobytes() for s in found]})

    @F.pandas_udf("digest binary, shingles binary")
    def fetch(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from giving_back(whole_sets(batches))

    texts = keep_keys(docs, keys.select(F.col("rep").alias("doc_id")).distinct(), limit=broadcast_bytes)
    sets = texts.select(fetch.asNondeterministic()("text").alias("s")).select("s.*").join(keys.select("digest"), "digest", "left_semi")
    sets = sets.groupBy("digest").agg(F.first("shingles").alias("shingles"))

    @F.pandas_udf("boolean")
    def linked(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([shares_enough(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), needed, out_of)
                          for x, y in zip(left, right)], dtype=bool)

    with_b = pairs.join(sets.select(F.col("digest").alias("b"), F.col("shingles").alias("b_set")), "b")
    with_both = with_b.join(sets.select(F.col("digest").alias("a"), F.col("shingles").alias("a_set")), "a")
    return cut_lineage(with_both.filter(linked("a_set", "b_set")).select(F.col("a").alias("u"), F.col("b").alias("v")))


def _against_pivots(postings: DataFrame, needed: int, out_of: int) -> DataFrame:
    """Pairs of each shingle's nearest set with the others of its list."""
    pivots = postings.groupBy("gram").agg(F.min(F.struct("pos", "digest", "size")).alias("p")).select(
        "gram", F.col("p.pos").alias("b_pos"), F.col("p.digest").alias("b_digest"), F.col("p.size").alias("b_size"))
    met = _side(postings, "a").join(pivots, "gram")
    return _pairs(met.filter((F.col("a_digest") != F.col("b_digest")) & _may_link("a", "b", needed, out_of)))


def _across(postings: DataFrame, merged: DataFrame, needed: int, out_of: int) -> DataFrame:
    """All pairs of sets in different components that the filters leave."""
    own = postings.join(merged.select(F.col("u").alias("digest"), F.col("v").alias("comp")), "digest", "left").select(
        *postings.columns, F.coalesce("comp", "digest").alias("comp"))
    mixed = own.groupBy("gram").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high")
    own = cut_lineage(own.join(mixed.select("gram"), "gram", "left_semi"))
    # Pairs of components first, by what the best of their sets could share; then the sets of those left.
    groups = own.groupBy("gram", "comp").agg(F.min("size").alias("least"), F.max("size").alias("most"),
                                             F.max(F.col("size") - F.col("pos")).alias("rest"))
    left, right = _side(groups, "a"), _side(groups, "b")
    possible = left.join(right, (left["gram"] == right["gram"]) & (F.col("a_comp") < F.col("b_comp"))
                         & (F.col("a_most") * out_of >= F.col("b_least") * needed)
                         & (F.col("b_most") * out_of >= F.col("a_least") * needed)
                         & (F.least("a_rest", "b_rest") * (needed + out_of) >= (F.col("a_least") + F.col("b_least")) * needed)
                         ).select(left["gram"].alias("gram"), "a_comp", "b_comp")
    with_a = possible.join(_side(own, "a"), ["gram", "a_comp"])
    b = _side(own, "b")
    met = with_a.join(b, (with_a["gram"] == b["gram"]) & (with_a["b_comp"] == b["b_comp"]) & _may_link("a", "b", needed, out_of))
    return _pairs(met)


def jaccard_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 3, needed: int = 90,
                   out_of: int = 100, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    Words are runs of anything but space and 0x09 to 0x0D, A-Z lower-cased. A text of fewer than ``n`` words
    is one shingle; a null or empty text, or one without words, has none and is linked with nothing. Two rows link
    when ``out_of`` times their shared shingles are at least ``needed`` times all of theirs. component_id is
    the smallest doc_id that links reach. Rows that repeat an id stay rows of their own; null ids stay null
    and are never a component's id unless it has no other. An empty table gives no rows; further columns are
    left out. Shingles are compared by 64-bit hashes, sets of them by 128-bit digests.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    seen = cut_lineage(rows.select("doc_id", _sets_and_counts(F.col("text"), n).alias("s")).select("doc_id", "s.*"))
    table = docs.sparkSession.sparkContext.broadcast(_order_table(seen))
    classes = cut_lineage(seen.filter("size > 0").groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("rows")))

    shown = rows.select(_prefixes(F.col("text"), n, needed, out_of, table).alias("s")).select("s.*").filter("size > 0")
    prefixes = cut_lineage(shown.dropDuplicates(["digest"]))
    # Postings carry a short key until lists of one are gone; keys that happen to agree are told apart after that.
    postings = prefixes.select(F.xxhash64("digest").alias("key"), "size", F.posexplode("grams").alias("pos", "gram"))
    shared = postings.groupBy("gram").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1").select("gram")
    postings = postings.join(shared, "gram", "left_semi")
    named = classes.select("digest", F.xxhash64("digest").alias("key"))
    postings = cut_lineage(postings.join(named, "key").select("gram", "digest", "size", F.col("pos").cast("bigint")))

    near = _verify(_against_pivots(postings, needed, out_of), rows, classes, prefixes, n, needed, out_of, broadcast_bytes)
    merged = connected_components(near)
    crossing = _verify(_across(postings, merged, needed, out_of), rows, classes, prefixes, n, needed, out_of,
                       broadcast_bytes)
    if not crossing.isEmpty():
        merged = connected_components(merged.unionByName(crossing))

    members = merged.select(F.col("u").alias("digest"), F.col("v").alias("comp")).unionByName(
        merged.select(F.col("v").alias("digest"), F.col("v").alias("comp"))).distinct()
    grouped = classes.join(members, "digest", "left").withColumn("comp", F.coalesce("comp", "digest"))
    smallest = grouped.groupBy("comp").agg(F.min("rep").alias("component_id"), F.sum("rows").alias("all_rows"))
    moved = grouped.join(smallest.filter("all_rows > 1"), "comp").select("digest", "component_id")
    found = seen.filter("size > 0").join(moved, "digest", "left").select(
        "doc_id", F.col("size").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    alone = seen.filter("size = 0").select("doc_id", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return found.unionByName(alone)
