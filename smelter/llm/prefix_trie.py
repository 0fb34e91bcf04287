"""Conversation prefix trie: which conversations begin alike, how far, and how much text that saves.

Conversations are dealt to shards by ranges of their ids. Each shard is indexed vertically: for every (position, turn) a
bitset of the conversations that have that turn there. From the root, a node's bitset is intersected with the postings of the next
position, depth first; each non-empty intersection is a child, its popcount the child's members, and the members that end at a
node are the node's end list. Nodes are named by a digest chained along their path, so the tries of all shards merge by
name, and what many shards share arrives as one row from each.

Sums over subtrees need no rounds either. A node counts in the shard of its smallest member, which holds the whole path above
it, so every shard sums up its own trie, and the sums of all shards are added by name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.llm.apart import join_heavy_apart
from smelter.operators.lineage import cut_lineage, scratch_folder

#: Consecutive ids whose conversations are indexed together; bounds a task's bitsets and its part of every end list.
SHARD_IDS = 512

NO_ENDS = hashlib.sha256(b"").hexdigest()
_NODE_TYPE = "shard bigint, key binary, parent binary, depth bigint, conv_id bigint, n_convs bigint, bytes bigint, ends string"


def turn_lists(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
               text: str = "text") -> DataFrame:
    """conv_id and ``turns`` in order, each as a 128-bit ``digest`` of role and text and the text's UTF-8 ``bytes``.

    Turns go by number, nulls first, equal numbers by their digest; null roles and texts are empty. Rows without a conv_id
    belong to no conversation. Texts stay where they are read.
    """
    said, by = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (text, role))
    digest = F.substring(F.unhex(F.sha2(F.concat(F.length(by).cast("string"), F.lit(":"), by, said), 256)), 1, 16)
    rows = conversations.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("bigint").alias("conv_id"),
        F.struct(F.col(turn).cast("bigint").alias("turn"), digest.alias("digest"),
                 F.octet_length(said).cast("bigint").alias("bytes")).alias("said"))
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("said"))
    return ordered.select("conv_id", F.transform("said", lambda t: F.struct(t["digest"], t["bytes"])).alias("turns"))


def with_start_of(lists: DataFrame, other: Column, take: Column, most: int) -> DataFrame:
    """Every conversation with its first ``take`` turns replaced by those of conversation ``other``.

    All of the other's turns if it has fewer, none if there is no such conversation; ``take`` is at most ``most``, so no more of the
    other's turns than that are sent.
    """
    none = F.array().cast(lists.schema["turns"].dataType)
    starts = lists.select(F.col("conv_id").alias("_other"), F.slice("turns", 1, most).alias("_start"))
    met = lists.withColumn("_from", other).join(starts, F.col("_from") == F.col("_other"), "left")
    own = F.slice("turns", take + 1, F.size("turns"))
    return met.select("conv_id", F.concat(F.slice(F.coalesce("_start", none), F.lit(1), take), own).alias("turns"))


def shard_nodes(ids: list[int], digests: list[list[bytes]], sizes: list[list[int]]) -> Iterator[tuple]:
    """key, parent, depth, smallest id, members, bytes of the last text and end list of each node; ids ascend."""
    postings: list[dict[bytes, int]] = [{} for _ in range(max(map(len, digests), default=0))]
    ending = [0] * (len(postings) + 1)
    for i, own in enumerate(digests):
        ending[len(own)] |= 1 << i
        for position, turn in enumerate(own):
            postings[position][turn] = postings[position].get(turn, 0) | 1 << i
    left = [(b"", None, 0, (1 << len(ids)) - 1, 0)] if ids else []
    while left:
        key, parent, depth, members, size = left.pop()
        ends, here = members & ending[depth], []
        rest = members ^ ends
        while ends:
            here.append(str(ids[(ends & -ends).bit_length() - 1]))
            ends &= ends - 1
        least = (members & -members).bit_length() - 1
        yield key, parent, depth, ids[least], members.bit_count(), size, ",".join(here) or None
        while rest:
            first = (rest & -rest).bit_length() - 1
            turn = digests[first][depth]
            child = rest & postings[depth][turn]
            rest ^= child
            left.append((hashlib.blake2b(key + turn, digest_size=16).digest(), key, depth + 1, child, sizes[first][depth]))


def subtree_sums(keys: list[bytes], parents: list[bytes | None], depths: list[int], own: dict[bytes, tuple[int, int]]
                 ) -> tuple[np.ndarray, np.ndarray]:
    """For every node the sums of the two values of ``own`` over its subtree in this trie."""
    place = {key: i for i, key in enumerate(keys)}
    above = [place[p] if p is not None else -1 for p in parents]
    saved, leaves = (np.array([own.get(key, (0, 0))[k] for key in keys], np.int64) for k in range(2))
    for i in np.argsort(-np.asarray(depths, np.int64), kind="stable").tolist():
        if above[i] >= 0:
            saved[above[i]] += saved[i]
            leaves[above[i]] += leaves[i]
    return saved, leaves


def _shard(conv_id: str) -> Column:
    return F.floor(F.col(conv_id) / F.lit(SHARD_IDS)).cast("bigint").alias("shard")


def _shard_tries(lists: DataFrame) -> DataFrame:
    def index(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("conv_id")
        found = list(shard_nodes(frame["conv_id"].tolist(), [list(d) for d in frame["digests"]], [list(b) for b in frame["sizes"]]))
        out = pd.DataFrame(found, columns=["key", "parent", "depth", "conv_id", "n_convs", "bytes", "ends"], dtype=object)
        out.insert(0, "shard", int(frame["shard"].iloc[0]))
        return out

    dealt = lists.select(_shard("conv_id"), "conv_id", F.col("turns.digest").alias("digests"), F.col("turns.bytes").alias("sizes"))
    return dealt.groupBy("shard").applyInPandas(index, _NODE_TYPE)


def _merged(tries: DataFrame) -> DataFrame:
    """One row per node with the number of its children."""
    nodes = cut_lineage(tries.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent").alias("parent"),
        F.sum("n_convs").alias("n_convs"), F.max("bytes").alias("bytes")))
    one = nodes.withColumn("n_children", F.lit(0))
    born = nodes.filter("parent IS NOT NULL").select(F.col("parent").alias("key"), F.lit(1).alias("n_children"))
    kept = [F.max(c).alias(c) for c in ("conv_id", "depth", "parent", "n_convs", "bytes")]
    return cut_lineage(one.unionByName(born, allowMissingColumns=True).groupBy("key").agg(
        *kept, F.sum("n_children").alias("n_children")))


def _sums(tries: DataFrame, nodes: DataFrame) -> DataFrame:
    """What each shard adds to the sums over the subtrees of its nodes."""
    def add(trie: pd.DataFrame, owned: pd.DataFrame) -> pd.DataFrame:
        if owned.empty:
            return pd.DataFrame({"key": [], "saved_tokens": [], "n_leaves": []})
        own = dict(zip(owned["node"], zip(owned["saved"].tolist(), owned["leaf"].tolist())))
        parents = [p if isinstance(p, bytes) else None for p in trie["parent"]]
        saved, leaves = subtree_sums(trie["key"].tolist(), parents, trie["depth"].tolist(), own)
        some = (saved != 0) | (leaves != 0)
        return pd.DataFrame({"key": trie["key"][some], "saved_tokens": saved[some], "n_leaves": leaves[some]})

    owned = nodes.select(_shard("conv_id"), F.col("key").alias("node"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
                         (F.col("n_children") == 0).cast("bigint").alias("leaf"))
    return tries.select("shard", "key", "parent", "depth").groupBy("shard").cogroup(owned.groupBy("shard")).applyInPandas(
        add, "key binary, saved_tokens bigint, n_leaves bigint")


def _end_digests(tries: DataFrame) -> DataFrame:
    """Per node with ends, SHA-256 of their ids in ascending order: the shards' lists, read in order as a stream."""
    def digest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = None, None
        for frame in frames:
            done = []
            for key, ends in zip(frame["key"], frame["ends"]):
                if key != now:
                    if state is not None:
                        done.append((now, state.hexdigest()))
                    now, state = key, hashlib.sha256(ends.encode())
                else:
                    state.update(b"," + ends.encode())
            yield pd.DataFrame(done, columns=["key", "ends_sha256"])
        if state is not None:
            yield pd.DataFrame([(now, state.hexdigest())], columns=["key", "ends_sha256"])

    lists = tries.filter("ends IS NOT NULL").select("key", "shard", "ends")
    return lists.repartition("key").sortWithinPartitions("key", "shard").mapInPandas(digest, "key binary, ends_sha256 string")


def prefix_trie(lists: DataFrame) -> DataFrame:
    """One row per node of the trie over ``lists`` (conv_id, unique and not null, and ``turns`` as ``turn_lists`` gives them).

    conv_id is the node's smallest member and, with depth, its name; parent_conv_id the parent's smallest member (root:
    null); n_convs the members, n_children the children, n_leaves the childless nodes of its subtree, saved_tokens the sum over its
    subtree of (n_convs - 1) times the bytes of a node's last text; ends_sha256 the SHA-256 of the ids, ascending and joined by
    commas, of the conversations that end at the node. A conversation without turns ends at the root. Without conversations there
    is no root and no row. A task holds the digests (about 100 bytes a turn) of at most ``SHARD_IDS`` conversations.
    """
    spark = lists.sparkSession
    folder = scratch_folder(spark)
    _shard_tries(lists).write.parquet(folder)
    tries = spark.read.parquet(folder)
    nodes = _merged(tries)

    shown = ["key", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children"]
    above = nodes.filter("n_children > 0").select(
        F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    below = join_heavy_apart(nodes.filter("parent IS NOT NULL"), above, ["parent"], "n_children").select(*shown)
    root = nodes.filter("parent IS NULL").withColumn("parent_conv_id", F.lit(None).cast("bigint")).select(*shown)

    facts = below.unionByName(root)
    for more in (_sums(tries, nodes), _end_digests(tries)):
        facts = facts.unionByName(more, allowMissingColumns=True)
    whole = facts.groupBy("key").agg(
        *(F.max(c).alias(c) for c in shown[1:]), F.sum("n_leaves").alias("n_leaves"),
        F.coalesce(F.sum("saved_tokens"), F.lit(0)).cast("bigint").alias("saved_tokens"),
        F.coalesce(F.max("ends_sha256"), F.lit(NO_ENDS)).alias("ends_sha256"))
    return whole.drop("key")
