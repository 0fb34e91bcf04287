"""Conversation repair, line deduplication and prefix tries against brute force, and on awkward rows."""

from __future__ import annotations

import functools
import hashlib
import itertools
import random
from collections import Counter, defaultdict

import pytest
from fixtures_llm import awkward, empty  # noqa: F401
from pyspark.sql import functions as F

from smelter.llm import line_dedup, prefix_trie, repair
from smelter.llm.apart import join_heavy_apart

TURNS = "conv_id bigint, turn bigint, role string, text string, tie int, audit string, digest string"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], TURNS).repartition(3)


# --- repair

def cheapest(kinds):
    """All edits tried: the least cost, and the least letters of that cost."""
    @functools.cache
    def best(i, state, inserted):
        found = []
        if i < len(kinds):
            for letter, cost, after in repair._edits(kinds[i], state):
                rest = best(i + 1, after, 0)
                found.append((cost + rest[0], letter + rest[1]))
        elif state in (0, 3):
            found.append((0, ""))
        if inserted < 3:
            rest = best(i, 3 if state == 2 else 2, inserted + 1)
            found.append((2 + rest[0], "I" + rest[1]))
        return min(found, default=(1 << 30, ""))

    return best(0, 0, 0)


@pytest.mark.parametrize("block", [1, 2, 3, 4])
def test_plans_are_the_cheapest_and_ascii_least(block):
    dice, tables = random.Random(block), repair.BlockTables(block)
    some = [list(k) for n in range(4) for k in itertools.product(range(repair.SYMBOLS), repeat=n)]
    some += [[dice.randrange(repair.SYMBOLS) for _ in range(dice.randrange(4, 60))] for _ in range(200)]
    for kinds in some:
        assert tables.plan(kinds) == cheapest(tuple(kinds)), kinds


def plain_repair(said):
    """Faults, illegal neighbours, plan and repaired lines of (role, text) in order."""
    seen, kinds, faults, illegal = set(), [], Counter(), 0
    for i, (role, text) in enumerate(said):
        bare = text.rstrip(repair.BLANKS)
        blank, repeat, cut = not bare, (role, text) in seen, bare[-1:] not in repair.ENDINGS
        seen.add((role, text))
        faults["blank" if blank else "duplicate" if repeat else "truncated" if cut else ""] += 1
        kinds.append(repair.symbol(role[:1], blank or repeat, cut))
        illegal += i > 0 and said[i - 1][0][:1] + role[:1] not in ("su", "ua", "au")
    cost, audit = cheapest(tuple(kinds))
    out, left, last = [], iter(said), None
    for letter in audit:
        due = "assistant" if last == "u" else "user"
        role, text = (due, "") if letter == "I" else next(left)
        if letter == "R":
            role = due
        if letter != "D":
            out.append((role, text))
            last = role[0]
    return (faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit), out


def test_repair_of_awkward_conversations(spark):
    dice = random.Random(4)
    rows = [(1, None, None, None), (1, 3, "user", "a."), (1, 3, "user", "a."), (1, 3, "assistant", "b"), (1, 9, "tool", "c!"),
            (None, 1, "user", "x."), (None, None, "assistant", "y?"), (3, 1, "", "\x0b \t"), (4, -(1 << 63), "user", "q."),
            (4, (1 << 63) - 1, "assistant", "z" * 300_000 + "."), (5, 1, "system", "s."), (6, 2, "üser", "é.")]
    rows += [(i, t, dice.choice(["user", "assistant", "system", "tool"]), dice.choice(["a.", "b!", "c", " ", "d? "]))
             for i in range(10, 60) for t in range(dice.randrange(1, 30))]
    rows += [(99, t, "user" if t % 2 else "assistant", f"{t}.") for t in range(3000)]
    turns = repair.ordered_turns(conversations(spark, rows))
    plans = repair.repair_plans(turns)
    found = {r.conv_id: r for r in plans.collect()}
    texts, digests = defaultdict(list), {r.conv_id: r.repaired_sha256 for r in repair.repaired_digests(turns, plans).collect()}
    for r in repair.repaired_turns(turns, plans, batch=7).orderBy("conv_id", "place").collect():
        assert r.place == len(texts[r.conv_id])
        texts[r.conv_id].append((r.role, r.text))
    kept = defaultdict(list)
    for r in turns.collect():
        kept[r.conv_id].append((r.turn is not None, r.turn or 0, bytes(r.tie), r.role, r.text))
    assert set(found) == set(kept) == set(digests)
    for conv, said in kept.items():
        facts, lines = plain_repair([s[3:] for s in sorted(said)]) if conv != 99 else (None, texts[99])
        r = found[conv]
        if facts:
            assert (r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) == facts
        assert texts[conv] == lines
        assert digests[conv] == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in lines).encode()).hexdigest()
    assert (found[99].cost, found[99].audit) == (4, "I" + "K" * 3000 + "I")
    assert (found[1].gaps, found[3].gaps, found[None].gaps) == (5, 0, 0) and found[4].gaps == (1 << 63) - 1
    none = turns.filter("conv_id = -5")
    assert repair.repair_plans(none).count() == 0 and repair.repaired_turns(none, repair.repair_plans(none)).count() == 0


# --- line deduplication

def plain_dedup(rows, min_chars, min_docs):
    keys = defaultdict(set)

    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))

    for doc, text in rows:
        for line in (text or "").split("\n"):
            keys[key(line)].add(doc)

    def lost(doc, line):
        own = keys[key(line)]
        keeper = max((d for d in own if d is not None), default=None)
        return len(key(line)) >= min_chars and len(own) >= min_docs and doc != keeper

    return sorted(((doc, "\n".join(l for l in lines if not lost(doc, l)), len(lines), sum(lost(doc, l) for l in lines))
                   for doc, text in rows for lines in [(text or "").split("\n")]), key=repr)


@pytest.mark.parametrize("min_chars, min_docs", [(4, 2), (1, 3), (40, 5), (0, 1)])
def test_lines_against_brute_force(spark, min_chars, min_docs):
    dice = random.Random(min_docs)
    pool = [" Shared LINE one ", "shared line one", "\x0bshared line one\r", "ÄÖÜ Éa B", "äöü Éa b", "x" * 45, "", " ", "ab", "one\x85 "]
    rows = [(i, "\n".join(dice.choice(pool) for _ in range(dice.randrange(9)))) for i in range(40)]
    rows += [(None, "shared line one\nown"), (None, "x" * 45), (7, "ab\nab"), (7, "ab\nab"), (7, "shared line one"), (100, None),
             (101, ""), (102, "\n\n"), (103, "\n".join(["x" * 45, "far"] * 20_000)), (104, "long " * 60_000), (-3, "ab\n")]
    docs = spark.createDataFrame([(*r, 0, "k") for r in rows], "doc_id bigint, text string, row int, keeper string").repartition(4)
    found = line_dedup.dedup_lines(docs, min_chars=min_chars, min_docs=min_docs).collect()
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in found), key=repr) == plain_dedup(rows, min_chars, min_docs)
    assert line_dedup.dedup_lines(docs.filter("doc_id = -99")).count() == 0


def test_awkward_documents_keep_their_lines(spark, awkward):  # noqa: F811
    found = line_dedup.dedup_lines(awkward)
    assert found.columns == ["doc_id", "text", "n_lines", "n_dropped"] and found.count() == awkward.count()
    assert found.filter("n_dropped > 0").count() == 0


def test_heavy_keys_join_apart(spark):
    rows = spark.range(1000).select(F.when(F.col("id") < 700, 0).otherwise(F.col("id") % 50).alias("k"), "id")
    keyed = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter("k < 20").withColumn("name", F.concat(F.lit("n"), "k"))
    plain = sorted((r.k, r.id, f"n{r.k}") for r in rows.collect() if r.k < 20)
    for share in (1, 3, 1000):
        assert sorted(map(tuple, join_heavy_apart(rows, keyed, ["k"], "n", share).select("k", "id", "name").collect())) == plain


# --- prefix trie

def plain_trie(lists):
    """Every node by its path, from (conv_id, [(role, text)])."""
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for conv, turns in lists.items():
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].append(conv)
        ends[tuple(turns)].append(conv)
    for path in members:
        if path:
            children[path[:-1]].add(path)
    rows = []

    def sums(path):
        own = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        below = [sums(c) for c in children[path]]
        saved, leaves = own + sum(b[0] for b in below), sum(b[1] for b in below) or 1
        rows.append((min(members[path]), len(path), min(members[path[:-1]]) if path else None, len(members[path]),
                     len(children[path]), leaves, saved, hashlib.sha256(",".join(map(str, sorted(ends[path]))).encode()).hexdigest()))
        return saved, leaves

    if lists:
        sums(())
    return sorted(rows, key=repr)


@pytest.mark.parametrize("shard", [1, 7, 512])
def test_trie_against_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(prefix_trie, "SHARD_IDS", shard)
    dice = random.Random(shard)
    lists = {i: [(dice.choice("su"), dice.choice(["a", "bé", ""])) for _ in range(dice.randrange(7))] for i in range(-20, 120)}
    lists |= {i: [("u", "same"), ("a", "copy")] for i in range(300, 420)} | {1 << 40: [("u", "same")] * 50, 500: [("u", "x" * 200_000)]}
    rows = [(conv, t, role, text) for conv, turns in lists.items() for t, (role, text) in enumerate(turns)]
    rows += [(None, 1, "u", "same"), (600, 2, None, None), (600, None, "u", "first"), (600, None, "u", "first")]
    lists[600] = [("u", "first"), ("u", "first"), ("", "")]
    built = prefix_trie.turn_lists(conversations(spark, rows))
    none = spark.createDataFrame([(c, []) for c, t in lists.items() if not t], built.schema)
    found = prefix_trie.prefix_trie(built.unionByName(none))
    shown = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, found.select(shown).collect()), key=repr) == plain_trie(lists)
    assert prefix_trie.prefix_trie(built.filter("conv_id = -99")).count() == 0


def test_starts_are_taken_from_another_conversation(spark):
    rows = [(c, t, "u", f"{c}.{t}") for c, n in ((0, 3), (1, 5), (2, 1), (6, 4)) for t in range(n)]
    lists = prefix_trie.turn_lists(conversations(spark, rows))
    turn = {bytes(t.digest): (c, i) for c, turns in map(tuple, lists.collect()) for i, t in enumerate(turns)}
    moved = prefix_trie.with_start_of(lists, F.col("conv_id") - F.col("conv_id") % 5, F.lit(4), most=8)
    found = {c: [turn[bytes(t.digest)] for t in turns] for c, turns in map(tuple, moved.collect())}
    assert found == {0: [(0, 0), (0, 1), (0, 2)], 1: [(0, 0), (0, 1), (0, 2), (1, 4)], 2: [(0, 0), (0, 1), (0, 2)], 6: []}
