"""Conversation structure repair: the cheapest edits that make turns read system?, (user, assistant)*.

A turn is kept, given the other role (2), deleted (3), or an empty one is inserted (2); a truncated turn that stays adds 1.
Blank and repeated turns must go. A turn is one of nine symbols for this, and what the rest of a conversation costs is a
vector of four numbers, one for each state of the pattern. Less their minimum only a few such vectors exist, so, as the Four
Russians did, their transitions are computed once for every block of ``BLOCK`` symbols. A conversation goes from its end to its
start by one lookup per block. Then the blocks are expanded from first to last: within one, the vectors are computed backward
from its right end, and the edits are read off forward, the smallest letter first, so ties are broken alike whatever the blocks.

Edits are planned on a few bytes per turn. Texts meet their conversation's plan once, and pass it as a stream.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.llm.batches import bound_batches

#: Symbols of a block.
BLOCK = 4
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
BLANKS = " \t\n\x0b\x0c\r"
ENDINGS = (".", "!", "?")
LEGAL_PAIRS = ("su", "ua", "au")

#: What was last said: nothing, a system's, a user's or an assistant's turn. A conversation may end in the first and the last.
_NOTHING, _SYSTEM, _USER, _ASSISTANT = range(4)
_ACCEPTED = (_NOTHING, _ASSISTANT)
#: What may be said next, and what will then have been said. A system's turn is only ever kept.
_MADE = {_NOTHING: _USER, _SYSTEM: _USER, _USER: _ASSISTANT, _ASSISTANT: _USER}
_NAMES = {_USER: "user", _ASSISTANT: "assistant"}
_INITIALS = {"s": _SYSTEM, "u": _USER, "a": _ASSISTANT}
#: Symbol 0 must be deleted; 1 + 2 * kind + truncated otherwise, with kind 0 for any other role.
SYMBOLS = 9


def symbol(initial: str, must_go: bool, truncated: bool) -> int:
    return 0 if must_go else 1 + 2 * _INITIALS.get(initial, 0) + truncated


def _edits(kind: int, state: int) -> list[tuple[str, int, int]]:
    """Letter, cost and next state of the ways to take a turn of this symbol, but for insertions, by letter."""
    ways = [("D", DELETE, state)]
    if kind:
        role, more = (kind - 1) // 2, TRUNCATED * ((kind - 1) % 2)
        if role and (_MADE[state] == role or (state == _NOTHING and role == _SYSTEM)):
            ways.append(("K", more, role))
        ways.append(("R", REROLE + more, _MADE[state]))
    return ways


def _with_insertions(costs: list[int]) -> tuple[int, ...]:
    """Costs when a turn may be inserted first; two in a row are the most that can help."""
    for _ in range(2):
        costs = [min(costs[q], INSERT + costs[_MADE[q]]) for q in range(4)]
    return tuple(costs)


_FAR = 1 << 20
#: What is left to pay at the end of a conversation.
END_COSTS = _with_insertions([0 if q in _ACCEPTED else _FAR for q in range(4)])


def before(kind: int, costs: tuple[int, ...]) -> tuple[int, ...]:
    """The costs before a turn of this symbol, from those after it."""
    return _with_insertions([min(cost + costs[state] for _, cost, state in _edits(kind, q)) for q in range(4)])


class BlockTables:
    """All cost vectors less their minimum, and where each block of symbols leads from each of them."""

    def __init__(self, block: int = BLOCK):
        self.block, self.vectors, places = block, [END_COSTS], {END_COSTS: 0}
        moves: list[list[tuple[int, int]]] = []
        for vector in self.vectors:
            moves.append([])
            for kind in range(SYMBOLS):
                costs = before(kind, vector)
                least = min(costs)
                normal = tuple(c - least for c in costs)
                if normal not in places:
                    places[normal] = len(self.vectors)
                    self.vectors.append(normal)
                moves[-1].append((places[normal], least))
        one, paid = (np.array([[m[k] for m in own] for own in moves]).T for k in range(2))
        #: By length of block: [code, vector after] -> vector before, and what the minimum grows by.
        self.leads, self.grows = [np.arange(len(places))[None]], [np.zeros((1, len(places)), np.int64)]
        for _ in range(block):
            after, so_far = self.leads[-1], self.grows[-1]
            self.leads.append(one[:, after].reshape(-1, len(places)))
            self.grows.append((so_far + paid[:, after]).reshape(-1, len(places)))

    def codes(self, kinds: list[int]) -> list[tuple[int, int]]:
        """Length and code of each block; the first symbol is the highest digit."""
        out = []
        for start in range(0, len(kinds), self.block):
            code = 0
            for kind in kinds[start:start + self.block]:
                code = code * SYMBOLS + kind
            out.append((min(self.block, len(kinds) - start), code))
        return out

    def plan(self, kinds: list[int]) -> tuple[int, str]:
        """The least cost, and of the cheapest edits the ASCII-least letters (D, I, K, R)."""
        after, cost, vector = [], 0, 0
        for length, code in reversed(self.codes(kinds)):
            after.append(vector)
            cost += int(self.grows[length][code, vector])
            vector = int(self.leads[length][code, vector])
        cost += self.vectors[vector][_NOTHING]
        state, letters = _NOTHING, []
        for start, right in zip(range(0, len(kinds), self.block), reversed(after)):
            state = self._expand(kinds[start:start + self.block], right, state, letters)
        while state not in _ACCEPTED:
            state = _MADE[state]
            letters.append("I")
        return cost, "".join(letters)

    def _expand(self, kinds: list[int], right: int, state: int, letters: list[str]) -> int:
        costs = [self.vectors[right]]
        for kind in reversed(kinds):
            costs.append(before(kind, costs[-1]))
        for kind, now, then in zip(kinds, costs[:0:-1], costs[-2::-1]):
            while True:
                ways = {letter: (next_state, cost + then[next_state]) for letter, cost, next_state in _edits(kind, state)}
                made = _MADE[state]
                ways["I"] = (made, INSERT + now[made])
                letter = min(w for w, (_, total) in ways.items() if total == now[state])
                letters.append(letter)
                state = ways[letter][0]
                if letter != "I":
                    break
        return state


@functools.cache
def block_tables() -> BlockTables:
    """Computed once in every Python worker."""
    return BlockTables()


def ordered_turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
                  ) -> DataFrame:
    """conv_id, turn, tie, role and text of every row; null roles and texts are one space.

    Turns go by number, nulls first; equal numbers by ``tie``, a digest of role and text.
    """
    rows = conversations.select(
        F.col(conv).alias("conv_id"), F.col(turn).cast("bigint").alias("turn"),
        *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(name) for c, name in ((role, "role"), (text, "text"))))
    return rows.select("conv_id", "turn", _digest().alias("tie"), "role", "text")


def _digest() -> Column:
    return F.substring(F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)), 1, 16)


def _gaps(turns: Column) -> Column:
    low, high = (f(turns).cast("decimal(20,0)") for f in (F.array_min, F.array_max))
    missing = high - low + 1 - F.size(F.array_distinct(F.array_compact(turns)))
    return F.coalesce(F.least(missing, F.lit((1 << 63) - 1).cast("decimal(20,0)")).cast("bigint"), F.lit(0).cast("bigint"))


def _judge(said: str) -> Column:
    """Counts of first faults and illegal neighbours, and the plan, of each conversation's turns in order."""
    @F.pandas_udf("blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string")
    def judged(digests: pd.Series, initials: pd.Series, blanks: pd.Series, cuts: pd.Series) -> pd.DataFrame:
        rows, tables = [], block_tables()
        for own in zip(digests, initials, blanks, cuts):
            seen, kinds, faults, illegal, last = set(), [], [0, 0, 0], 0, None
            for digest, initial, blank, cut in zip(*own):
                repeat = digest in seen
                seen.add(digest)
                if blank or repeat or cut:
                    faults[0 if blank else 1 if repeat else 2] += 1
                kinds.append(symbol(initial, blank or repeat, cut))
                illegal += last is not None and last + initial not in LEGAL_PAIRS
                last = initial
            rows.append((*faults, illegal, *tables.plan(kinds)))
        return pd.DataFrame(rows, columns=["blank", "duplicate", "truncated", "illegal", "cost", "audit"])

    return judged(*(F.col(f"{said}.{c}") for c in ("digest", "initial", "blank", "cut")))


def repair_plans(turns: DataFrame) -> DataFrame:
    """Per conversation its faults, the least cost of repairing it, and the edits (``audit``).

    ``turns`` is as ``ordered_turns`` gives it. ``gaps`` are the numbers missing between the first and last turn; ``blank``,
    ``duplicate`` and ``truncated`` count turns by their first fault, ``illegal`` neighbours that may not follow each other.
    ``audit`` has a letter for each edit in order: K keeps, R gives the role due, D deletes, I inserts an empty turn of the role due.

    Null conversation ids form one conversation; null turns come first and leave no gap; an empty table gives no rows.
    About 60 bytes of each turn of a conversation meet in one row, its texts do not.
    """
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    facts = turns.select("conv_id", F.struct(
        "turn", "tie", _digest().alias("digest"), F.substring("role", 1, 1).alias("initial"), (bare == "").alias("blank"),
        (~F.substring(bare, -1, 1).isin(*ENDINGS)).alias("cut")).alias("said"))
    told = facts.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("said"))
    judged = told.select("conv_id", _gaps(F.col("said.turn")).alias("gaps"), _judge("said").alias("found"))
    return judged.select("conv_id", "gaps", "found.*")


def _walk(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[str | None, str, str | None, str | None]]:
    """Conversation, 'turn' with role and text or 'end', for sorted frames in which each plan comes before its turns."""
    conv, edits, state, letter, begun = None, iter(()), _NOTHING, "", False

    def inserted() -> Iterator[tuple[str, str, str]]:
        """Turns up to the next edit of a row, which then is in ``letter``."""
        nonlocal state, letter
        letter = next(edits, "")
        while letter == "I":
            state = _MADE[state]
            yield "turn", _NAMES[state], ""
            letter = next(edits, "")

    for frame in frames:
        for conv_id, audit, role, text in zip(frame["conv_id"], frame["audit"], frame["role"], frame["text"]):
            if isinstance(audit, str):
                if begun:
                    yield from ((conv, *t) for t in inserted())
                    yield conv, "end", None, None
                conv, edits, state, begun = conv_id, iter(audit), _NOTHING, True
                continue
            yield from ((conv, *t) for t in inserted())
            if letter == "D":
                continue
            state = _MADE[state] if letter == "R" else _INITIALS[role[0]]
            yield conv, "turn", _NAMES[state] if letter == "R" else role, text
    if begun:
        yield from ((conv, *t) for t in inserted())
        yield conv, "end", None, None


def _beside_plans(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """Each conversation's plan and then its turns in order, as one run of rows."""
    bound_batches(turns.sparkSession)
    heads = plans.select("conv_id", "audit")
    both = heads.unionByName(turns, allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", F.col("audit").isNull(), "turn", "tie").select(
        F.col("conv_id").cast("string").alias("conv_id"), "audit", "role", "text")


def repaired_turns(turns: DataFrame, plans: DataFrame, batch: int = 1000) -> DataFrame:
    """conv_id, place (from 0), role and text of what each plan leaves and inserts.

    A conversation passes through one task as a stream of rows; a task holds one Arrow batch of texts and one plan.
    """
    def repair(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        place = 0
        for conv, what, role, text in _walk(frames):
            if what == "end":
                place = 0
                continue
            out.append((conv, place, role, text))
            place += 1
            if len(out) >= batch:
                yield pd.DataFrame(out, columns=["conv_id", "place", "role", "text"])
                out = []
        yield pd.DataFrame(out, columns=["conv_id", "place", "role", "text"])

    found = _beside_plans(turns, plans).mapInPandas(repair, "conv_id string, place bigint, role string, text string")
    return found.withColumn("conv_id", F.col("conv_id").cast(turns.schema["conv_id"].dataType))


def repaired_digests(turns: DataFrame, plans: DataFrame) -> DataFrame:
    r"""conv_id and SHA-256 of what each plan leaves and inserts: ``role:text``, joined by \n, read as a stream."""
    def digest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        state, first = hashlib.sha256(), True
        for conv, what, role, text in _walk(frames):
            if what == "turn":
                state.update((f"{role}:{text}" if first else f"\n{role}:{text}").encode("utf-8", "surrogatepass"))
                first = False
                continue
            out.append((conv, state.hexdigest()))
            state, first = hashlib.sha256(), True
            if len(out) >= 10_000:
                yield pd.DataFrame(out, columns=["conv_id", "repaired_sha256"])
                out = []
        yield pd.DataFrame(out, columns=["conv_id", "repaired_sha256"])

    found = _beside_plans(turns, plans).mapInPandas(digest, "conv_id string, repaired_sha256 string")
    return found.withColumn("conv_id", F.col("conv_id").cast(turns.schema["conv_id"].dataType))
