"""Invented texts and awkward rows."""

from __future__ import annotations

import pytest

WORDS = ("ore", "slag", "ingot", "anvil", "forge", "coke", "flux", "tongs", "bellows", "hammer", "quench", "temper")


def words(start: int, n: int) -> str:
    """``n`` words, different for each start."""
    def spelled(number: int) -> str:
        return "".join("abcdefghij"[int(digit)] for digit in str(number))

    return " ".join(f"{WORDS[i % 12]}{spelled(start)}z{spelled(i)}" for i in range(n))


BASE = words(1, 200)

AWKWARD = [
    (1, BASE), (2, BASE), (2, BASE), (3, BASE + " end"), (4, None), (5, ""), (6, " \t\n"), (7, "one"), (8, "ONE"),
    (9, "one two"), (10, "x" * 300_000), (11, words(5, 30_000)), (None, words(9, 50)), (12, "ÄÖ été \N{GRINNING FACE}"),
    (13, words(2, 60)), (14, words(2, 60)), (15, words(2, 59)), (16, "one\x00two \x1cthree"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    rows = [(i, t, "doc_id?", 1.5, "en" if t and "é" not in t else None) for i, t in AWKWARD]
    schema = "doc_id bigint, text string, digest string, score double, lang string"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.filter("doc_id < 0")
