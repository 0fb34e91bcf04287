"""Supervised subword embeddings for text quality.

Words, pairs of words and runs of 3 and 4 bytes are hashed to rows of a table of learned vectors; a
document is the mean of the vectors of all its features, a linear layer and softmax give the classes.
Table and layer are trained together by stochastic gradient descent in numpy. For scoring, each vector is
multiplied by the layer once, since the mean of products is the product of the mean.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.llm.batches import bound_batches, giving_back
from smelter.llm.hashing import word_hashes
from smelter.llm.sampling import smallest_hashes

BUCKETS = 1 << 16
_SHIFT = np.uint64(64 - 16)
_RUN_FACTORS = {3: np.uint32(0x9E3779B1), 4: np.uint32(0x85EBCA6B)}
_WORD_FACTOR, _PAIR_FACTOR = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
#: Bytes of text whose features are held at once.
PIECE_BYTES = 250_000


@dataclass(frozen=True)
class Training:
    """The sample has at most ``rows_per_label`` rows of each label, with all of their texts."""

    rows_per_label: int = 1000
    dimensions: int = 8
    epochs: int = 8
    batch: int = 32
    rate: float = 0.5
    seed: int = 7


def feature_groups(raws: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per kind of feature: buckets of all texts in order, and where each text's begin and end."""
    buffer = np.frombuffer(b" ".join(raws) + b" ", np.uint8)
    lengths = np.fromiter(map(len, raws), np.int64, len(raws))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    out = []
    for n, factor in _RUN_FACTORS.items():
        codes = np.zeros(max(len(buffer) - n + 1, 0), np.uint32)
        for i in range(n):
            codes <<= np.uint32(8)
            codes |= buffer[i:len(buffer) - n + 1 + i]
        codes *= factor
        out.append(((codes >> np.uint32(16)).astype(np.uint16), np.minimum(starts, len(codes)),
                    np.clip(ends - n + 1, np.minimum(starts, len(codes)), len(codes))))
    words, counts = word_hashes(raws)
    word_ends = np.cumsum(counts)
    word_starts = word_ends - counts
    out.append((((words * _WORD_FACTOR) >> _SHIFT).astype(np.uint16), word_starts, word_ends))
    pairs = words[:-1] * _PAIR_FACTOR + words[1:] if len(words) else words
    out.append((((pairs * _WORD_FACTOR) >> _SHIFT).astype(np.uint16), np.minimum(word_starts, len(pairs)),
                np.maximum(word_ends - 1, np.minimum(word_starts, len(pairs)))))
    return out


def example(text: str | None) -> tuple[bytes, bytes]:
    """Distinct buckets of a whole text and their shares, as bytes: at most one pair for each bucket, however long the text."""
    counts = np.zeros(BUCKETS, np.int64)
    for raw, context in _pieces(text):
        for sign, part in ((1, raw), (-1, context)):
            if part:
                for buckets, starts, ends in feature_groups([part]):
                    counts += sign * np.bincount(buckets[starts[0]:ends[0]], minlength=BUCKETS)
    ids = np.flatnonzero(counts)
    return ids.astype(np.uint16).tobytes(), (counts[ids] / max(counts.sum(), 1)).astype(np.float32).tobytes()


def train(texts: list[str], labels: list[int], settings: Training = Training()) -> np.ndarray:
    """``train_examples`` for texts."""
    return train_examples([example(t) for t in texts], labels, settings)


def train_examples(packed: list[tuple[bytes, bytes]], labels: list[int], settings: Training = Training()) -> np.ndarray:
    """Log odds that each bucket adds, and the bias last, from ``example`` of each text; zeros where a label is missing."""
    if len(set(labels)) < 2:
        return np.zeros(BUCKETS + 1)
    dice = np.random.default_rng(settings.seed)
    d = settings.dimensions
    vectors = dice.uniform(-1 / d, 1 / d, (BUCKETS, d))
    layer, bias = np.zeros((d, 2)), np.zeros(2)
    layer[:, 1] = dice.uniform(-0.1, 0.1, d)
    examples = [(np.frombuffer(ids, np.uint16).astype(np.int64), np.frombuffer(shares, np.float32).astype(float)) for ids, shares in packed]
    target = np.eye(2)[np.array(labels)]
    weight = len(labels) / (2 * target.sum(axis=0))
    for epoch in range(settings.epochs):
        rate = settings.rate * (1 - epoch / settings.epochs)
        order = dice.permutation(len(examples))
        for at in range(0, len(order), settings.batch):
            batch = order[at:at + settings.batch]
            ids = np.concatenate([examples[i][0] for i in batch])
            shares = np.concatenate([examples[i][1] for i in batch])
            owner = np.repeat(np.arange(len(batch)), [len(examples[i][0]) for i in batch])
            weighted = vectors[ids] * shares[:, None]
            means = np.stack([np.bincount(owner, weighted[:, j], len(batch)) for j in range(d)], axis=1)
            logits = means @ layer + bias
            odds = np.exp(logits - logits.max(axis=1, keepdims=True))
            error = odds / odds.sum(axis=1, keepdims=True) - target[batch]
            error *= (target[batch] @ weight)[:, None] / len(batch)
            back = error @ layer.T
            layer -= rate * means.T @ error * settings.batch
            bias -= rate * error.sum(axis=0)
            # A vector's share in a mean is small, so its step is scaled up by the batch.
            step = rate * settings.batch * back[owner] * shares[:, None] * 10
            for j in range(d):
                vectors[:, j] -= np.bincount(ids, step[:, j], BUCKETS)
    return np.append(vectors @ (layer[:, 1] - layer[:, 0]), bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        settings: Training = Training()) -> np.ndarray:
    """Train on a bounded sample of labelled rows, those with the smallest hash of their id.

    Null labels teach nothing; null texts count as empty; equal texts with equal labels count once, and of rows that repeat an
    id one. Hashes under a cutoff, which the counts of the labels give, are ranked; they are at most a few times as many as the
    sample, so no label's rows meet in one task. The chosen ids (at most two times ``rows_per_label``) pick their texts, whose
    features are counted in the tasks over whole texts; what reaches the driver is bounded by ``BUCKETS`` for each.
    """
    rows = labels.select(F.col(doc_id).alias("doc_id"), (F.col(label) > 0).cast("int").alias("label"),
                         F.xxhash64(F.col(doc_id)).alias("h")).filter("label IS NOT NULL AND doc_id IS NOT NULL")
    chosen = smallest_hashes(rows, "label", settings.rows_per_label).groupBy("doc_id").agg(
        F.min("label").alias("label"), F.min("h").alias("h"))

    @F.pandas_udf("ids binary, shares binary")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([example(t if isinstance(t, str) else None) for t in batch], columns=["ids", "shares"])

    bound_batches(docs.sparkSession)
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    picked = texts.join(F.broadcast(chosen), "doc_id").select(
        "doc_id", "label", "h", features.asNondeterministic()("text").alias("f")).select("doc_id", "label", "h", "f.*")
    one = picked.groupBy("doc_id").agg(F.min(F.struct("ids", "shares", "label", "h")).alias("e")).select("e.*")
    found = one.groupBy("label", "ids", "shares").agg(F.min("h").alias("h")).collect()
    found.sort(key=lambda r: (r["h"], r["label"], r["ids"]))
    return train_examples([(bytes(r["ids"]), bytes(r["shares"])) for r in found], [r["label"] for r in found], settings)


_BLANK = re.compile(r"[\x20\x09-\x0D]+")


def _pieces(text: str | None) -> Iterator[tuple[bytes, bytes]]:
    """A text whole, or in pieces where it is far longer than ``PIECE_BYTES``, each after its context, and that context.

    Pieces end before blanks. The context is the last word before a piece, and more if that is shorter than a run of bytes; what a piece adds
    are its features less those of its context alone, so words, pairs and runs across a cut count once.
    """
    text, at, begin = text or "", 0, 0
    while True:
        found = _BLANK.search(text, at + 2 * PIECE_BYTES) if len(text) - at > 4 * PIECE_BYTES else None
        end = found.start() if found else len(text)
        yield text[begin:end].encode("utf-8", "surrogatepass"), text[begin:at].encode("utf-8", "surrogatepass")
        if found is None:
            return
        word = end
        while word > at and end - word < 4 or word > at and not _BLANK.match(text, word - 1):
            word -= 1
        at, begin = end, word


def scores(texts: list[str | None], odds: np.ndarray) -> np.ndarray:
    """The likelihood of label 1 for each whole text."""
    table, bias = odds[:-1], odds[-1]
    total, count = np.zeros(len(texts)), np.zeros(len(texts))
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def add() -> None:
        own, sign = (np.array([h[k] for h in held], np.int64) for k in range(2))
        for buckets, starts, ends in feature_groups([h[2] for h in held]):
            sums = np.concatenate(([0.0], np.cumsum(table[buckets])))
            np.add.at(total, own, sign * (sums[ends] - sums[starts]))
            np.add.at(count, own, sign * (ends - starts))

    for i, text in enumerate(texts):
        for raw, context in _pieces(text):
            if held and size + len(raw) > PIECE_BYTES:
                add()
                held, size = [], 0
            held += [(i, 1, raw), (i, -1, context)] if context else [(i, 1, raw)]
            size += len(raw)
    if held:
        add()
    return 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + bias, -30, 30)))


def quality_of(text: Column, odds: np.ndarray) -> Column:
    """Score between 0 and 1 of a text column. Null and empty texts get the score of no features."""
    bound_batches(SparkSession.active())

    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(scores([t if isinstance(t, str) else None for t in batch], odds))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from giving_back(scored(batches))

    # Not to be evaluated once more for a filter on its result.
    return score.asNondeterministic()(text)
