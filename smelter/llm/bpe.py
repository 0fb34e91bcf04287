"""Byte-level BPE over distinct words: every distinct pre-token is encoded once for the whole corpus.

Encoding has three steps. Documents are cut into pre-tokens, and blocks of documents keep, for each of their
distinct words, a number, and per document the numbers in order (its positions). The words of all blocks meet
in buckets by their hash, where each distinct word is encoded once. The ids go back to the blocks, whose
documents are put together by position. What is shuffled is a block's vocabulary and its numbers,
several times smaller than a row for each pre-token.

Decoding joins ids with the table of token bytes, whose size is that of the vocabulary.
"""

from __future__ import annotations

import base64
import hashlib
import math
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
import tiktoken
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.llm.batches import bound_batches, giving_back
from smelter.operators.lineage import scratch_folder

#: Characters of text in a block; bounds the memory of the tasks that read and rebuild it.
BLOCK_CHARS = 4_000_000
#: Documents whose numbers travel in one row.
ROW_CHARS = 200_000

#: Buckets of words. A block writes a row for each, so they stay this few however many documents there are.
BUCKETS = (16, 4096)
#: Distinct words of a bucket whose ids a task remembers before it starts anew; a word met again is then encoded again.
KNOWN_WORDS = 2_000_000

_CUT_TYPE = ("block string, bucket int, words binary, doc_ids array<string>, lengths array<bigint>, "
             "numbers binary")


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids from a rank file: a base64 token and its id on every line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class _Numbers(dict):
    """Words numbered as they are first met."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def _bucket(word: bytes, buckets: int) -> int:
    return xxhash.xxh3_64_intdigest(word) % buckets


def _packed(items: list[bytes]) -> bytes:
    """Byte strings with their lengths before them, compressed."""
    lengths = np.fromiter(map(len, items), np.uint32, len(items))
    return zstandard.ZstdCompressor(level=6).compress(
        np.uint32(len(items)).tobytes() + lengths.tobytes() + b"".join(items))


def _unpacked(packed: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    n = int(np.frombuffer(raw[:4], np.uint32)[0])
    ends = np.cumsum(np.frombuffer(raw[4:4 + 4 * n], np.uint32), dtype=np.int64) + 4 + 4 * n
    starts = np.concatenate(([4 + 4 * n], ends[:-1]))
    return [raw[s:e] for s, e in zip(starts.tolist(), ends.tolist())]


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers as planes of bytes, which compress better than whole numbers."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _from_planes(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _stream(numbers: np.ndarray) -> bytes:
    """Numbers of which most are small: a byte each, and planes for those of 255 and more."""
    large = numbers >= 255
    short = np.where(large, 255, numbers).astype(np.uint8).tobytes()
    return len(short).to_bytes(8, "little") + zstandard.ZstdCompressor(level=3).compress(short) + _planes(numbers[large])


def _from_stream(packed: bytes) -> np.ndarray:
    size = int.from_bytes(packed[:8], "little")
    opener = zstandard.ZstdDecompressor().decompressobj()
    numbers = np.frombuffer(opener.decompress(packed[8:]), np.uint8).astype(np.uint32)
    assert len(numbers) == size
    numbers[numbers == 255] = _from_planes(opener.unused_data)
    return numbers


class _Block:
    """Documents that are being cut, until there are enough for a block."""

    def __init__(self, cut: regex.Pattern, buckets: int):
        self.cut, self.buckets = cut, buckets
        self.words, self.chars, self.digest = _Numbers(), 0, hashlib.blake2b(digest_size=16)
        self.rows: list[tuple[list, list, list]] = []
        self.row_chars = ROW_CHARS

    def add(self, doc_id: str | None, text: str) -> None:
        if self.row_chars >= ROW_CHARS:
            self.rows.append(([], [], []))
            self.row_chars = 0
        doc_ids, lengths, numbers = self.rows[-1]
        found = np.fromiter(map(self.words.__getitem__, self.cut.findall(text)), np.uint32)
        doc_ids.append(doc_id)
        lengths.append(len(found))
        numbers.append(found)
        self.chars += len(text)
        self.row_chars += len(text)
        self.digest.update(f"{doc_id} {xxhash.xxh3_128_hexdigest(text.encode('utf-8', 'surrogatepass'))};".encode())

    def table(self, place: str) -> pd.DataFrame:
        """One row for each bucket of sorted words, one with the numbers of all words in this order, and the documents as numbers.

        The most frequent word of the block has number 0. The numbers stay with the documents: words travel without them.
        """
        block = f"{place}-{self.digest.hexdigest()}"
        counts = np.zeros(len(self.words), np.int64)
        for _, _, numbers in self.rows:
            for own in numbers:
                np.add.at(counts, own, 1)
        by_count = np.argsort(-counts, kind="stable")
        place_of = np.empty(len(by_count), np.uint32)
        place_of[by_count] = np.arange(len(by_count), dtype=np.uint32)
        raws = [word.encode("utf-8", "surrogatepass") for word in self.words]
        buckets = np.fromiter((_bucket(raw, self.buckets) for raw in raws), np.int64, len(raws))
        order = np.array(sorted(range(len(raws)), key=raws.__getitem__), np.int64)
        order = order[np.argsort(buckets[order], kind="stable")]
        cuts = np.searchsorted(buckets[order], np.arange(self.buckets + 1))
        rows = [(block, b, _packed([raws[i] for i in order[s:e]]), None, None, None)
                for b, (s, e) in enumerate(zip(cuts, cuts[1:])) if e > s]
        rows.append((block, None, None, None, None, _planes(place_of[order])))
        rows += [(block, None, None, doc_ids, lengths, _stream(place_of[np.concatenate(numbers)]))
                 for doc_ids, lengths, numbers in self.rows]
        return pd.DataFrame(rows, columns=[c.split()[0] for c in _CUT_TYPE.split(", ")], dtype=object)


def _cut(docs: DataFrame, pattern: str, buckets: int) -> DataFrame:
    """Blocks of documents: their vocabularies by bucket, and their documents as numbers of words."""
    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        by, place = regex.compile(pattern), TaskContext.get().partitionId()
        block, done = _Block(by, buckets), 0
        for frame in frames:
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                block.add(doc_id if isinstance(doc_id, str) else None, text if isinstance(text, str) else "")
                if block.chars >= BLOCK_CHARS:
                    yield block.table(f"{place}-{done}")
                    block, done = _Block(by, buckets), done + 1
        if block.rows:
            yield block.table(f"{place}-{done}")

    return docs.mapInPandas(lambda frames: giving_back(cut(frames)), _CUT_TYPE)


def _stored_by_block(cut: DataFrame, parts: int) -> DataFrame:
    """Blocks written to the shared folder in ``parts`` buckets by their name.

    The documents of a block then wait where its ids will come to, and are not shuffled.
    """
    spark = cut.sparkSession
    name = f"blocks_{uuid.uuid4().hex}"
    (cut.write.format("parquet").option("compression", "none").option("path", scratch_folder(spark))
     .bucketBy(parts, "block").saveAsTable(name))
    return spark.table(name)


def encode(docs: DataFrame, rank_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text",
           buckets: int | None = None, decoded: bool = False) -> DataFrame:
    """doc_id and ``ids`` (array of int) of every row, as the vocabulary's merges of each pre-token give them.

    With ``decoded`` also the bytes that the ids stand for, which the task that puts a document together looks up in
    the table of token bytes: ``decode`` would take another Python worker beside it.

    Null and empty texts have no ids. Null and repeated ids stay rows of their own; an empty table gives
    no rows; further columns are left out. The rank file is read once on the driver and sent to the tasks:
    its size is that of the vocabulary. ``buckets`` deal out the words; by default they follow the number of
    rows to the power 0.6, about as the distinct words of a text do, within ``BUCKETS``.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    rows = docs.count()
    if buckets is None:
        buckets = min(max(BUCKETS[0], math.ceil((rows / 4096) ** 0.6)), BUCKETS[1])
    ranks = spark.sparkContext.broadcast(load_ranks(rank_path))
    by_id = spark.sparkContext.broadcast(token_bytes(rank_path) if decoded else None)
    kind = docs.schema[doc_id].dataType
    texts = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))
    cut = _stored_by_block(_cut(texts, pattern, buckets), min(max(12, rows // 8192), 20_000))

    def encode_words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by bucket; a bucket's distinct words are encoded at their first row."""
        bpe = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks.value, special_tokens={})
        # Ids are kept as bytes, as a bucket has far more words than an array each would leave room for.
        known: dict[bytes, bytes] = {}
        now = None
        for frame in frames:
            out = []
            for bucket, packed in zip(frame["bucket"], frame["words"]):
                if bucket != now or len(known) > KNOWN_WORDS:
                    known, now = {}, bucket
                found = []
                for word in _unpacked(packed):
                    ids = known.get(word)
                    if ids is None:
                        whole = ranks.value.get(word)
                        listed = [whole] if whole is not None else bpe.encode_ordinary(word.decode("utf-8", "surrogatepass"))
                        ids = known[word] = array("I", listed).tobytes()
                    found.append(ids)
                lengths = np.fromiter(map(len, found), np.uint32, len(found)) // 4
                out.append((_planes(lengths), _planes(np.frombuffer(b"".join(found), np.uint32))))
            yield pd.DataFrame({"block": frame["block"], "bucket": frame["bucket"],
                                "lengths": [o[0] for o in out], "ids": [o[1] for o in out]})

    vocabularies = cut.filter("bucket IS NOT NULL").select("block", "bucket", "words")
    encoded = vocabularies.repartition("bucket").sortWithinPartitions("bucket").mapInPandas(
        lambda frames: giving_back(encode_words(frames)), "block string, bucket int, lengths binary, ids binary")
    numbered = cut.filter("bucket IS NULL").select("block", "doc_ids", "lengths", "numbers")

    def put_together(documents: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        """The ids of a block's documents, from the ids of its words by bucket and the numbers of all words."""
        is_order = documents["doc_ids"].isna()
        numbers = _from_planes(documents["numbers"][is_order].iloc[0])
        documents, words = documents[~is_order], words.sort_values("bucket") if len(words) else words
        listed = [(_from_planes(s), _from_planes(i)) for s, i in zip(words["lengths"], words["ids"])] if len(words) else []
        sizes, flat = (np.concatenate([x[k] for x in listed] or [np.zeros(0, np.uint32)]) for k in range(2))
        lengths, begins = np.zeros(len(numbers), np.int64), np.zeros(len(numbers), np.int64)
        lengths[numbers] = sizes
        begins[numbers] = np.cumsum(sizes, dtype=np.int64) - sizes
        doc_ids, found = [], []
        for own, word_counts, packed in zip(documents["doc_ids"], documents["lengths"], documents["numbers"]):
            numbers = _from_stream(packed)
            counts = lengths[numbers]
            ends = np.cumsum(counts)
            ids = flat[np.repeat(begins[numbers] - (ends - counts), counts) + np.arange(counts.sum())].astype(np.int32)
            upto = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(word_counts).astype(np.int64)))]
            doc_ids += list(own)
            found += [ids[s:e] for s, e in zip(upto, upto[1:])]
        out = {"doc_id": pd.Series(doc_ids, dtype=object), "ids": pd.Series(found, dtype=object)}
        if decoded:
            out["decoded"] = pd.Series([bytes_of(own, by_id.value) for own in found], dtype=object)
        return pd.DataFrame(out)

    more = ["decoded"] if decoded else []
    together = numbered.groupBy("block").cogroup(encoded.groupBy("block")).applyInPandas(
        put_together, "doc_id string, ids array<int>" + "".join(f", {c} binary" for c in more))
    return together.select(F.col("doc_id").cast(kind).alias("doc_id"), "ids", *more)


def token_bytes(rank_path: str) -> tuple[bytes, np.ndarray]:
    """All token bytes in the order of their ids, and where each begins; an id without a token is empty."""
    ranks = load_ranks(rank_path)
    by_id = dict(sorted((i, token) for token, i in ranks.items()))
    listed = [by_id.get(i, b"") for i in range(max(by_id, default=-1) + 1)]
    return b"".join(listed), np.concatenate(([0], np.cumsum([len(t) for t in listed]))).astype(np.int64)


def bytes_of(ids: np.ndarray, table: tuple[bytes, np.ndarray]) -> bytes:
    """The bytes of ids one after the other; an id outside the table is an error."""
    flat, begins = np.frombuffer(table[0], np.uint8), table[1]
    own = np.asarray(ids, dtype=np.int64)
    counts = begins[own + 1] - begins[own]
    shift = begins[own] - (np.cumsum(counts) - counts)
    return flat[np.repeat(shift, counts) + np.arange(counts.sum())].tobytes()


def decode(ids: Column, spark: SparkSession, rank_path: str) -> Column:
    """The bytes that an array of ids stands for; null for null.

    The table of token bytes is sent to the tasks: its size is that of the vocabulary. An id outside it is an error.
    """
    table = spark.sparkContext.broadcast(token_bytes(rank_path))

    @F.pandas_udf("binary")
    def joined(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = [None if own is None else bytes_of(own, table.value) for own in batch]
            yield pd.Series(out, dtype=object)

    # Not to be evaluated once more for a filter on its result.
    return joined.asNondeterministic()(ids)
