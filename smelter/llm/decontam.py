"""Benchmark decontamination: which documents contain which test items.

An item of ``m`` distinct shingles is contained in a document that has at least ``need(m)`` of them.
Items are partitioned by size: the size fixes how long an item's MinHash sketch is, namely its
``m - need(m) + 1`` smallest shingle hashes. A document that contains the item lacks at most
``m - need(m)`` of its shingles and so has at least one of the sketch. Unlike bands over
signatures of whole documents, whose similarity to a short item is near zero, the sketches therefore
miss nothing, however long the document. Documents with too few shingles for an item are passed over.
Whatever meets a sketch is verified by the exact shares of shingles, word by word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.llm.batches import bound_batches, giving_back
from smelter.llm.hashing import NON_ALPHANUMERIC, chunks, distinct_per_text, shingle_hashes, word_hashes
from smelter.operators.lineage import cut_lineage

SHINGLE_WORDS = 5
#: Containment as whole numbers: at least NEEDED of every OUT_OF shingles.
NEEDED, OUT_OF = 80, 100
#: Items are sent to the tasks whole while sketches and texts stay below this; beyond it, rows are shuffled.
BROADCAST_BYTES = 32 * 1024 * 1024

_MATCH_TYPE = "item_id bigint, shared bigint, item_shingles bigint"
_WORD_RE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _sets(texts: list[str | None], n: int) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each lower-cased text, sorted."""
    for _, raws in chunks(texts):
        hashes, counts = shingle_hashes(*word_hashes(raws, NON_ALPHANUMERIC), n)
        hashes, counts = distinct_per_text(hashes, counts)
        yield from np.split(hashes, np.cumsum(counts)[:-1])


#: Bytes of a worker's memory for a byte of an item's text, whose shingles are held as tuples of words.
HELD_BYTES = 40


def _shingles(text: str, n: int) -> set[tuple[str, ...]]:
    """The distinct shingles themselves; fewer words than ``n`` make one."""
    words = re.findall(_WORD_RE, text)
    if not words:
        return set()
    return {tuple(words[i:i + n]) for i in range(max(len(words) - n + 1, 1))}


def need(size: int, needed: int = NEEDED, out_of: int = OUT_OF) -> int:
    """How many of ``size`` shingles a document must have."""
    return max(1, -(-needed * size // out_of))


class _Index:
    """Sketches of some items, for probing with the shingles of documents."""

    def __init__(self, items: list[tuple[int, str]], n: int, needed: int, out_of: int):
        self.items, self.n, self.needed, self.out_of = items, n, needed, out_of
        self.shingles = [_shingles(text, n) for _, text in items]
        hashes, owners = [], []
        for i, own in enumerate(_sets([text for _, text in items], n)):
            sketch = own[:len(own) - need(len(own), needed, out_of) + 1] if len(own) else own
            hashes.append(sketch)
            owners.append(np.full(len(sketch), i))
        flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.hashes, self.owners = flat[order], (np.concatenate(owners) if owners else np.zeros(0, int))[order]
        self.marks = np.zeros(1 << 20, bool)
        self.marks[(self.hashes >> np.uint64(44)).astype(np.int64)] = True

    def matches(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, int]]:
        """(place of the text, place of the item, shared, item's size) of every verified pair."""
        for first, raws in chunks(texts):
            hashes, counts = shingle_hashes(*word_hashes(raws, NON_ALPHANUMERIC), self.n)
            met = np.flatnonzero(self.marks[(hashes >> np.uint64(44)).astype(np.int64)])
            left = np.searchsorted(self.hashes, hashes[met], "left")
            right = np.searchsorted(self.hashes, hashes[met], "right")
            met, left, right = (x[right > left] for x in (met, left, right))
            text_of = np.searchsorted(np.cumsum(counts), met, "right")
            found = {(int(t), int(o)) for t, a, b in zip(text_of, left, right) for o in self.owners[a:b]}
            own: dict[int, set] = {}
            for t, o in sorted(found):
                least = need(len(self.shingles[o]), self.needed, self.out_of)
                if counts[t] < least:
                    continue
                if t not in own:
                    own = {t: _shingles(raws[t].decode("utf-8", "surrogatepass"), self.n)}
                shared = len(own[t] & self.shingles[o])
                if shared >= least:
                    yield first + t, o, shared, len(self.shingles[o])


def find_contained(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id",
                   text: str = "text", n: int = SHINGLE_WORDS, needed: int = NEEDED, out_of: int = OUT_OF,
                   broadcast_bytes: int = BROADCAST_BYTES, every_item: bool = True) -> DataFrame:
    """doc_id, item_id, shared and item_shingles for every document that contains an item.

    Words are runs of letters and digits of the lower-cased text (anything beyond ASCII counts); a text of
    fewer than ``n`` words is one shingle, one without words or a null one contains and is nothing.
    Documents with a null id are reported with a null id; rows that repeat an id and pair give one row
    with the most shared; items that repeat an id with other texts count one by one. Empty tables give
    no rows; further columns are left out.

    Items without an id are reported with a null one, and an item of fewer than ``n`` words is met by its run of words
    anywhere in a document: items are partitioned by their size in words up to ``n``, and documents are read once per
    partition. Without ``every_item`` items with a null id take no part, and a shorter item meets only documents of just its words.

    Items up to ``broadcast_bytes`` are sent to the tasks and the documents are read once without a shuffle.
    Beyond that, the sketches and the documents' shingle hashes meet by an equi-join on the hash.
    """
    bound_batches(docs.sparkSession)
    tests = items.select(F.col(item_id).cast("bigint").alias("item_id"), F.lower(F.col(text)).alias("text")).filter(
        F.coalesce(F.trim("text"), F.lit("")) != "").distinct()
    lengths = {n: tests if every_item else tests.filter("item_id IS NOT NULL")}
    if every_item:
        tests = cut_lineage(tests.withColumn("words", F.least(F.size(F.regexp_extract_all("text", F.lit(_WORD_RE), F.lit(0))), F.lit(n))))
        present = sorted(r["words"] for r in tests.filter("words > 0").select("words").distinct().collect())
        lengths = {m: tests.filter(F.col("words") == m).drop("words") for m in present or [n]}
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.lower(F.col(text)).alias("text"))
    found = None
    for length, some in lengths.items():
        size = some.agg(F.sum(F.octet_length("text") * HELD_BYTES + 64)).collect()[0][0] or 0
        find = _by_broadcast if size <= broadcast_bytes else _by_shuffle
        more = find(texts, some, length, needed, out_of).select("doc_id", "item_id", "shared", "item_shingles")
        found = more if found is None else found.unionByName(more)
    return (found.groupBy("doc_id", "item_id")
            .agg(F.max("shared").alias("shared"), F.max("item_shingles").alias("item_shingles")))


def _by_broadcast(texts: DataFrame, tests: DataFrame, n: int, needed: int, out_of: int) -> DataFrame:
    held = sorted(((r["item_id"], r["text"]) for r in tests.collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    spread = texts.sparkSession.sparkContext.broadcast(held)

    def matches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = _Index(spread.value, n, needed, out_of)
        for batch in batches:
            out: list[list[dict]] = [[] for _ in range(len(batch))]
            for t, o, shared, size in index.matches([x if isinstance(x, str) else None for x in batch]):
                out[t].append({"item_id": index.items[o][0], "shared": shared, "item_shingles": size})
            yield pd.Series(out)

    @F.pandas_udf(f"array<struct<{_MATCH_TYPE.replace(' ', ':').replace(',:', ',')}>>")
    def probe(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from giving_back(matches(batches))

    found = texts.select("doc_id", probe.asNondeterministic()("text").alias("found"))
    return found.select("doc_id", F.inline("found"))


def _by_shuffle(texts: DataFrame, tests: DataFrame, n: int, needed: int, out_of: int) -> DataFrame:
    @F.pandas_udf("array<bigint>")
    def shingle_sets(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([s.astype(np.int64) for s in _sets([x if isinstance(x, str) else None for x in batch], n)])

    # Sorted as unsigned numbers, so the first ones are the smallest hashes.
    tests = tests.withColumn("key", F.xxhash64("text"))
    sized = tests.select("item_id", "key", shingle_sets.asNondeterministic()("text").alias("grams"))
    least = F.greatest(F.ceil(F.size("grams") * needed / out_of), F.lit(1))
    sketches = sized.withColumn("least", least).select(
        "item_id", "key", "least", F.explode(F.slice("grams", 1, F.greatest(
            F.size("grams") - F.col("least") + 1, F.lit(0)).cast("int"))).alias("gram"))
    # Rows are told apart by id and text, so rows of one id, or of none, meet only their own hits.
    texts = texts.withColumn("text_key", F.xxhash64("text"))
    grams = texts.select("doc_id", "text_key", shingle_sets.asNondeterministic()("text").alias("grams")).select(
        "doc_id", "text_key", F.size("grams").alias("doc_size"), F.explode("grams").alias("gram"))
    met = grams.join(sketches, "gram").filter(F.col("doc_size") >= F.col("least"))
    pairs = cut_lineage(met.select(F.col("doc_id").alias("met_doc"), F.col("text_key").alias("met_text"), F.col("item_id").alias("met_id"),
                                   F.col("key").alias("met_key")).distinct())
    met_texts = texts.join(pairs, F.col("doc_id").eqNullSafe(F.col("met_doc")) & (F.col("text_key") == F.col("met_text")))
    both = met_texts.join(tests.withColumnRenamed("text", "item_text"),
                          F.col("item_id").eqNullSafe(F.col("met_id")) & (F.col("key") == F.col("met_key")))

    @F.pandas_udf("struct<shared:bigint,item_shingles:bigint>")
    def shares(doc: pd.Series, item: pd.Series) -> pd.DataFrame:
        rows = [(_shingles(d or "", n), _shingles(i, n)) for d, i in zip(doc, item)]
        return pd.DataFrame({"shared": [len(d & i) for d, i in rows], "item_shingles": [len(i) for _, i in rows]})

    counted = both.select("doc_id", "item_id", shares.asNondeterministic()("text", "item_text").alias("s")).select("doc_id", "item_id", "s.*")
    return counted.filter((F.col("item_shingles") > 0) & (
        F.col("shared") * out_of >= F.col("item_shingles") * needed))


def contaminated_ids(found: DataFrame) -> DataFrame:
    """The distinct document ids of a result of ``find_contained``."""
    return found.select("doc_id").distinct()
