"""Language identification by compression: the language whose dictionary makes a text smallest.

Per language a zstandard raw-content dictionary is made of labelled texts. A text is lower-cased,
cut into pieces of ``PIECE_BYTES`` (all of them count), and every piece is compressed with every dictionary.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.llm.batches import bound_batches, giving_back
from smelter.llm.sampling import smallest_hashes

PIECE_BYTES = 1024
LEVEL = 6
#: Bytes of difference that make one language e times likelier than another.
TEMPERATURE = 2.0
#: A prediction below this score has too narrow a margin.
LEAST_SCORE = 0.4
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")


#: Places of a text from which a dictionary takes ``SLICE_CHARS`` characters each.
SLICES, SLICE_CHARS = 4, 250


def _slices(text: Column) -> Column:
    """Characters from a few places of the whole text, which its hash chooses; a short text whole."""
    room = F.length(text) - SLICES * SLICE_CHARS
    # One place in each quarter of what is left over.
    places = [F.floor((F.lit(i) + F.pmod(F.xxhash64(text, F.lit(i)), F.lit(1000)) / 1000) * room / SLICES).cast("int") + i * SLICE_CHARS + 1
              for i in range(SLICES)]
    return F.when(room <= 0, text).otherwise(F.concat_ws("\n", *(F.substring(text, p, F.lit(SLICE_CHARS)) for p in places)))


def fit_dictionaries(labelled: DataFrame, text: str = "text", lang: str = "lang", rows_per_lang: int = 256,
                     languages: int = 64) -> dict[str, bytes]:
    """A dictionary per language from a bounded sample of its distinct texts.

    The sample holds at most ``rows_per_lang`` texts of each of at most ``languages`` languages (those with the most distinct
    texts), those with the smallest hashes, and of each text ``SLICES`` slices from places all over it; so a dictionary has at
    most 256,000 characters. Null and empty texts and null languages teach nothing. Texts are ranked as hashes, each once, so
    groups of copies weigh no more than one, and only hashes under a cutoff are ranked, so no language's texts meet in one
    task; the chosen hashes (16 bytes and a label each) then pick their texts.
    """
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("h")
                           ).filter("lang IS NOT NULL AND text <> ''")
    chosen = smallest_hashes(rows.select("lang", "h"), "lang", rows_per_lang, groups=languages).distinct()
    sample = rows.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h").agg(F.min(_slices(F.col("text"))).alias("text")).collect()
    texts: dict[str, list[str]] = {}
    for row in sorted(sample, key=lambda r: (r["lang"], r["h"])):
        texts.setdefault(row["lang"], []).append(row["text"].lower())
    return {name: "\n".join(parts).encode("utf-8", "surrogatepass") for name, parts in sorted(texts.items())}


def compressed_sizes(raw: bytes, compressors: list[zstandard.ZstdCompressor]) -> np.ndarray:
    """Bytes of the text under each dictionary, summed over its pieces."""
    sizes = np.zeros(len(compressors), np.int64)
    for start in range(0, len(raw), PIECE_BYTES):
        piece = raw[start:start + PIECE_BYTES]
        sizes += [len(c.compress(piece)) for c in compressors]
    return sizes


def compressors_of(dictionaries: dict[str, bytes]) -> list[zstandard.ZstdCompressor]:
    out = []
    for content in dictionaries.values():
        data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(level=LEVEL)
        out.append(zstandard.ZstdCompressor(dict_data=data, write_content_size=False, write_checksum=False))
    return out


def predict(text: str | None, names: list[str], compressors: list[zstandard.ZstdCompressor]) -> tuple[str, float]:
    """The language of the smallest size and its share when sizes count as likelihoods; ties go to the first name."""
    if not text or not names or not _LETTER.search(text):
        return UNKNOWN, 0.0
    sizes = compressed_sizes(text.lower().encode("utf-8", "surrogatepass"), compressors)
    best = int(sizes.argmin())
    return names[best], float(1 / np.exp(-(sizes - sizes[best]) / TEMPERATURE).sum())


def language_of(text: Column, dictionaries: dict[str, bytes]) -> Column:
    """Struct of ``lang``, ``score`` and ``accepted`` for a text column.

    Null texts, empty texts and texts without a letter are ``und`` with score 0 and not accepted; so is
    every text when nothing was learned. A score below ``LEAST_SCORE`` is not accepted. The dictionaries, of
    bounded size for each language, travel with the function.
    """
    names = list(dictionaries)
    bound_batches(SparkSession.active())

    def guesses(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        ready = compressors_of(dictionaries)
        for batch in batches:
            found = [predict(t if isinstance(t, str) else None, names, ready) for t in batch]
            yield pd.DataFrame(found, columns=["lang", "score"])

    @F.pandas_udf("lang string, score double")
    def guess(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from giving_back(guesses(batches))

    # Not to be evaluated once more for a filter on its result.
    guessed = guess.asNondeterministic()(text)
    return F.struct(guessed["lang"].alias("lang"), guessed["score"].alias("score"),
                    (guessed["score"] >= LEAST_SCORE).alias("accepted"))


def identify(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``accepted``; columns of these names are replaced.

    One row per row, in any order: null and repeated ids stay; an empty table gives none.
    """
    kept = docs.drop("lang_pred", "score", "accepted")
    found = kept.withColumn("_found", language_of(F.col(text), dictionaries))
    return found.select(*(F.col(f"`{c}`") for c in kept.columns), F.col("_found.lang").alias("lang_pred"),
                        F.col("_found.score").alias("score"), F.col("_found.accepted").alias("accepted"))
