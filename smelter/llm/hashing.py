"""Words and word n-grams of many texts as 64-bit hashes, computed by numpy over whole byte buffers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

#: Bytes of text that are hashed at once; bounds the memory of a Python worker, never what is read.
CHUNK_BYTES = 250_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE_VALUES = np.random.Generator(np.random.PCG64(20)).integers(1, 1 << 63, 256, dtype=np.uint64)
_PLACES = np.random.Generator(np.random.PCG64(21)).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def _separators(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low:high + 1] = True
    return table


#: Words are runs of anything but space and 0x09 to 0x0D.
BLANKS = _separators((0x20, 0x20), (0x09, 0x0D))
#: Words are runs of ASCII letters, ASCII digits and anything beyond ASCII.
NON_ALPHANUMERIC = _separators((0, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


def _lower_table() -> np.ndarray:
    table = np.arange(256)
    table[ord("A"):ord("Z") + 1] += 32
    return _BYTE_VALUES[table]


_VALUES = _lower_table()


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_power_cache: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_power_cache.get("up", ())) < n:
        _power_cache["up"], _power_cache["down"] = _powers(_BASE, n), _powers(_INVERSE, n)
    return _power_cache["up"], _power_cache["down"]


def mixed(h: np.ndarray) -> np.ndarray:
    """The bits of each hash spread over all 64."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(32)
    return h


def chunks(texts: Iterable[str | None], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Texts as UTF-8 (null: empty) in runs of about ``limit`` bytes, each with the place of its first."""
    first, held, size, place = 0, [], 0, 0
    for place, text in enumerate(texts):
        raw = b"" if text is None else text.encode("utf-8", "surrogatepass")
        if held and size + len(raw) > limit:
            yield first, held
            first, held, size = place, [], 0
        held.append(raw)
        size += len(raw)
    if held:
        yield first, held


def word_hashes(raws: list[bytes], separators: np.ndarray = BLANKS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z lower-cased, in order, and how many words each text has.

    A text far longer than a chunk is taken in pieces that end between words.
    """
    buffer = np.frombuffer(b" ".join(raws) + b" ", dtype=np.uint8)
    text_ends = np.cumsum(np.fromiter((len(r) + 1 for r in raws), np.int64, len(raws)))
    pieces, begin = [], 0
    while begin < len(buffer):
        end = begin + CHUNK_BYTES * 2
        while end < len(buffer):
            apart = np.flatnonzero(separators[buffer[end:end + CHUNK_BYTES]])
            if len(apart):
                end += int(apart[0])
                break
            end += CHUNK_BYTES
        pieces.append((begin, min(end, len(buffer))))
        begin = pieces[-1][1]
    found = [_piece_hashes(buffer[s:e], separators) for s, e in pieces]
    starts = np.concatenate([own + s for (own, _), (s, _) in zip(found, pieces)])
    upto = np.searchsorted(starts, text_ends)
    return np.concatenate([h for _, h in found]), np.diff(upto, prepend=0)


def _piece_hashes(buffer: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a buffer begin, and their hashes."""
    up, down = _power_tables(len(buffer) + 1)
    apart = np.ones(len(buffer) + 2, dtype=bool)
    apart[1:-1] = separators[buffer]
    edges = np.flatnonzero(apart[1:] != apart[:-1])
    starts, ends = edges[0::2], edges[1::2]
    sums = _VALUES[buffer]
    sums *= up[:len(buffer)]
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(sums, dtype=np.uint64)))
    return starts, mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_hashes(words: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of words, and how many each text has.

    A text of fewer than ``n`` words gives its whole sequence as one; a text without words gives none.
    """
    total = len(words)
    text_of = np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts)
    left = ends[text_of] - np.arange(total) if total else np.zeros(0, np.int64)
    lengths = np.minimum(left, n)
    hashes = np.zeros(total, np.uint64)
    for place in range(n):
        part = np.zeros(total, np.uint64)
        part[:max(total - place, 0)] = words[place:]
        part[lengths <= place] = 0
        hashes += part * _PLACES[place % 64] + np.uint64(place)
    hashes = mixed(hashes + lengths.astype(np.uint64))
    first = np.zeros(total, dtype=bool)
    first[(ends - counts)[counts > 0]] = True
    keep = (left >= n) | first
    return hashes[keep], np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))


def distinct_per_text(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's hashes sorted and without repeats, and how many are left."""
    text_of = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((hashes, text_of))
    hashes, text_of = hashes[order], text_of[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text_of[1:] != text_of[:-1])
    return hashes[new], np.bincount(text_of[new], minlength=len(counts))
