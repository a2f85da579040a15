"""Words and hashes of many texts at once, over the bytes of an Arrow column."""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 21

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _mixed(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers (the finaliser of splitmix64)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def keys_of(numbers: np.ndarray, seed: int = 0) -> np.ndarray:
    return _mixed(numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 0x2545F491 + 0x632BE5AB))


_LETTER = keys_of(np.arange(256), 1)
_PLACE = keys_of(np.arange(1 << 12), 2) | np.uint64(1)


def _places(n: int) -> np.ndarray:
    """Odd multiplier of each position in a word."""
    global _PLACE
    if n > len(_PLACE):
        _PLACE = keys_of(np.arange(max(n, 2 * len(_PLACE))), 2) | np.uint64(1)
    return _PLACE


def separators(codes: list[int]) -> np.ndarray:
    out = np.zeros(256, bool)
    out[codes] = True
    return out


WHITE = separators([0x20, *range(0x09, 0x0E)])
# capitals belong to words: hashing lowers them
NOT_ALNUM = separators([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])


def chunks(texts: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``limit`` bytes: (first row, behind the last, bytes, offsets into them).

    A longer text is a run of its own; a null is an empty text.
    """
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        stop = max(first + 1, int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1)
        yield first, stop, raw[bounds[first]:bounds[stop]], bounds[first:stop + 1] - bounds[first]
        first = stop


def words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, number of words before each text and behind the last); no word crosses texts."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~separator[data]
    fresh = np.ones(len(data) + 1, bool)  # a word begins here if the byte belongs to one
    fresh[1:-1] = ~inside[:-1]
    fresh[offsets[offsets < len(data)]] = True
    starts = np.flatnonzero(inside & fresh[:-1])
    behind = np.append(~inside[1:], True) | fresh[1:]
    ends = np.flatnonzero(inside & behind) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, Latin capitals as small letters."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    before = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(before, sizes)
    letters = _LETTER[_LOWER[data[place + np.repeat(starts, sizes)]]]
    sums = np.add.reduceat(letters * _places(int(sizes.max()))[place], before)
    return _mixed(sums + keys_of(sizes, 3))


def shingle_hashes(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each run of ``width`` words, number of runs before each text); shorter texts are one run, empty ones none."""
    total = np.zeros(len(hashes), np.uint64)
    for k in range(width):
        total[:len(hashes) - k] += hashes[k:] * _PLACE[k] if k < len(hashes) else np.uint64(0)
    counts = np.diff(bounds)
    kept = np.maximum(counts - width + 1, np.minimum(counts, 1))
    firsts = np.repeat(bounds[:-1], kept) + np.arange(int(kept.sum())) - np.repeat(np.cumsum(kept) - kept, kept)
    out = total[firsts]
    short = np.flatnonzero((counts > 0) & (counts < width))
    begins = np.cumsum(kept) - kept
    for row in short:
        part = hashes[bounds[row]:bounds[row + 1]]
        out[begins[row]] = (part * _PLACE[:len(part)]).sum(dtype=np.uint64) + np.uint64(len(part))
    return _mixed(out), np.append(begins, kept.sum())
