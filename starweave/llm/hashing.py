"""Word hashes of many texts at once, straight from the bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
GOLDEN = U(0x9E3779B97F4A7C15)
CHUNK_BYTES = 1_000_000

_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(2024).integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that scatters close values (the splitmix finaliser)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(n: int) -> np.ndarray:
    return np.concatenate([np.ones(1, U), np.cumprod(np.full(n, GOLDEN, U))])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the n+1 offsets of its texts; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets


def word_chunks(column: pa.Array, lower: bool = False) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, last row + 1, hash of every word, words per row) for runs of rows.

    A run holds about CHUNK_BYTES of text, or one text that is longer. Hashes are never 0.
    """
    data, offsets = text_bytes(column)
    rows, first = len(offsets) - 1, 0
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1
        last = min(rows, max(last, first + 1))
        part = data[offsets[first] : offsets[last]]
        hashes, counts = _hash_words(part, offsets[first : last + 1] - offsets[first], lower)
        yield first, last, hashes, counts
        first = last


def _hash_words(part: np.ndarray, bounds: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    word = ~_WHITE[part]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    inner = bounds[:-1][bounds[:-1] < len(part)]
    begins[inner] = word[inner]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, U), np.zeros(len(bounds) - 1, np.int64)
    within = np.arange(len(part)) - starts[np.maximum(np.cumsum(begins) - 1, 0)]
    within[~word] = 0
    values = _BYTE[_LOWER[part] if lower else part] * powers(int(within.max()))[within]
    values[~word] = 0
    hashes = mix(np.add.reduceat(values, starts))
    hashes[hashes == 0] = 1
    return hashes, np.diff(np.searchsorted(starts, bounds))
