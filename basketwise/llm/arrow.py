"""Walking over the texts of Arrow batches as bytes, and words and hashes of them."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
#: the white space of the word pattern ``[^\x20\x09-\x0D]+``
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def text_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; a null is an empty text."""
    column = column.cast(pa.string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, dtype=np.uint8)
    return data, offsets.astype(np.int64)


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole rows with about ``limit`` bytes: first row, end row, bytes, offsets from 0."""
    if len(column) == 0:
        return
    data, offsets = text_column(column)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


@lru_cache(maxsize=2)
def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    forward = np.full(length, _BASE, dtype=np.uint64)
    back = np.full(length, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
    forward[0] = back[0] = 1
    return np.cumprod(forward, dtype=np.uint64), np.cumprod(back, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(32)
    return h


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word in the bytes of several texts, and the first word of each text."""
    solid = ~_SPACE[data]
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    begins, closes = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    closes[:-1] &= ~solid[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    begins[inner] = solid[inner]  # words end with their text
    closes[inner - 1] = solid[inner - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """A 64-bit hash of each word, from one running sum over the bytes."""
    size = 1 << max(20, (len(data) + 1).bit_length())
    forward, back = _powers(size)
    values = (_LOWER[data] if lower else data).astype(np.uint64)
    values += np.uint64(1)
    values *= forward[: len(data)]
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    h = (total[ends] - total[starts]) * back[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` values from each position on; the last ``k - 1`` positions have none."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    factor = 0xA0761D6478BD642F
    for i in range(k):
        out += hashes[i : i + n] * np.uint64(factor)
        factor = factor * 0x2545F4914F6CDD1D & _MASK | 1
    return mix(out)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` neighbours."""
    have = 1
    out = values
    while have * 2 <= width:
        out = np.minimum(out[: len(out) - have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out
