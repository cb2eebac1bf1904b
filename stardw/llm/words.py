"""Words of whole texts as flat arrays: byte classes, word hashes, rolling windows.

Every operator that works on words reads texts in blocks of about ``BLOCK_BYTES``, so the memory
of a task does not depend on the size of a partition. A single longer text is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 19
# Bytes hashed at once; keeps the temporary arrays in the processor's cache.
HASH_BYTES = 1 << 18

_bytes = np.arange(256)
# [^\x20\x09-\x0D]+ : anything but ASCII white space. Holds for UTF-8 bytes as for code points.
NOT_SPACE = ~((_bytes == 0x20) | ((_bytes >= 0x09) & (_bytes <= 0x0D)))
# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ : ASCII digits, lower-case letters, and all beyond ASCII.
ALNUM = ((_bytes >= 0x30) & (_bytes <= 0x39)) | ((_bytes >= 0x61) & (_bytes <= 0x7A)) | (_bytes >= 0x80)
FOLD = np.where((_bytes >= 0x41) & (_bytes <= 0x5A), _bytes + 32, _bytes).astype(np.uint8)

_draw = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _draw.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = 1024
_PLACE = _draw.integers(1, 2**63, _PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LATER = np.uint64(0x9E3779B97F4A7C15)
_WINDOW = _draw.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0xD1342543DE82EF95)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(32))) * _LATER
    h = (h ^ (h >> np.uint64(29))) * _STEP
    return h ^ (h >> np.uint64(32))


def blocks(batches: Iterable[pa.RecordBatch], column: str = "text",
           limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in slices whose ``column`` holds about ``limit`` bytes, at least one row each."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0))
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def raw_bytes(texts: pa.Array, fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows end to end, and each row's bounds. Null: empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]] if data else np.zeros(0, np.uint8)
    return (FOLD[data] if fold else data), bounds - bounds[0]


@dataclass
class Words:
    """Words of the rows of a block; ``first[r]:first[r + 1]`` are those of row ``r``."""

    data: np.ndarray
    bounds: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.count)

    @property
    def left(self) -> np.ndarray:
        """Words from each word to the end of its row, itself included."""
        return np.repeat(self.first[1:], self.count) - np.arange(len(self.start))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        out = np.empty(len(self.start), np.uint64)
        sizes = self.end - self.start
        ends = np.cumsum(sizes)
        at = 0
        while at < len(out):
            to = max(at + 1, int(np.searchsorted(
                ends, (ends[at - 1] if at else 0) + HASH_BYTES, "right")))
            size = sizes[at:to]
            heads = np.concatenate(([0], np.cumsum(size)[:-1]))
            place = np.arange(int(size.sum())) - np.repeat(heads, size)
            value = _BYTE[self.data[place + np.repeat(self.start[at:to], size)]]
            value = value * _PLACE[place & (_PLACES - 1)]
            if size.max(initial=0) > _PLACES:
                value *= (place >> 10).astype(np.uint64) * _STEP * np.uint64(2) + np.uint64(1)
            out[at:to] = np.add.reduceat(value, heads)
            at = to
        return mix(out)


def words_of(texts: pa.Array, is_word: np.ndarray = NOT_SPACE, fold: bool = False) -> Words:
    """Find the words of every row: runs of bytes of the class ``is_word``."""
    data, bounds = raw_bytes(texts, fold)
    inside = is_word[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    filled = bounds[:-1] < bounds[1:]
    heads, tails = bounds[:-1][filled], bounds[1:][filled] - 1
    begins[heads] = inside[heads]
    ends[tails] = inside[tails]
    start = np.flatnonzero(begins)
    return Words(data, bounds, start, np.flatnonzero(ends) + 1, np.searchsorted(start, bounds))


def windows(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive entries, as many as fit; rows are not kept apart."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    if size <= 16:
        out = h[:n] * _WINDOW[0]
        for k in range(1, size):
            out += h[k:k + n] * _WINDOW[k]
        return mix(out)
    def powers(base: int) -> np.ndarray:
        out = np.full(len(h), base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * powers(int(_STEP)), dtype=np.uint64)))
    # Every window as if it were the first.
    return mix((sums[size:] - sums[:n]) * powers(pow(int(_STEP), -1, 1 << 64))[:n])


def covered(start: np.ndarray, size: int | np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` places lie in any stretch ``start .. start + size``."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, start, 1)
    np.add.at(steps, start + size, -1)
    return np.cumsum(steps[:n]) > 0
