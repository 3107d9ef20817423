"""Words of whole Arrow string columns and hashes of word sequences, as numpy arrays.

A column is handled as one byte buffer: a table says which bytes belong to words, and the hash
of any byte or word range is a difference of two running sums. There is no Python loop over
words, and a text is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa

_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD1342543DE82EF95
_SECOND_BASE = 0xAF251AF3B0F025B5


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer of 64-bit hashes: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


_BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_WORD_BASE))
_powers_of: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    known = _powers_of.get(base)
    if known is None or known.size < n:
        size = max(n, 1 << 16, 0 if known is None else known.size * 2)
        factors = np.full(size, base, dtype=np.uint64)
        factors[0] = 1
        known = _powers_of[base] = np.multiply.accumulate(factors)
    return known[:n]


def byte_values(data: np.ndarray) -> np.ndarray:
    """A 64-bit value for each byte, to hash byte ranges by."""
    return _BYTE_VALUES[data]


class RangeHash:
    """Hash of any range of a number sequence, equal for equal content at any place."""

    def __init__(self, values: np.ndarray, base: int):
        self._base = base
        self._inverse = pow(base, -1, 1 << 64)
        self._sums = np.zeros(values.size + 1, dtype=np.uint64)
        np.cumsum(values * _powers(base, values.size), out=self._sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        back = _powers(self._inverse, self._sums.size)[start]
        length = (end - start).astype(np.uint64) * np.uint64(_SECOND_BASE)
        return mixed((self._sums[end] - self._sums[start]) * back + length)


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Digits, ASCII letters and everything outside ASCII.
ALPHANUMERIC = byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
#: Everything but ASCII white space.
NON_SPACE = ~byte_set((0x20, 0x20), (0x09, 0x0D))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def column_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the place where each text begins; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def runs(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each longest run of True that does not cross a bound."""
    border = np.zeros(inside.size + 1, dtype=bool)
    border[bounds] = True
    fresh = np.ones(inside.size, dtype=bool)
    fresh[1:] = ~inside[:-1]
    last = np.ones(inside.size, dtype=bool)
    last[:-1] = ~inside[1:]
    starts = np.flatnonzero(inside & (fresh | border[:-1]))
    ends = np.flatnonzero(inside & (last | border[1:])) + 1
    return starts, ends


@dataclass
class Words:
    """Words of the texts of one column piece; word ``j`` is ``data[starts[j]:ends[j]]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # text i has the words first[i] to first[i + 1]

    @classmethod
    def of(cls, texts: pa.Array, inside: np.ndarray, lower: bool = False) -> Words:
        data, bounds = column_bytes(texts)
        if lower:
            data = _LOWER[data]
        starts, ends = runs(inside[data], bounds)
        return cls(data, starts, ends, np.searchsorted(starts, bounds))

    @cached_property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @cached_property
    def text_of(self) -> np.ndarray:
        """Number of the text that each word belongs to."""
        return np.repeat(np.arange(self.counts.size), self.counts)

    @cached_property
    def hashes(self) -> np.ndarray:
        return RangeHash(byte_values(self.data), _BYTE_BASE)(self.starts, self.ends)

    @cached_property
    def _windows(self) -> RangeHash:
        return RangeHash(self.hashes, _WORD_BASE)

    @cached_property
    def _second(self) -> RangeHash:
        return RangeHash(mixed(self.hashes ^ np.uint64(_SECOND_BASE)), _SECOND_BASE)

    def window_starts(self, length: int) -> np.ndarray:
        """Words at which a window of ``length`` words of one text begins."""
        return np.flatnonzero(self.first[1:][self.text_of] - np.arange(self.starts.size) >= length)

    def window_hashes(self, starts: np.ndarray, length: int | np.ndarray, second: bool = False) -> np.ndarray:
        return (self._second if second else self._windows)(starts, starts + length)

    def text_hashes(self, second: bool = False) -> np.ndarray:
        """Hash of each text's whole word sequence."""
        return self.window_hashes(self.first[:-1], self.counts, second)

    def word(self, j: int) -> bytes:
        return self.data[self.starts[j] : self.ends[j]].tobytes()


def pieces(batches: Iterator[pa.RecordBatch], text: str, most_bytes: int = 1 << 20, most_rows: int = 1 << 15) -> Iterator[pa.RecordBatch]:
    """Batches cut into slices of about ``most_bytes`` of text, at least one row each.

    Slices bound the memory of a task; rows, and so texts, stay whole.
    """
    for batch in batches:
        _, bounds = column_bytes(batch.column(text))
        start, rows = 0, batch.num_rows
        while start < rows:
            end = int(np.searchsorted(bounds, bounds[start] + most_bytes, side="right")) - 1
            end = min(max(end, start + 1), start + most_rows, rows)
            yield batch.slice(start, end - start)
            start = end


def signed(hashes: np.ndarray) -> pa.Array:
    """64-bit hashes as Spark's LONG."""
    return pa.array(hashes.view(np.int64))
