"""Whole-batch text arrays: UTF-8 buffers, words, lines and rolling hashes without per-row Python."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1

# Fixed value: the white space that ends a word, U+0020 and U+0009 to U+000D.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in one array, and the offsets of each text in it (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return (data[offsets[0] : offsets[-1]], offsets - offsets[0]) if len(offsets) else (data[:0], np.zeros(1, np.int64))


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """The batches cut between rows into parts of about ``most`` bytes of text; a longer text is a part of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = utf8(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def slices(data: np.ndarray, offsets: np.ndarray, most: int = 1 << 17) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bytes and offsets of the texts in parts of about ``most`` bytes, whose arrays fit a processor's cache; a longer text is
    a part of its own."""
    at = 0
    while at < len(offsets) - 1:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def give_back() -> None:
    """Return freed memory, and tables that long texts have made large, to the system. A worker is used again by the next task
    and would hold on to them, beside the others of its executor."""
    if len(_POWERS[0]) > 1 << 18:
        _POWERS[:] = [np.ones(1, U64), np.ones(1, U64)]
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, with memory given back after the last batch of a task."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return tidied


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finish (splitmix64) that spreads every input bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_POWERS = [np.ones(1, U64), np.ones(1, U64)]
_BYTES = mix(np.arange(1, 257, dtype=U64) * U64(_ODD))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64, kept between calls."""
    if len(_POWERS[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        for k, base in enumerate((_ODD, pow(_ODD, -1, 1 << 64))):
            table = np.ones(size, U64)
            filled, step = 1, base
            while filled < size:
                table[filled : 2 * filled] = table[:filled] * U64(step)
                filled, step = 2 * filled, step * step & _MASK
            _POWERS[k] = table
    return _POWERS[0], _POWERS[1]


class Rolling:
    """Hashes of any slices of one byte array, each in constant time."""

    def __init__(self, data: np.ndarray) -> None:
        power, self._inverse = _powers(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, U64)
        np.cumsum(_BYTES[data] * power[: len(data)], out=self._sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self._sums[ends] - self._sums[starts]) * self._inverse[starts] + (ends - starts).astype(U64))

    def windows(self, length: int) -> np.ndarray:
        """Hash of the slice of so many bytes at each place where there are that many."""
        n = max(len(self._sums) - length, 0)
        return mix((self._sums[length:] - self._sums[:n]) * self._inverse[:n] + U64(length))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word; a word never crosses two texts."""
    inside = ~BLANK[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | first[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:-1]
    at = np.flatnonzero(starts)
    return at, np.flatnonzero(ends) + 1, np.searchsorted(offsets, at, "right") - 1


def joined(values: np.ndarray, weights: tuple[int, ...]) -> np.ndarray:
    """Hash of each run of ``len(weights)`` neighbouring values."""
    n = len(values) - len(weights) + 1
    total = np.zeros(max(n, 0), U64)
    for k, weight in enumerate(weights if n > 0 else ()):
        total += values[k : k + n] * U64(weight)
    return mix(total)


def odd_weights(n: int) -> tuple[int, ...]:
    return tuple((pow(_ODD, k + 3, 1 << 64)) | 1 for k in range(n))


def per_text(text_numbers: np.ndarray, n: int) -> np.ndarray:
    """How many entries each of ``n`` texts has."""
    return np.bincount(text_numbers, minlength=n).astype(np.int64)


def with_columns(batch: pa.RecordBatch, extra: dict[str, pa.Array], drop: tuple[str, ...] = ()) -> pa.RecordBatch:
    """``batch`` with ``extra`` columns, which replace columns of the same name; ``drop`` goes."""
    kept = {n: batch.column(n) for n in batch.schema.names if n not in drop and n not in extra}
    return pa.RecordBatch.from_pydict({**kept, **extra})
