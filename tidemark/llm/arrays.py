"""Texts of Arrow batches as flat numpy arrays, and words, hashes and ragged slices of them.

A batch is cut into chunks of whole texts so that the arrays, which take several times the
bytes of the text, stay small; one text is never divided.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20

# The separators of words in every contract, bytes 0x20 and 0x09 to 0x0D.
SEPARATORS = np.zeros(256, bool)
SEPARATORS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def text_chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` per chunk; a null text has no bytes."""
    raw = texts.cast(pa.large_binary()).fill_null(b"")
    if not len(raw):
        return
    buffers = raw.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(raw):
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), len(raw))
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word, in order."""
    inside = ~SEPARATORS[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    ends = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    first[begins] = inside[begins]
    last[ends] = inside[ends]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, side="right") - 1


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, CHUNK_BYTES + 1)
        factors = np.full(size, _BASE, np.uint64)
        factors[0] = 1
        _powers = np.cumprod(factors, dtype=np.uint64)
        factors[1:] = pow(_BASE, -1, 1 << 64)
        _inverses = np.cumprod(factors, dtype=np.uint64)
    return _powers, _inverses


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class SpanHashes:
    """64-bit hashes of slices; equal slices have equal hashes wherever they stand."""

    def __init__(self, symbols: np.ndarray) -> None:
        powers, self._inverses = _power_tables(len(symbols) + 1)
        self._sums = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum((symbols.astype(np.uint64) + np.uint64(1)) * powers[: len(symbols)], out=self._sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        lengths = (ends - starts).astype(np.uint64)
        return mixed((self._sums[ends] - self._sums[starts]) * self._inverses[starts] + mixed(lengths))


def span_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """`SpanHashes` of one set of slices."""
    return SpanHashes(symbols)(starts, ends)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions ``start .. start + length - 1`` of all slices, one after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)


def binary(data: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A large binary or large string array over the bytes."""
    buffers = [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, buffers).cast(kind)
