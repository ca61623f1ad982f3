"""Vectorised work on the UTF-8 bytes of Arrow string batches.

All functions take one flat ``uint8`` array and the offsets of the documents
in it, as Arrow stores them, so that no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Bytes worked on at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20
_ODD = 0x9E3779B97F4A7C15

_rng = np.random.default_rng(20240229)
BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.int64).astype(U64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_POWERS = [np.ones(1, dtype=U64), np.ones(1, dtype=U64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of an odd base and of its inverse, modulo 2**64."""
    if len(_POWERS[0]) <= n:
        size = max(n + 1, 2 * len(_POWERS[0]), SLICE_BYTES + 64)
        for k, base in enumerate((_ODD, pow(_ODD, -1, 2**64))):
            made = np.full(size, base, dtype=U64)
            made[0] = 1
            _POWERS[k] = np.multiply.accumulate(made)
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes about half of the output."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    column = pc.fill_null(column.cast(pa.large_binary() if large else pa.binary()), b"")
    _, at, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(at, np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES, most: int | None = None) -> Iterator[tuple[int, int]]:
    """Ranges of at most ``most`` documents and ``limit`` bytes together, or of one document."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        hi = min(hi, n, lo + (most or n))
        yield lo, hi
        lo = hi


def fold(data: np.ndarray) -> np.ndarray:
    """Lower case for ASCII and for the two-byte letters of Latin-1."""
    out = _LOWER[data]
    if len(out) > 1:
        upper = np.flatnonzero((data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[:-1] == 0xC3)) + 1
        out[upper] += 32
    return out


class Words:
    """The words of a slice: first and end byte, document, and prefix sums for hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = IS_SPACE):
        n = len(data)
        gap = breaks[data] if n else np.zeros(0, bool)
        first, last = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
        first[offsets], last[offsets] = True, True
        head, tail = ~gap, ~gap
        if n:
            head[1:] &= gap[:-1] | first[1:n]
            tail[:-1] &= gap[1:] | last[1:n]
        self.start = np.flatnonzero(head)
        self.end = np.flatnonzero(tail) + 1
        self.offsets = offsets
        #: words of document i are first_word[i] to first_word[i + 1]
        self.first_word = np.searchsorted(self.start, offsets)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first_word))
        self.power, self.inverse = _powers(n)
        self.sums = np.zeros(n + 1, U64)
        np.cumsum(BYTE_CODE[data] * self.power[:n], out=self.sums[1:])

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.first_word)

    def hashed(self, start: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit hash of the bytes from start to end, the whole words if not given."""
        start, end = self.start if start is None else start, self.end if end is None else end
        raw = (self.sums[end] - self.sums[start]) * self.inverse[start]
        return mix(raw ^ (end - start).astype(U64))


def byte_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums whose differences, times the inverse power, hash any byte range."""
    power, inverse = _powers(len(data))
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(BYTE_CODE[data] * power[: len(data)], out=sums[1:])
    return sums, inverse


def run_sums(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same over 64-bit values in place of bytes."""
    power, inverse = _powers(len(values))
    sums = np.zeros(len(values) + 1, U64)
    np.cumsum(values * power[: len(values)], out=sums[1:])
    return sums, inverse


def batches(stream: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES, most: int | None = None) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the incoming batches with the bytes and offsets of their texts."""
    for batch in stream:
        if not batch.num_rows:
            continue
        data, offsets = arrays(batch.column(batch.schema.get_field_index(text)))
        for lo, hi in slices(offsets, limit, most):
            yield batch.slice(lo, hi - lo), data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
