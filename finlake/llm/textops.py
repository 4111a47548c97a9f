"""Vectorised helpers on UTF-8 text inside tasks (numpy over Arrow buffers).

A batch of documents is one byte array plus offsets. Words are found with a
byte-class table, hashed with prefix sums of a polynomial over 2**64 and
finished with a 64-bit mixer, so the cost is a handful of array passes per
byte, whatever the number of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
MULTIPLIER = 0x9E3779B97F4A7C15  # odd
SLICE_BYTES = 4 << 20


def _byte_class(*outside: tuple[int, int]) -> np.ndarray:
    """True for the bytes that belong to words: all but the given ranges."""
    table = np.ones(256, dtype=bool)
    for low, high in outside:
        table[low : high + 1] = False
    return table


# Word classes of the contracts, as ranges of bytes outside words.
ALNUM_WORDS = _byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))  # after lower-casing A-Z
SPACE_WORDS = _byte_class((0x20, 0x20), (0x09, 0x0D))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds at most ``limit`` text bytes (or one row)."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    total = np.concatenate([[0], np.cumsum(sizes)])
    start = 0
    while start < len(sizes):
        stop = int(np.searchsorted(total, total[start] + limit, side="right")) - 1
        stop = max(start + 1, min(stop, len(sizes)))
        yield batch.slice(start, stop - start)
        start = stop


def doc_ranges(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of at most ``limit`` bytes (or one document)."""
    start, n = 0, len(offsets) - 1
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = max(start + 1, min(stop, n))
        yield start, stop
        start = stop


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (int64, one more than rows) of a string column; null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    if not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte span of each word; document i holds words first[i]:first[i+1]."""
    inside = table[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    opens[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(opens)
    ends = np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser; a bijection, so it adds no collisions."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


class Powers:
    """Powers of an odd multiplier modulo 2**64 and their inverses, grown on demand."""

    def __init__(self, multiplier: int):
        self.base = multiplier | 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = np.ones(1, U64)
        self.down = np.ones(1, U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            steps = np.full(n, self.base, U64)
            steps[0] = 1
            self.up = np.cumprod(steps)
            steps = np.full(n, self.inverse, U64)
            steps[0] = 1
            self.down = np.cumprod(steps)
        return self.up[:n], self.down[:n]


class SpanHash:
    """Position-independent 64-bit hashes of spans of a byte or integer sequence."""

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(1_000_003 + seed)
        self.table = rng.integers(0, 1 << 63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
        self.powers = Powers((MULTIPLIER + 2 * seed * 0x632BE59BD9B4E019) % (1 << 64))

    def prefix(self, values: np.ndarray) -> np.ndarray:
        up, _ = self.powers.upto(len(values) + 1)
        out = np.zeros(len(values) + 1, U64)
        np.cumsum(values * up[: len(values)], out=out[1:])
        return out

    def bytes_prefix(self, data: np.ndarray) -> np.ndarray:
        return self.prefix(self.table[data])

    def spans(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        _, down = self.powers.upto(len(prefix))
        raw = (prefix[ends] - prefix[starts]) * down[starts]
        return mix(raw + (ends - starts).astype(U64))

    def grams(self, prefix: np.ndarray, size: int) -> np.ndarray:
        """Hash of every span of ``size`` consecutive values."""
        n = max(0, len(prefix) - size)
        _, down = self.powers.upto(len(prefix))
        return mix((prefix[size : size + n] - prefix[:n]) * down[:n] + U64(size))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hasher: SpanHash) -> np.ndarray:
    return hasher.spans(hasher.bytes_prefix(data), starts, ends)


def gram_mask(first: np.ndarray, n_words: int, size: int) -> np.ndarray:
    """True where ``size`` consecutive words from a position stay in one document."""
    left = np.repeat(first[1:], np.diff(first)) - np.arange(n_words)
    return (left >= size)[: max(0, n_words - size + 1)]


def packed(values: list[bytes] | np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.array(values, type=kind)
