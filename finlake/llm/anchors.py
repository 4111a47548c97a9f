"""Content-chosen anchors over bytes: the smallest gram hash of every window.

In each window of ``length`` bytes the gram of ``GRAM`` bytes with the smallest
hash (rightmost on ties) is the window's anchor. The choice depends on the
window's bytes alone, so equal windows have equal anchors at equal offsets.
Consecutive windows with the same anchor form a run.
"""

from __future__ import annotations

import numpy as np

from .textops import SpanHash, mix

GRAM = 32
_HIGH = np.uint64(0xFFFFFFFF00000000)
_LOW = np.uint64(0xFFFFFFFF)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    size, out = 1, values
    while 2 * size <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    if size < width:
        rest = width - size
        out = np.minimum(out[:-rest], out[rest:])
    return out


def runs(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, anchor hash) of every run; windows do not cross documents.

    ``data`` holds all documents, document i at offsets[i]:offsets[i + 1]."""
    gram = min(GRAM, length)
    n = len(data) - length + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64)
    hasher = SpanHash(6)
    hashes = hasher.grams(hasher.bytes_prefix(data), gram)
    keys = (hashes & _HIGH) | (_LOW - np.arange(len(hashes), dtype=np.uint64))
    anchor = (_LOW - (sliding_min(keys, length - gram + 1) & _LOW)).astype(np.int64)
    inside = np.zeros(n + 1, np.int64)
    starts, ends = offsets[:-1], offsets[1:] - length + 1
    long_enough = ends > starts
    inside[starts[long_enough]] += 1
    inside[ends[long_enough]] -= 1
    ok = np.cumsum(inside[:-1]) > 0
    head = ok.copy()
    head[1:] &= (anchor[1:] != anchor[:-1]) | ~ok[:-1]
    head[starts[long_enough]] = True
    first = np.flatnonzero(head)
    stop = np.flatnonzero(np.r_[ok[:-1] & (~ok[1:] | head[1:]), ok[-1:]]) + 1
    # smallest hashes crowd at the low end; mixed again they spread evenly over hash ranges
    return first, stop - first, mix(hashes[anchor[first]])
