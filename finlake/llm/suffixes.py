"""Suffix arrays by induced sorting, with numpy on whole buckets.

The algorithm is the linear one: classify suffixes as smaller (S) or larger (L)
than their successor, sort the leftmost-S substrings by inducing, name them,
sort the string of names recursively, and induce all suffixes from the sorted
leftmost-S ones. Scanning an array bucket by bucket, all entries of a bucket
that are known induce their predecessors at once (in waves, while a bucket feeds
itself), so a pass is a few array operations per bucket. That pays while buckets
are few; a string of more than ``BUCKETS`` different names is therefore sorted by
doubling the length its ranks stand for, with one array sort per doubling (about
six for runs of 200 bytes), and the levels above are induced from it as usual.
"""

from __future__ import annotations

import numpy as np

#: Most names for which the recursion goes on bucket by bucket.
BUCKETS = 2048
SMALL = 24


def _induce(t, s_type, heads, ends, lms, k):
    """Suffix array of ``t`` given its leftmost-S suffixes ``lms`` in order."""
    n = len(t)
    sa = np.full(n, -1, np.int32)
    first = t[lms]
    by_char = np.argsort(first, kind="stable")
    lms, first = lms[by_char], first[by_char]
    n_lms = np.bincount(first, minlength=k)
    inner = np.arange(len(lms)) - (np.cumsum(n_lms) - n_lms)[first]
    sa[(ends - n_lms)[first] + inner] = lms
    occupied = np.flatnonzero(ends > heads)

    front = heads.copy()

    def push_larger(block):
        j = block[block > 0] - 1
        j = j[~s_type[j]]
        if not len(j):
            return
        c = t[j]
        order = np.argsort(c, kind="stable")
        j, c = j[order], c[order]
        size = np.bincount(c, minlength=k)
        sa[front[c] + np.arange(len(j)) - (np.cumsum(size) - size)[c]] = j
        front[:] += size

    for c in occupied:
        done = heads[c]
        while front[c] > done:
            upto = front[c]
            push_larger(sa[done:upto])
            done = upto
        if n_lms[c]:
            push_larger(sa[ends[c] - n_lms[c] : ends[c]])

    back = ends.copy()
    sa[0] = n - 1  # the sentinel is its own bucket
    back[t[n - 1]] = heads[t[n - 1]]

    def push_smaller(block):
        j = block[block > 0] - 1
        j = j[s_type[j]]
        if not len(j):
            return
        c = t[j]
        order = np.argsort(c, kind="stable")
        j, c = j[order], c[order]
        size = np.bincount(c, minlength=k)
        sa[back[c] - 1 - (np.arange(len(j)) - (np.cumsum(size) - size)[c])] = j
        back[:] -= size

    for c in occupied[::-1]:
        done = ends[c]
        while back[c] < done:
            upto = back[c]
            push_smaller(sa[upto:done][::-1])
            done = upto
        if front[c] > heads[c]:
            push_smaller(sa[heads[c] : front[c]][::-1])
    return sa


def _names(t, lms, in_order):
    """Names of the leftmost-S substrings (equal substrings, equal names) in text order, and their number."""
    length = np.zeros(len(t), np.int64)
    length[lms[:-1]] = np.diff(lms) + 1
    length[lms[-1]] = 1
    a, b = in_order[:-1], in_order[1:]
    same = length[a] == length[b]
    open_ = np.flatnonzero(same)
    offset = 0
    while len(open_):
        open_ = open_[length[a[open_]] > offset]
        differ = t[a[open_] + offset] != t[b[open_] + offset]
        same[open_[differ]] = False
        open_ = open_[~differ]
        offset += 1
    name = np.zeros(len(t), np.int64)
    name[in_order] = np.r_[0, np.cumsum(~same)]
    return name[lms], int((~same).sum()) + 1


def _doubled(names: np.ndarray) -> np.ndarray:
    """Suffix array of a string of many different names by rank doubling."""
    rank, size = names, 1
    while True:
        following = np.zeros(len(rank), np.int64)
        following[:-size] = rank[size:] + 1
        key = rank * (len(rank) + 2) + following
        order = np.argsort(key, kind="stable")
        new = np.zeros(len(rank), np.int64)
        new[order[1:]] = np.cumsum(np.diff(key[order]) != 0)
        if new[order[-1]] == len(rank) - 1:
            return order
        rank, size = new, 2 * size


def _sort(t: np.ndarray, k: int) -> np.ndarray:
    """Suffix array of ``t`` over 0..k-1; its last symbol is 0 and occurs nowhere else."""
    n = len(t)
    if n <= SMALL:
        values = t.tolist()
        return np.array(sorted(range(n), key=lambda i: values[i:]), np.int32)
    step = np.sign(t[1:].astype(np.int32) - t[:-1].astype(np.int32))
    following = np.where(step != 0, np.arange(n - 1), n - 2)
    following = np.minimum.accumulate(following[::-1])[::-1]  # where the next change is
    s_type = np.r_[step[following] > 0, True]
    lms = np.flatnonzero(s_type[1:] & ~s_type[:-1]) + 1
    size = np.bincount(t, minlength=k)
    ends = np.cumsum(size)
    heads = ends - size
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    rough = _induce(t, s_type, heads, ends, lms, k)
    in_order = rough[is_lms[rough]]
    names, n_names = _names(t, lms, in_order)
    if n_names < len(lms):
        # the last name is the sentinel's, 0 and unique, as the recursion needs it
        order = _sort(names.astype(np.uint16), n_names) if n_names <= BUCKETS else _doubled(names)
        in_order = lms[order]
    return _induce(t, s_type, heads, ends, in_order, k)


def suffix_array(data: np.ndarray, breaks: np.ndarray | None = None) -> np.ndarray:
    """Suffix array of bytes; ``breaks`` marks positions that compare below every byte (separators)."""
    t = data.astype(np.uint16) + 2
    if breaks is not None:
        t[breaks] = 1
    return _sort(np.r_[t, np.uint16(0)], 258)[1:]


def common_prefixes(data: np.ndarray, order: np.ndarray, valid: np.ndarray, cap: int) -> np.ndarray:
    """Permuted common prefixes: for each valid position, the bytes (at most ``cap``) it shares
    with the suffix before it in ``order``; 0 if either is not valid.

    A valid position has ``cap`` bytes of its own text after it."""
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    at = np.flatnonzero(valid & (before >= 0))
    at = at[valid[before[at]]]
    other = before[at]
    out = np.zeros(n, np.int32)
    padded = np.r_[data, np.zeros(8, np.uint8)]
    eight = np.ndarray((n + 1,), "<u8", padded, strides=(1,))
    done = 0
    while done < cap and len(at):
        differ = eight[at + done] ^ eight[other + done]
        low = np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)) // 8
        out[at] = np.minimum(done + low, cap)
        go = differ == 0
        at, other = at[go], other[go]
        done += 8
    return out
