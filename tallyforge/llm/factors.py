"""Longest previous factors of a byte buffer, from the suffix order.

Suffixes are ordered by their first ``length`` bytes (prefix doubling over ranks), equal ones by
position.  The longest previous factor of a suffix is the longer of its common prefixes with two
others: in suffix order, the nearest one before it and the nearest one after it that start at a
smaller position.  Common prefixes are read off the ranks of all sizes, greatest first.
"""

from __future__ import annotations

import numpy as np


class Suffixes:
    """The suffixes at ``starts`` (ascending, each with ``length`` bytes, at least 16, left in ``buffer``)."""

    def __init__(self, buffer: np.ndarray, length: int, starts: np.ndarray) -> None:
        self.buffer, self.length, self.starts = buffer, length, starts
        n = len(buffer) - 7
        rank = np.zeros(n, dtype=np.uint64)
        for k in range(8):
            rank = (rank << np.uint64(8)) | buffer[k : k + n]
        self.ranks = {8: rank}  # size: rank of the bytes of that size from each place on
        size = 8
        while size < length:
            step = min(size, length - size)  # the second half may overlap the first
            last = size + step == length
            at = starts if last else np.arange(len(rank) - step)
            head, tail = rank[at], rank[at + step]
            if size == 8:
                order = np.lexsort((tail, head))
            else:
                order = np.argsort((head.astype(np.uint64) << np.uint64(32)) | tail, kind="stable")
            new = np.ones(len(order), dtype=bool)
            new[1:] = (head[order[1:]] != head[order[:-1]]) | (tail[order[1:]] != tail[order[:-1]])
            rank = np.empty(len(order), dtype=np.uint32)
            rank[order] = np.cumsum(new).astype(np.uint32)
            size += step
            if not last:
                self.ranks[size] = rank
        self.order = order  # equal suffixes by position, as the sorts are stable
        self.heads = np.flatnonzero(new)  # where other bytes begin in the order

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bytes, up to ``length``, in which the suffixes at a and at b agree."""
        same = np.zeros(len(a), dtype=np.int64)
        for size in sorted(self.ranks, reverse=True):
            rank = self.ranks[size]
            near = np.flatnonzero(same + size <= self.length)
            hit = near[rank[a[near] + same[near]] == rank[b[near] + same[near]]]
            same[hit] += size
        near = np.arange(len(a))
        for _ in range(min(self.ranks)):
            near = near[same[near] < self.length]
            near = near[self.buffer[a[near] + same[near]] == self.buffer[b[near] + same[near]]]
            same[near] += 1
        return same


def previous_smaller(values: np.ndarray) -> np.ndarray:
    """For each of the distinct values the place of the nearest smaller one before it, or -1.

    Every place points at one such that all between are greater; a pointer at a greater value is
    replaced by that one's pointer, for all places at once.
    """
    at = np.arange(-1, len(values) - 1)
    greater = np.arange(len(values))
    while True:
        greater = greater[at[greater] >= 0]
        greater = greater[values[at[greater]] > values[greater]]
        if not len(greater):
            return at
        at[greater] = at[at[greater]]


def next_smaller(values: np.ndarray) -> np.ndarray:
    """The same after it, or -1."""
    at = previous_smaller(values[::-1])[::-1]
    return np.where(at >= 0, len(values) - 1 - at, -1)


def factors(buffer: np.ndarray, length: int, starts: np.ndarray) -> np.ndarray:
    """The longest previous factor of the suffix at each start, up to ``length`` bytes.

    Previous are the suffixes at smaller starts.  All but the first of equal suffixes have the whole
    length; the first ones' neighbours with smaller positions are first ones too, or as good.
    """
    out = np.full(len(starts), length, dtype=np.int64)
    if not len(starts):
        return out
    suffixes = Suffixes(buffer, length, starts)
    first = suffixes.order[suffixes.heads]
    at = starts[first]
    longest = np.zeros(len(first), dtype=np.int64)
    for near in (previous_smaller(at), next_smaller(at)):
        some = np.flatnonzero(near >= 0)
        longest[some] = np.maximum(longest[some], suffixes.common(at[some], at[near[some]]))
    out[first] = longest
    return out
