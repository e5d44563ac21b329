"""A bidirectional FM-index over word numbers, for phrases up to a fixed depth.

The sequence of a shard is read as a cycle of symbols, 0 standing between pieces of text.  For each
direction its places are ordered by the ``depth`` symbols ahead of them, and the Burrows-Wheeler
transform lists the symbol behind each.  All occurrences of a phrase are one interval of either
order.  Extending a phrase by the symbol behind it is the step from a row to where that symbol's
row lies (the LF mapping); in the other order the new interval lies inside the old one, after the
rows of smaller symbols.  Order beyond the depth does not matter, as no longer phrase is asked for.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tallyforge.llm.crcspans import ranges


def places_in_order(seq: np.ndarray, depth: int) -> np.ndarray:
    """Places of the cyclic sequence ordered by the ``depth`` symbols from there on."""
    rank, have = seq.astype(np.int64), 1
    while True:
        step = min(have, depth - have)
        key = rank * (int(rank.max()) + 1) + np.roll(rank, -step) if step else rank
        if have + step >= depth:
            return np.argsort(key, kind="stable").astype(np.int32)
        rank, have = np.unique(key, return_inverse=True)[1], have + step


def transforms(seq: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The symbols before the places in forward order, and those after them in backward order."""
    out = []
    for way in (seq, seq[::-1]):
        out.append(np.roll(way, 1)[places_in_order(way, depth)].astype(np.int32))
    return out[0], out[1]


@dataclass
class Phrases:
    """Phrases of one length: their first row in either order, and how often they occur."""

    first: tuple[np.ndarray, np.ndarray]
    size: np.ndarray

    def at(self, places: np.ndarray) -> Phrases:
        return Phrases((self.first[0][places], self.first[1][places]), self.size[places])


class BidirectionalIndex:
    def __init__(self, before: np.ndarray, after: np.ndarray) -> None:
        self.bwt = (before, after)
        # The rows of each symbol in order; a row's place here is the row the LF mapping leads to.
        self.rows = tuple(np.argsort(b, kind="stable") for b in self.bwt)

    def words(self, symbols: int) -> Phrases:
        """The phrases of one word, for symbols 1 up to ``symbols``."""
        counts = np.bincount(self.bwt[0], minlength=symbols + 1)
        first = (np.cumsum(counts) - counts)[1:]
        return Phrases((first, first), counts[1:])

    def extended(self, phrases: Phrases, side: int) -> tuple[Phrases, np.ndarray, np.ndarray]:
        """All phrases one word longer at their front (side 0) or at their end (side 1).

        With each comes the place of the phrase it was made from, and that of the phrase without
        the word at its other end; only those for which both are among ``phrases`` are given.
        """
        bwt, rows, lo, size = self.bwt[side], self.rows[side], phrases.first[side], phrases.size
        owner = np.full(len(bwt), -1, dtype=np.int32)
        owner[ranges(lo, size)] = np.repeat(np.arange(len(size), dtype=np.int32), size)
        of = owner[rows]
        at = np.flatnonzero(of >= 0)
        symbol, of = bwt[rows[at]], of[at]
        new = np.flatnonzero(np.append(len(at) > 0, (symbol[1:] != symbol[:-1]) | (of[1:] != of[:-1])))
        count = np.diff(np.append(new, len(at)))
        symbol, of, first = symbol[new], of[new], at[new]
        # Rows of smaller symbols within the phrase's interval.
        by_phrase = np.argsort(of, kind="stable")
        smaller = np.empty(len(of), dtype=np.int64)
        begin = np.cumsum(size) - size
        smaller[by_phrase] = np.cumsum(count[by_phrase]) - count[by_phrase] - begin[of[by_phrase]]
        inner = phrases.first[1 - side][of] + smaller
        # The interval that holds the new one in this order is the phrase without the far word.
        by_row = np.argsort(lo, kind="stable")
        held = by_row[np.maximum(np.searchsorted(lo[by_row], first, side="right") - 1, 0)] if len(lo) else first
        good = np.flatnonzero((symbol > 0) & (first >= lo[held]) & (first < lo[held] + size[held]))
        pair = (first[good], inner[good])
        return Phrases(pair if side == 0 else pair[::-1], count[good]), of[good], held[good]
