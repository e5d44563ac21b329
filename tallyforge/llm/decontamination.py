"""Benchmark decontamination: SimHash of item-sized windows, then an exact check.

For every benchmark item of n words, windows of n words of each document get a 64-bit SimHash of
their shingles.  Fingerprints are cut into four blocks; two that differ in at most ``radius`` bits
differ in at most radius // 4 bits of some block.  Every block value that near to an item's is
listed with the item, so looking up a window's four blocks brings all items within the radius, and
no window is compared with an item that it does not meet there.  Pairs within the radius are
verified: the similarity of their weighted shingle sets (weight: occurrences; sum of the lesser
weights over sum of the greater) must reach ``least``.

A window that has not half of the shingles that a similar one shares with the benchmark gets no
fingerprint.  A document of fewer words than the item is one window as a whole.  Which pairs are
verified is decided by the fingerprints alone: a similar pair farther apart than the radius is
missed.  At the similarity 0.8 that is some 10 bits on average, with a spread near 3.  Items that
mostly repeat one passage have no steady fingerprint and are compared with every such window.

Benchmark items go to the tasks in groups of bounded size.  Documents are read where they are and
not moved, and every batch of them meets the groups one after another in one Python worker, which
has one group prepared at a time.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import without
from tallyforge.llm.crcspans import ranges
from tallyforge.llm.wordhash import in_groups, runs_of, word_arrays

BITS, BLOCKS = 64, 4
GROUP_ITEMS = 1_000  # benchmark items sent to the tasks at once ...
GROUP_BYTES = 16 << 20  # ... and bytes of their texts (a longer item makes a group of its own)
STRETCH = 1 << 14  # windows fingerprinted at once
PAIRS = 1 << 18  # of windows and items of a class, looked up at once
FILTER_BITS = 22

# Case and ASCII punctuation do not count.
_LOWER = bytes(c + 32 if 65 <= c <= 90 else 32 if c < 128 and not chr(c).isalnum() else c for c in range(256))


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    least: float = 0.8
    radius: int = 19  # four flips of a block


def normal(text: str | None) -> bytes:
    return b"" if text is None else text.lower().encode().translate(_LOWER)


def fingerprints(shingles: np.ndarray, starts: np.ndarray, n: int, sums: np.ndarray | None = None) -> np.ndarray:
    """SimHash of the n shingles from each start: a bit is set if more of them have it than not."""
    if sums is None:
        sums = bit_sums(shingles)
    votes = 2 * (sums[starts + n] - sums[starts]) > n
    return np.packbits(votes, axis=1, bitorder="little").view("<u8").ravel()


def bit_sums(shingles: np.ndarray) -> np.ndarray:
    """For each place and bit, how many shingles before it have the bit."""
    bits = np.unpackbits(shingles.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    out = np.zeros((len(shingles) + 1, BITS), dtype=np.int32)
    np.cumsum(bits, axis=0, out=out[1:], dtype=np.int32)
    return out


@functools.cache
def near_zero(flips: int, width: int) -> np.ndarray:
    """All numbers of ``width`` bits with at most ``flips`` bits set: what near numbers differ in."""
    every = np.arange(1 << width)
    return every[np.bitwise_count(every) <= flips]


class SizeClass:
    """The items of one number of words, to be looked up by fingerprint."""

    def __init__(self, n: int, settings: Settings) -> None:
        self.n = n
        self.width = min(n, settings.shingle)
        self.ids: list[int] = []
        self.prints: list[int] = []
        self.shingles: list[Counter] = []
        self.flips = settings.radius // BLOCKS
        self.least = settings.least
        self.loose: list[int] = []  # items that mostly repeat themselves: many bits hang on one shingle
        self.listed: list[np.ndarray] | None = None

    def add(self, item: int, words: np.ndarray) -> None:
        runs = runs_of(words, self.width)
        self.ids.append(item)
        self.prints.append(int(fingerprints(runs, np.zeros(1, dtype=np.int64), len(runs))[0]))
        self.shingles.append(Counter(runs.tolist()))
        if 2 * len(self.shingles[-1]) < len(runs):
            self.loose.append(len(self.ids) - 1)
        self.listed = None

    def needed(self, size: int) -> int:
        """Shingles that a similar window of ``size`` words shares at least with the item."""
        every = self.n + size - 2 * (self.width - 1)
        both = max(1, int(self.least * every / (1 + self.least)) - 1)
        while both < every - both and both / (every - both) < self.least:
            both += 1
        return both

    def lists(self) -> list[np.ndarray]:
        """For each block the near values with their items, ascending: (value << 16) + item."""
        if self.listed is None:
            blocks = np.array(self.prints, dtype="<u8").view("<u2").reshape(-1, BLOCKS).astype(np.uint32)
            near = near_zero(self.flips, BITS // BLOCKS).astype(np.uint32)
            item = np.arange(len(self.prints), dtype=np.uint32)
            self.listed = [np.sort((((b[:, None] ^ near) << np.uint32(16)) + item[:, None]).ravel()) for b in blocks.T]
        return self.listed

    def candidates(self, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) of all pairs within the radius, and of all with loose items."""
        window = np.arange(len(prints))
        met = [(window << 16) + i for i in self.loose]
        blocks = prints.view("<u2").reshape(-1, BLOCKS).astype(np.uint64)
        for values, listed in zip(blocks.T, self.lists()):
            low = np.searchsorted(listed, (values << np.uint64(16)).astype(np.uint32))
            high = np.searchsorted(listed, ((values << np.uint64(16)) + np.uint64(0xFFFF)).astype(np.uint32), side="right")
            of = np.repeat(window, high - low)
            item = listed[ranges(low, high - low)] & np.uint32(0xFFFF)
            near = np.bitwise_count(prints[of] ^ np.array(self.prints, dtype=np.uint64)[item]) <= radius
            met.append((of[near] << 16) + item[near])
        pairs = np.unique(np.concatenate(met))  # met in several blocks
        return pairs >> 16, pairs & 0xFFFF


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity of two shingle counts."""
    both = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return both / max(1, sum(a.values()) + sum(b.values()) - both)


class Items:
    """A group of benchmark items, ready to be looked for."""

    def __init__(self, rows: list[tuple[int, str]], settings: Settings) -> None:
        self.settings = settings
        self.classes: dict[int, SizeClass] = {}
        for item, text in rows:
            words, _ = word_arrays([normal(text)])
            if len(words):
                n = len(words)
                if n not in self.classes:
                    self.classes[n] = SizeClass(n, settings)
                self.classes[n].add(item, words)
        # Shingles of the benchmark, by width (items shorter than a shingle are one), with the
        # number of words of the items that have them.
        self.known: dict[int, np.ndarray] = {}
        self.lengths: dict[int, np.ndarray] = {}
        self.filters: dict[int, np.ndarray] = {}
        for width in {c.width for c in self.classes.values()}:
            pairs = sorted({(s, c.n) for c in self.classes.values() if c.width == width for held in c.shingles for s in held})
            self.known[width] = np.array([s for s, _ in pairs], dtype=np.uint64)
            self.lengths[width] = np.array([n for _, n in pairs], dtype=np.int64)
            self.filters[width] = np.zeros(1 << FILTER_BITS, dtype=bool)
            self.filters[width][self.known[width] >> np.uint64(64 - FILTER_BITS)] = True

    def hits(self, words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All shingles of the width, the places of those that the benchmark has, and the lengths of their items."""
        runs, known = runs_of(words, width), self.known[width]
        maybe = np.flatnonzero(self.filters[width][runs >> np.uint64(64 - FILTER_BITS)])
        low, high = np.searchsorted(known, runs[maybe]), np.searchsorted(known, runs[maybe], side="right")
        return runs, np.repeat(maybe, high - low), self.lengths[width][ranges(low, high - low)]

    def find(self, texts: list[bytes]) -> list[list[tuple[int, float, int]]]:
        """For each text its leaks (item, similarity, first word), the best window of each item."""
        words, first = word_arrays(texts)
        best: list[dict[int, tuple[float, int]]] = [{} for _ in texts]
        for width in self.known:
            runs, hits, length = self.hits(words, width)
            doc = np.searchsorted(first, hits, side="right") - 1
            inside = hits + width <= first[doc + 1]
            hits, doc, length = hits[inside], doc[inside], length[inside]
            for d, n in sorted(set(zip(doc.tolist(), length.tolist()))):
                own = hits[(doc == d) & (length == n)]
                self._find_in(best[d], self.classes[n], runs, own, int(first[d]), int(first[d + 1]))
        return [sorted((item, s, -at) for item, (s, at) in b.items()) for b in best]

    def _find_in(self, best, c, runs, hits, begin, end) -> None:
        """Windows of one document around the shingles it has of the items of a class, in stretches.

        A document of fewer words than the items is one window as a whole.
        """
        if end - begin < c.n:
            size = end - begin
            if 2 * len(hits) >= c.needed(size):
                prints = fingerprints(runs[begin : end - c.width + 1], np.zeros(1, dtype=np.int64), size - c.width + 1)
                self._verify(best, c, np.array([begin]), size, prints, runs, begin)
            return
        low = np.maximum(hits - c.n, begin)
        edges = np.flatnonzero(low[1:] > hits[:-1] + c.n) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(hits)]):
            left, right = int(low[a]), min(end, int(hits[b - 1]) + c.n + c.width)
            for at in range(left, right, STRETCH):
                to = min(right, at + STRETCH)
                starts = np.arange(at, min(to, end - c.n + 1))
                known = np.searchsorted(hits, starts + c.n - c.width, side="right") - np.searchsorted(hits, starts)
                starts = starts[2 * known >= c.needed(c.n)]
                if len(starts):
                    prints = fingerprints(runs[at : min(end, to + c.n)], starts - at, c.n - c.width + 1)
                    self._verify(best, c, starts, c.n, prints, runs, begin)

    def _verify(self, best, c, starts, size, prints, runs, begin) -> None:
        """Windows of ``size`` words against the items of a class that they meet."""
        last, have = -1, None
        step = max(1, PAIRS // len(c.ids))
        for at in range(0, len(starts), step):
            for w, i in zip(*(x.tolist() for x in c.candidates(prints[at : at + step], self.settings.radius))):
                start = int(starts[at + w])
                if start != last:
                    last, have = start, Counter(runs[start : start + size - c.width + 1].tolist())
                alike = similarity(have, c.shingles[i])
                if alike >= self.settings.least:
                    item = c.ids[i]
                    best[item] = max(best.get(item, (0.0, 0)), (alike, begin - start))


def item_groups(benchmark: DataFrame, item_id: str, text: str):
    """The benchmark in groups of bounded size, in order of id; one id's texts are in one group."""
    rows = benchmark.where(F.col(f"`{text}`").isNotNull() & F.col(f"`{item_id}`").isNotNull()).select(
        F.col(f"`{item_id}`").cast("long"), F.col(f"`{text}`")
    )
    group, size = [], 0
    for item, words in rows.orderBy(*range(1, 3)).toLocalIterator():
        if group and item != group[-1][0] and (len(group) >= GROUP_ITEMS or size + len(words) > GROUP_BYTES):
            yield group
            group, size = [], 0
        group.append((item, words))
        size += len(words)
    if group:
        yield group


LEAKS = "array<struct<item_id: long, similarity: double, start: long>>"
_LEAK = pa.struct({"item_id": pa.int64(), "similarity": pa.float64(), "start": pa.int64()})


def _search(groups):
    """A UDF that looks for the items of all broadcast groups.

    It is declared nondeterministic so that Spark evaluates it once: a filter on its result (or one
    that Spark infers from ``explode``) would otherwise get a copy of it, and each copy has a Python
    worker and a batch of texts of its own in every task.
    """

    @F.arrow_udf(LEAKS)
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        prepared = Items(*groups[0].value) if len(groups) == 1 else None
        for texts in batches:
            found: list[list] = [[] for _ in range(len(texts))]
            for group in groups:
                items = prepared or Items(*group.value)
                parts = in_groups(normal(text.as_py()) for text in texts)
                for own, more in zip(found, chain.from_iterable(map(items.find, parts))):
                    own += more
                del items  # before the next group is prepared
            yield pa.array(found, pa.list_(_LEAK))

    return search.asNondeterministic()


def with_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """All rows with ``leaks``: the benchmark items found in the text, by id.

    Each with the similarity of its most similar window, and that window's first word (the first
    such window).  Null and empty texts have no leaks; items without words, text or id are left
    out; an empty benchmark finds nothing.  Repeated rows get equal results; an item whose id repeats
    is found by any of its texts, the most similar counting.
    """
    context = docs.sparkSession.sparkContext
    # In order of id, and no id is in two groups: the leaks of all groups are in order as well.
    groups = [context.broadcast((group, settings)) for group in item_groups(benchmark, item_id, item_text)]
    found = _search(groups)(F.col(f"`{text}`")) if groups else F.array().cast(LEAKS)
    return without(docs, ["leaks"]).withColumn("leaks", found)


def leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """One row per document and item found: doc_id, item_id, similarity, start."""
    found = with_leaks(docs, benchmark, **options).select(F.col(f"`{doc_id}`").alias("doc_id"), F.explode("leaks").alias("leak"))
    return found.select("doc_id", "leak.item_id", "leak.similarity", "leak.start")


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without a leak, with their columns."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    found = with_leaks(docs.select(row, F.col(f"`{text}`").alias("text")), benchmark, **options)
    return found.where(F.size("leaks") == 0).select("row.*")
