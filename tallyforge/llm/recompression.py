"""Substring dedup on words, by recompression.

Words are symbols with global names (see ``symbols``).  A round names every maximal run of one
symbol, then, with the symbols dealt to a left and a right half by a hash of their names, every pair
of a left and a right one; each naming is an exchange of Spark, so equal passages get equal symbols
wherever they are, but for some at their ends.  Each symbol carries its context, the words that
decided it; a symbol whose context lies in a window is the same in every copy of that window.  What
occurs in a single document gets no name, so a window with such a symbol has no copy elsewhere.

1. Words are named.  Stretches of ``width`` or more words with names are a block's state.
2. ROUNDS rounds make a level of symbols each, ever fewer and longer; all levels are kept.  After
   each, words that lie in no window whose symbols all have names are dropped.
3. Each window is represented by one symbol of the highest level that has a context inside it, the
   least by a hash, else by one of the level below, and so on.  (A window without any, such as one
   long run, represents itself.)
4. Windows with the same symbol that follow each other are one passage.  Each block sends its
   distinct passages, as names of words, to the task of their symbol.  There windows are compared
   word by word, and the smallest document of each window is told.
5. Words covered by a window that a smaller document has are removed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm import wordhash
from tallyforge.llm.blocks import Block, finished, ranges as range_count, text_blocks
from tallyforge.llm.crcspans import ranges
from tallyforge.llm.symbols import ALONE, LEVEL_SHIFT, Keys, Words, heads_of, named_pairs, named_words, names_of, next_states, pack, unpack
from tallyforge.llm.wordhash import mix, runs_of
from tallyforge.scale import new_path, passing, remove, stored

ROUNDS = 3
LONGEST = 64  # windows of a passage sent as one
BUCKET_BYTES = 16 << 20  # of text whose blocks lie in one file
MOST_BUCKETS = 100_000  # Spark's bound; files grow beyond
WINDOWS_AT_ONCE = 400_000  # compared in one step, more if they share a symbol


# -- levels of symbols ----------------------------------------------------------------------------


@dataclass
class Level:
    """Symbols in order: names, the words from ``begin`` to ``end`` that decided them, their stretch."""

    name: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    stretch: np.ndarray

    def bordering(self) -> np.ndarray:
        """Whether a symbol follows one of its stretch; one more entry for the end."""
        inner = np.zeros(len(self.name) + 1, dtype=bool)
        inner[1:-1] = self.stretch[1:] == self.stretch[:-1]
        return inner


@dataclass
class State:
    """A block's stretches of named words, and the levels of symbols over them."""

    words: np.ndarray  # names of the words of all stretches
    size: np.ndarray  # words of each stretch
    doc: np.ndarray  # its document's place in the block
    at: np.ndarray  # its first word in the document
    ident: np.ndarray  # its document's id
    levels: list[Level]

    @classmethod
    def read(cls, data: bytes) -> State:
        words, size, doc, at, ident, *rest = unpack(data)
        return cls(words, size, doc, at, ident, [Level(*rest[k : k + 4]) for k in range(0, len(rest), 4)])

    def packed(self) -> bytes:
        levels = [a for level in self.levels for a in (level.name, level.begin, level.end, level.stretch)]
        return pack(self.words, self.size, self.doc, self.at, self.ident, *levels)

    def first(self) -> np.ndarray:
        """The first word of each stretch, among all."""
        return np.cumsum(self.size) - self.size

    def top(self) -> Level:
        if self.levels:
            return self.levels[-1]
        place = np.arange(len(self.words))
        return Level(self.words, place, place + 1, np.repeat(np.arange(len(self.size)), self.size))


def run_bounds(level: Level) -> tuple[np.ndarray, np.ndarray]:
    """First and last symbol of every maximal run of one symbol."""
    same = np.zeros(len(level.name), dtype=bool)
    same[1:] = (level.name[1:] == level.name[:-1]) & (level.stretch[1:] == level.stretch[:-1]) & (level.name[1:] != ALONE)
    heads = np.flatnonzero(~same)
    return heads, np.append(heads[1:], len(level.name))[: len(heads)] - 1


def run_keys(state: State, parts: int) -> tuple[Keys, np.ndarray]:
    """Keys (symbol, length) of the runs of two and more, and which runs these are."""
    level = state.top()
    heads, tails = run_bounds(level)
    long = np.flatnonzero(tails > heads)
    at = heads[long]
    return Keys.of_rows(level.name[at], (tails - heads + 1)[long], state.ident[level.stretch[at]], parts), long


def with_runs(state: State, told: list | None, parts: int) -> State:
    """A level of runs; that a run ends is decided by the symbols next to it."""
    level = state.top()
    heads, tails = run_bounds(level)
    keys, long = run_keys(state, parts)
    name = level.name[heads]
    name[long] = names_of(told, len(keys.left))[keys.of]
    stretch = level.stretch[heads]
    first = state.first()
    before, after = first[stretch] - 1, (first + state.size)[stretch] + 1
    inner = Level(name, name, name, stretch).bordering()
    before = np.where(inner[:-1], level.begin[np.maximum(heads - 1, 0)], before)
    after = np.where(inner[1:], level.end[np.minimum(tails + 1, len(level.name) - 1)], after)
    runs = Level(name, np.minimum(before, level.begin[heads]), np.maximum(after, level.end[tails]), stretch)
    return State(state.words, state.size, state.doc, state.at, state.ident, [*state.levels, runs])


def halves(level: Level, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Which symbols are left ones, and which of them begin a pair."""
    left = (mix(level.name.astype(np.uint64) + np.uint64(number)) & np.uint64(1)) == 0
    pair = np.zeros(len(left), dtype=bool)
    named = level.name != ALONE
    pair[:-1] = left[:-1] & ~left[1:] & named[:-1] & named[1:] & level.bordering()[1:-1]
    return left, pair


def pair_keys(state: State, number: int, parts: int) -> tuple[Keys, np.ndarray]:
    level = state.top()
    at = np.flatnonzero(halves(level, number)[1])
    return Keys.of_rows(level.name[at], level.name[at + 1], state.ident[level.stretch[at]], parts), at


def with_pairs(state: State, told: list | None, number: int, parts: int) -> State:
    """The level of runs replaced by one of pairs; left symbols look to the right, right ones to the left."""
    level = state.top()
    left, pair = halves(level, number)
    keys, at = pair_keys(state, number, parts)
    name = level.name.copy()
    name[at] = names_of(told, len(keys.left))[keys.of]
    first = state.first()
    inner = level.bordering()
    next_end = np.where(inner[1:], np.append(level.end[1:], 0)[: len(name)], (first + state.size)[level.stretch] + 1)
    back = np.where(inner[:-1], np.append(0, level.begin[:-1])[: len(name)], first[level.stretch] - 1)
    keep = np.ones(len(name), dtype=bool)
    keep[at + 1] = False
    pairs = Level(name[keep], np.where(left, level.begin, back)[keep], np.where(left, next_end, level.end)[keep], level.stretch[keep])
    return State(state.words, state.size, state.doc, state.at, state.ident, [*state.levels[:-1], pairs])


# -- windows and passages -------------------------------------------------------------------------


def windows(state: State, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, stretch) of all windows."""
    many = np.maximum(state.size - width + 1, 0)
    stretch = np.repeat(np.arange(len(many)), many)
    return np.arange(len(stretch)) - np.repeat(np.cumsum(many) - many, many) + state.first()[stretch], stretch


def decided(level: Level, start: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window the first and (exclusive) last of the symbols that are decided inside it.

    Contexts ascend, so these are neighbours; how many symbols begin or end before a place is counted once.
    """
    n = int(start[-1]) + width + 2 if len(start) else 2
    begun = np.cumsum(np.bincount(np.clip(level.begin + 1, 0, n), minlength=n + 1))  # symbols whose context begins before a place
    ended = np.cumsum(np.bincount(np.clip(level.end, 0, n), minlength=n + 1))  # ends there or before
    lo = begun[start]
    return lo, np.maximum(ended[start + width], lo)


def represented(state: State, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, stretch, symbol) of the windows that can have a copy in another document.

    ``symbol`` is a hash of the representing one, as unsigned number.
    """
    start, stretch = windows(state, width)
    symbol = np.zeros(len(start), dtype=np.uint64)
    open_ = np.ones(len(start), dtype=bool)
    alive = np.ones(len(start), dtype=bool)
    for number in range(len(state.levels), 0, -1):
        level = state.levels[number - 1]
        lo, hi = decided(level, start, width)
        alone = np.append(0, np.cumsum(level.name == ALONE))
        alive &= alone[hi] == alone[lo]
        table = mix(level.name.astype(np.uint64) ^ np.uint64(number << LEVEL_SHIFT))
        size = 1
        while len(table):  # the least of a stretch of symbols, by tables of powers of two
            hit = np.flatnonzero(open_ & alive & (hi - lo >= size) & (hi - lo < 2 * size))
            symbol[hit] = np.minimum(table[lo[hit]], table[hi[hit] - size])
            open_[hit] = False
            if 2 * size > len(table) or not (open_ & (hi - lo >= 2 * size)).any():
                break
            table = np.minimum(table[: len(table) - size], table[size:])
            size *= 2
    own = np.flatnonzero(open_ & alive)
    if len(own):
        symbol[own] = mix(runs_of(state.words.astype(np.uint64), width)[start[own]])
    return start[alive], stretch[alive], symbol[alive]


def pruned(state: State, width: int) -> State:
    """Without the words that no window left can cover; symbols stay that are decided within what stays.

    A window left in two places has the same symbols decided inside it in both, also in later rounds.
    """
    start, _ = windows(state, width)
    level = state.levels[-1]
    lo, hi = decided(level, start, width)
    alone = np.append(0, np.cumsum(level.name == ALONE))
    start = start[alone[hi] == alone[lo]]
    change = np.bincount(start, minlength=len(state.words) + 1) - np.bincount(start + width, minlength=len(state.words) + 1)
    covered = np.concatenate([[False], np.cumsum(change)[:-1] > 0, [False]])
    own = np.repeat(np.arange(len(state.size)), state.size)
    covered_in = np.where(covered[1:-1], own, -1)  # stretches that touch stay apart
    edge = np.flatnonzero(np.diff(covered_in, prepend=-1))
    edge = edge[covered_in[edge] >= 0]
    end = np.append(np.flatnonzero(np.diff(covered_in) != 0) + 1, len(covered_in))
    end = end[np.searchsorted(end, edge, side="right")]
    of, size = own[edge], end - edge
    first = np.cumsum(size) - size
    levels = []
    for level in state.levels:
        at = np.searchsorted(edge, level.begin, side="right") - 1
        keep = np.flatnonzero((at >= 0) & (level.end <= np.append(end, -1)[at]))
        moved = (first - edge)[at[keep]]
        levels.append(Level(level.name[keep], level.begin[keep] + moved, level.end[keep] + moved, at[keep]))
    words = state.words[ranges(edge, size)]
    return State(words, size, state.doc[of], state.at[of] + edge - state.first()[of], state.ident[of], levels)


class Passages:
    """A block's passages, and the distinct ones by part and symbol, with their smallest and greatest document."""

    def __init__(self, state: State, width: int, parts: int) -> None:
        start, stretch, symbol = represented(state, width)
        follows = np.zeros(len(start), dtype=bool)
        follows[1:] = (start[1:] == start[:-1] + 1) & (stretch[1:] == stretch[:-1]) & (symbol[1:] == symbol[:-1])
        heads = np.flatnonzero(~follows)
        place = np.arange(len(start)) - np.repeat(heads, np.diff(np.append(heads, len(start))))
        heads = np.flatnonzero(place % LONGEST == 0)
        self.n = np.diff(np.append(heads, len(start)))  # windows of each passage
        self.start, self.stretch, symbol = start[heads], stretch[heads], symbol[heads]
        self.ident = state.ident[self.stretch]
        size = self.n + width - 1
        words = state.words.astype(np.uint64)
        up, down = wordhash.powers(len(words) + 1)
        sums = np.append(np.uint64(0), np.cumsum(mix(words) * up[: len(words)], dtype=np.uint64))
        mark = mix((sums[self.start + size] - sums[self.start]) * down[self.start]) + size.astype(np.uint64)
        part = (mix(symbol) % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((self.ident, mark, symbol, part))
        heads = heads_of(part[order], symbol[order], mark[order])
        many = np.diff(np.append(heads, len(order)))
        leader, group = order[np.repeat(heads, many)], np.repeat(np.arange(len(heads)), many)
        # Passages of one hash are one only if their words are.
        fits = size[order] == size[leader]
        some = np.flatnonzero(fits & (order != leader))
        of, long = np.repeat(some, size[order[some]]), size[order[some]]
        differ = state.words[ranges(self.start[order[some]], long)] != state.words[ranges(self.start[leader[some]], long)]
        fits[of[differ]] = False
        odd = np.flatnonzero(~fits)
        group[odd] = len(heads) + np.arange(len(odd))
        lead = np.concatenate([order[heads], order[odd]])
        by_part = np.lexsort((symbol[lead], part[lead]))
        place = np.empty(len(lead), dtype=np.int64)
        place[by_part] = np.arange(len(lead))
        self.of = np.empty(len(order), dtype=np.int64)
        self.of[order] = place[group]
        self.lead = lead[by_part]
        self.symbol, self.size = symbol[self.lead], size[self.lead]
        self.least = np.full(len(lead), np.iinfo(np.int64).max)
        np.minimum.at(self.least, self.of, self.ident)
        self.most = np.full(len(lead), np.iinfo(np.int64).min)
        np.maximum.at(self.most, self.of, self.ident)
        self.cuts = np.searchsorted(part[self.lead], np.arange(parts + 1))


def smallest_documents(symbol, least, n, words, width: int) -> np.ndarray:
    """For every window of the passages (in turn) the smallest document that has it.

    Passages are sorted by symbol; ``words`` has their words one after another.  Windows are the
    same if their symbols and all their words are.
    """
    size = n + width - 1
    first = np.cumsum(size) - size
    runs = runs_of(words.astype(np.uint64), width)
    out = np.empty(int(n.sum()), dtype=np.int64)
    ends, a, done = np.cumsum(n), 0, 0
    while a < len(n):
        b = max(a + 1, int(np.searchsorted(ends, done + WINDOWS_AT_ONCE, side="right")))
        b = int(np.searchsorted(symbol, symbol[b - 1], side="right"))  # equal symbols stay together
        own = np.repeat(np.arange(a, b), n[a:b])
        at = ranges(first[a:b], n[a:b])
        order = np.lexsort((runs[at], symbol[own]))
        heads = heads_of(symbol[own[order]], runs[at[order]])
        many = np.diff(np.append(heads, len(order)))
        leader, group = order[np.repeat(heads, many)], np.repeat(np.arange(len(heads)), many)
        same = np.ones(len(order), dtype=bool)
        for j in range(width):
            same &= words[at[order] + j] == words[at[leader] + j]
        others: dict[tuple, int] = {}
        for k in np.flatnonzero(~same).tolist():  # other words of the same hash
            key = (int(group[k]), words[at[order[k]] : at[order[k]] + width].tobytes())
            group[k] = others.setdefault(key, len(heads) + len(others))
        smallest = np.full(len(heads) + len(others), np.iinfo(np.int64).max)
        np.minimum.at(smallest, group, least[own[order]])
        part = np.empty(len(order), dtype=np.int64)
        part[order] = smallest[group]
        out[done : done + len(part)] = part
        a, done = b, done + len(part)
    return out


def without_words(text: bytes, gone: np.ndarray) -> bytes:
    """``text`` without its marked words and the white space after each."""
    _, starts, _ = wordhash.hash_words(text)
    edges = np.append(starts, len(text))
    change = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
    cuts = [0, *edges[change].tolist(), len(text)]
    return b"".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2]))


# -- the job --------------------------------------------------------------------------------------


def known_words(block: Block, parts: int) -> tuple[np.ndarray, Words]:
    """The places of the block's documents with an id, and their words."""
    known = np.flatnonzero(block.known)
    return known, Words.of_texts([block.texts[i] for i in known.tolist()], parts)


def stretches(row: dict, width: int, parts: int) -> State:
    """The block's stretches of ``width`` or more words with names."""
    block = Block.of(row)
    known, words = known_words(block, parts)
    names = names_of(row["words"], len(words.many))[words.of]
    named_in = np.where(names != ALONE, words.text, -1)
    edge = np.flatnonzero(np.diff(named_in, prepend=-2))
    size = np.diff(np.append(edge, len(named_in)))
    kept = (named_in[edge] >= 0) & (size >= width)
    edge, size = edge[kept], size[kept]
    text = words.text[edge]
    doc = known[text]
    return State(names[ranges(edge, size)], size, doc, edge - np.searchsorted(words.text, text), block.ids[doc], [])


def symbol_levels(blocks: DataFrame, width: int, parts: int, buckets: int) -> DataFrame:
    """(block, state): each block's stretches of named words, with ROUNDS levels of symbols.

    Blocks and states are stored by number; only names move.  A state is deleted when the next one is
    written.
    """
    spark = blocks.sparkSession
    old = new_path(spark, "states")
    named = blocks.join(named_words(blocks, lambda row: known_words(Block.of(row), parts)[1], parts, buckets), "block", "left")
    states = next_states(named, lambda row: stretches(row, width, parts).packed(), buckets, old)
    for number in range(1, ROUNDS + 1):
        runs = named_pairs(states, lambda row: run_keys(State.read(row["state"]), parts)[0], 2 * number - 1, parts, buckets, "runs")
        told = new_path(spark, "runs")
        states = states.join(stored(runs, told).repartition(buckets, "block"), "block", "left")

        def of_runs(row: dict) -> State:
            return with_runs(State.read(row["state"]), row["runs"], parts)

        pairs = named_pairs(states, lambda row, k=number: pair_keys(of_runs(row), k, parts)[0], 2 * number, parts, buckets, "pairs")
        new = new_path(spark, "states")
        states = next_states(
            states.join(pairs, "block", "left"),
            lambda row, k=number: pruned(with_pairs(of_runs(row), row["pairs"], k, parts), width).packed(),
            buckets,
            new,
        )
        remove(spark, old)
        remove(spark, told)
        old = new
    return states


PASSAGES = "part int, block long, base int, data binary"


def substring_dedup(
    docs: DataFrame, width: int = 13, doc_id: str = "doc_id", text: str = "text", keep_text: bool = False
) -> DataFrame:
    """All rows with n_words, n_removed and ``kept_text`` (the kept words, joined by a space) for the text.

    With ``keep_text`` the text stays a column too, unchanged where nothing was removed and else
    without the removed words, its other white space as it was.

    A word is removed when it lies in a run of ``width`` words of its document that also occurs in
    a document with a smaller id; runs are judged on the input.  Null texts and texts of fewer
    words lose nothing.  Rows with equal ids are one document to this rule: they do not remove from
    each other; rows without an id neither lose words nor make others lose them.  Ids are read as
    whole numbers.  Other columns are kept; ones named like a result are replaced.
    """
    spark = docs.sparkSession
    docs = docs.withColumn(doc_id, F.col(f"`{doc_id}`").cast("long"))
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    buckets = max(1, min(MOST_BUCKETS, -(-size // BUCKET_BYTES)))
    blocks = text_blocks(docs, doc_id, text, buckets=buckets)
    parts = range_count(size // 15, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                state = State.read(row["state"])
                found = Passages(state, width, parts)
                for p in np.flatnonzero(np.diff(found.cuts)).tolist():
                    a, b = found.cuts[p], found.cuts[p + 1]
                    words = state.words[ranges(found.start[found.lead[a:b]], found.size[a:b])]
                    data = pack(found.symbol[a:b].view(np.int64), found.least[a:b], found.most[a:b], found.size[a:b], words)
                    columns = [pa.array([p], pa.int32()), pa.array([row["block"]], pa.int64()), pa.array([a], pa.int32()), pa.array([data], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["part", "block", "base", "data"])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(row["block"], row["base"], unpack(row["data"])) for batch in batches for row in batch.to_pylist()]
        if not got:
            return
        symbol, least, most, size, words = (np.concatenate([g[2][k] for g in got]) for k in range(5))
        many = [len(g[2][0]) for g in got]
        got = [g[:2] for g in got]
        n = size - width + 1
        order = np.argsort(symbol.view(np.uint64), kind="stable")
        sorted_words = words[ranges((np.cumsum(size) - size)[order], size[order])]
        told = smallest_documents(symbol.view(np.uint64)[order], least[order], n[order], sorted_words, width)
        back = np.empty(len(n), dtype=np.int64)
        back[order] = np.cumsum(n[order]) - n[order]
        told = told[ranges(back, n)]
        useful = np.maximum.reduceat((told < np.repeat(most, n)).astype(np.int8), np.cumsum(n) - n) > 0
        begin, at = np.cumsum(n) - n, 0
        for (block, base), m in zip(got, many):
            local = np.flatnonzero(useful[at : at + m])
            if len(local):
                data = pack(local + base, told[ranges(begin[at + local], n[at + local])])
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([data], pa.binary())], ["block", "local"])
            at += m

    def mark(row: dict) -> bytes:
        """(document, first word) of every window that a smaller document has."""
        state = State.read(row["state"])
        found = Passages(state, width, parts)
        n = found.size - width + 1
        least = np.full(int(n.sum()), np.iinfo(np.int64).max)
        begin = np.cumsum(n) - n
        for answer in row["told"] or ():
            local, values = unpack(answer)
            least[ranges(begin[local], n[local])] = values
        own = np.repeat(np.arange(len(found.n)), found.n)
        place = ranges(np.zeros(len(found.n), dtype=np.int64), found.n)
        gone = least[begin[found.of[own]] + place] < found.ident[own]
        own, place = own[gone], place[gone]
        stretch = found.stretch[own]
        return pack(state.doc[stretch], state.at[stretch] + found.start[own] - state.first()[stretch] + place)

    with passing(spark):  # only the marks stay, besides the blocks
        states = symbol_levels(blocks, width, parts, buckets)
        sent = states.select("block", "state").mapInArrow(send, PASSAGES).repartitionById(parts, F.col("part"))
        told = sent.mapInArrow(judge, "block long, local binary").repartition(buckets, "block")
        told = told.groupBy("block").agg(F.collect_list("local").alias("told"))
        marks = next_states(states.join(told, "block", "left"), mark, buckets, new_path(spark, "marks")).withColumnRenamed("state", "marks")

    def result(block: Block, row: dict):
        doc, start = unpack(row["marks"]) if row["marks"] is not None else (np.empty(0, dtype=np.int64),) * 2
        order = np.argsort(doc, kind="stable")
        doc, start = doc[order], start[order]
        cuts = np.searchsorted(doc, np.arange(len(block.texts) + 1)).tolist()
        out = {"n_words": [], "n_removed": [], "kept_text": []}
        texts_left: list[str | None] = []
        for i, whole in enumerate(block.texts):
            split = whole.split()
            n_words, n = len(split), 0
            own = start[cuts[i] : cuts[i + 1]]
            if len(own):
                change = np.bincount(own, minlength=n_words + 1) - np.bincount(own + width, minlength=n_words + 1)
                cut = np.cumsum(change)[:n_words] > 0
                n = int(cut.sum())
                split = [w for w, g in zip(split, cut.tolist()) if not g]
            if keep_text:
                texts_left.append(None if block.null[i] else (without_words(whole, cut) if n else whole).decode())
            out["n_words"].append(n_words)
            out["n_removed"].append(n)
            out["kept_text"].append(b" ".join(split).decode())
        if keep_text:
            out[text] = texts_left
        return out

    schema = "n_words long, n_removed long, kept_text string" + (f", `{text}` string" if keep_text else "")
    return finished(blocks.join(marks, "block", "left"), result, docs, text, schema)
