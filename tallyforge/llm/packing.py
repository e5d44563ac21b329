"""Packing documents into windows of tokens, by non-negative least squares.

1. Documents are tokenized and cut into full windows and a remainder; all pieces are written below
   ``spark.checkpoint.dir`` with the number of earlier remainders of that length in their task.
2. The histogram of lengths, at most one number for each token of a window, goes to the driver.
   There, combinations of up to three lengths that fill a window are listed; non-negative least
   squares finds how often to use each, and the counts are rounded down.
3. What is left is packed greedily, still by counts: the longest piece, then the longest that
   fits; a gap above ``max_gap`` is filled by cutting a piece.
4. The plan says for the n-th piece of a length where it goes.  It is a small table whatever the
   corpus; pieces find their line by a broadcast join, and no document moves for it.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from tallyforge.llm.common import written
from tallyforge.llm.tokens import KEPT_PIECES, encoder

END = 1  # the id that ends each document
TEXTS_AT_ONCE = 64
CHARS_AT_ONCE = 1 << 20
# Rows of (task, length) starts that may be broadcast, 24 bytes each; more meet by a shuffle.
BROADCAST_STARTS = 500_000


# -- the plan ----------------------------------------------------------------------------------


def combinations(lengths: list[int], window: int, spread: int = 12) -> list[tuple[int, ...]]:
    """Pairs and triples of the given lengths that fill a window exactly.

    All pairs; for each longest length of a triple, up to ``spread`` evenly spaced second ones.
    """
    present = set(lengths)
    found = [(a, window - a) for a in lengths if 2 * a >= window and window - a in present]
    for a in lengths:
        low, high = -(-(window - a) // 2), min(a, window - a - 1)
        if low <= high:
            for b in sorted({low + (high - low) * k // max(1, spread - 1) for k in range(spread)}):
                if b in present and window - a - b in present:
                    found.append((a, b, window - a - b))
    return found


def nonnegative_counts(patterns: list[tuple[int, ...]], histogram: dict[int, int], sweeps: int = 40) -> np.ndarray:
    """x >= 0 that minimises the squared difference of used and given counts, by coordinate descent."""
    rest = {n: float(c) for n, c in histogram.items()}
    columns = [list(Counter(p).items()) for p in patterns]
    norms = [sum(k * k for _, k in column) for column in columns]
    x = np.zeros(len(patterns))
    least = 1e-4 * max(1, sum(histogram.values()))
    for _ in range(sweeps):
        moved = 0.0
        for j, column in enumerate(columns):
            step = sum(k * rest[n] for n, k in column) / norms[j]
            step = max(step, -x[j])
            if step:
                x[j] += step
                moved += abs(step)
                for n, k in column:
                    rest[n] -= k * step
        if moved < least:
            break
    return x


class Stock:
    """Pieces not yet placed, by length: runs of (class, first, count, start).

    A run stands for pieces ``first`` to ``first + count - 1`` of the class (the length they were
    counted under), from token ``start`` of the piece on.
    """

    def __init__(self, histogram: dict[int, int]) -> None:
        self.runs = {n: [(n, 0, c, 0)] for n, c in histogram.items() if c}
        self.left = {n: c for n, c in histogram.items() if c}
        self.lengths = sorted(self.left)
        self.lines: list[tuple[int, ...]] = []
        self.sequences = 0

    def take(self, length: int, count: int) -> list[tuple[int, int, int, int]]:
        out, runs = [], self.runs[length]
        self.left[length] -= count
        while count:
            kind, first, have, start = runs.pop()
            used = min(have, count)
            out.append((kind, first, used, start))
            if have > used:
                runs.append((kind, first + used, have - used, start))
            count -= used
        if not self.left[length]:
            del self.left[length], self.runs[length]
            self.lengths.pop(bisect_left(self.lengths, length))
        return out

    def put(self, length: int, run: tuple[int, int, int, int]) -> None:
        if length not in self.left:
            self.left[length], self.runs[length] = 0, []
            insort(self.lengths, length)
        self.left[length] += run[2]
        self.runs[length].append(run)

    def place(self, pattern: list[tuple[int, int]], times: int) -> None:
        """``times`` sequences of the pattern's (length, tokens used) slots."""
        offset = 0
        for length, used in pattern:
            sequence = self.sequences
            for kind, first, count, start in self.take(length, times):
                self.lines.append((kind, first, first + count, start, used, sequence, offset))
                sequence += count
                if used < length:
                    self.put(length - used, (kind, first, count, start + used))
            offset += used
        self.sequences += times


def greedy_pattern(stock: Stock, window: int, max_gap: int) -> list[tuple[int, int]]:
    """The longest piece left, then the longest that fits, again and again; a large gap is cut to size."""
    used: Counter = Counter()
    pattern, gap = [], window
    while gap:
        i = bisect_right(stock.lengths, gap) - 1
        while i >= 0 and used[stock.lengths[i]] >= stock.left[stock.lengths[i]]:
            i -= 1
        if i >= 0:
            length, take = stock.lengths[i], stock.lengths[i]
        elif gap <= max_gap:
            break
        else:
            longer = (n for n in stock.lengths[bisect_right(stock.lengths, gap) :] if used[n] < stock.left[n])
            length = next(longer, 0)
            if not length:
                break
            take = gap
        used[length] += 1
        pattern.append((length, take))
        gap -= take
    return pattern


def plan(histogram: dict[int, int], window: int, max_gap: int = 16) -> list[tuple[int, ...]]:
    """Lines (length, first, end, start, tokens, sequence, offset).

    Pieces ``first`` to ``end - 1`` of that length give ``tokens`` ids from ``start`` on to the
    sequences from ``sequence`` on, at ``offset``.
    """
    stock = Stock(histogram)
    if window in stock.left:
        stock.place([(window, window)], stock.left[window])
    rest = dict(stock.left)
    patterns = combinations(sorted(rest), window)
    x = nonnegative_counts(patterns, rest)
    for j in np.argsort(-x, kind="stable"):
        times = min([int(x[j])] + [stock.left.get(n, 0) // k for n, k in Counter(patterns[j]).items()])
        if times:
            stock.place([(n, n) for n in patterns[j]], times)
    while stock.lengths:
        pattern = greedy_pattern(stock, window, max_gap)
        times = min(stock.left[n] // k for n, k in Counter(n for n, _ in pattern).items())
        stock.place(pattern, times)
    return stock.lines


# -- the job -----------------------------------------------------------------------------------


def pieces_of(docs: DataFrame, tokenizer: str, window: int, doc_id: str, text: str, kept_pieces: int) -> DataFrame:
    """Full windows and remainders of all documents, written once."""

    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, turns = TaskContext.get().partitionId(), Counter()
        step = 4 * window
        for batch in batches:
            ids, texts = batch["doc_id"].to_numpy(dtype=object), [t or "" for t in batch["text"]]
            at = 0
            while at < len(texts):
                end, chars = at, 0
                while end < len(texts) and end - at < TEXTS_AT_ONCE and (end == at or chars < CHARS_AT_ONCE):
                    chars += len(texts[end])
                    end += 1
                rows = []
                for doc, found in zip(ids[at:end], encoder(tokenizer).encode(texts[at:end], kept_pieces)):
                    found += END.to_bytes(4, "little")
                    for b in range(0, len(found), step):
                        part = found[b : b + step]
                        n = len(part) // 4
                        rows.append((doc, len(found) // 4, b // 4, n, part, task, turns[n]))
                        turns[n] += 1
                yield pd.DataFrame(rows, columns=names)
                at = end

    schema = StructType(
        [
            StructField("doc_id", docs.schema[doc_id].dataType),
            StructField("doc_tokens", LongType()),
            StructField("start", LongType()),
            StructField("length", IntegerType()),
            StructField("ids", BinaryType()),
            StructField("task", IntegerType()),
            StructField("turn", LongType()),
        ]
    )
    names = schema.names
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return written(source.mapInPandas(encoded, schema), "pieces")


def pack(
    docs: DataFrame,
    tokenizer: str,
    window: int = 2048,
    max_gap: int = 16,
    doc_id: str = "doc_id",
    text: str = "text",
    kept_pieces: int = KEPT_PIECES,
) -> DataFrame:
    """One row per piece: doc_id, doc_tokens, start, length, ids, sequence_id, offset.

    ``ids`` are little-endian unsigned 32-bit numbers.  Each document gives its tokens and an end
    mark (a null or empty text just that), every id lies in exactly one piece, a sequence holds at
    most ``window`` ids and is gapless from offset 0.  Rows are packed one by one: repeated
    documents and ids are no special case.  Other columns are not carried.  ``kept_pieces`` bounds
    what a worker process remembers of the tokenizer's answers, also after this job.
    """
    spark = docs.sparkSession
    pieces = pieces_of(docs, tokenizer, window, doc_id, text, kept_pieces)
    sizes = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    schema = "length int, first long, end long, cut long, tokens int, sequence long, offset long"
    lines = spark.createDataFrame(plan(histogram, window, max_gap), schema)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    if sizes.count() <= BROADCAST_STARTS:
        starts = F.broadcast(starts)
    ranked = pieces.join(starts, ["task", "length"]).withColumn("rank", F.col("earlier") + F.col("turn"))
    # The plan's size depends on the window alone, not on the corpus.
    placed = ranked.alias("p").join(
        F.broadcast(lines.alias("l")),
        (F.col("p.length") == F.col("l.length")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end")),
    )
    return placed.select(
        "doc_id",
        "doc_tokens",
        (F.col("start") + F.col("cut")).alias("start"),
        F.col("tokens").cast("long").alias("length"),
        F.expr("substring(ids, cast(4 * cut + 1 as int), 4 * tokens)").alias("ids"),
        (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"),
        "offset",
    )
