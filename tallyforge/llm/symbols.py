"""Global names for words, runs and pairs of symbols, given by rounds of Spark.

A block of documents holds its text as symbols.  In one exchange every block sends the distinct keys
it has (words, or pairs of numbers) to the tasks of their parts, in packed and sorted lists, with
whether two of its documents have them.  The task compares the keys themselves, not hashes, and
numbers those that two documents or more have; blocks get the numbers back.  So a number stands for
the same words everywhere, and what has none occurs in a single document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.crcspans import ranges
from tallyforge.llm.wordhash import BASE, distinct_words, from_planes, mix, planes
from tallyforge.scale import stored_by

ALONE = -1  # the name of what a single document has
LEVEL_SHIFT = 56  # names of different rounds differ in the bits from here on


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers in one string, ascending ones as their differences."""
    parts, kinds = [], []
    for a in arrays:
        step = np.diff(a.astype("<i8"), prepend=0)
        kinds.append(int(not len(step) or step[1:].min(initial=0) >= 0))
        parts.append(planes(step if kinds[-1] else a.astype("<i8")))
    head = np.array([len(parts), *map(len, parts), *kinds], dtype="<i8").tobytes()
    return zstandard.compress(head + b"".join(parts), 1)


def unpack(data: bytes) -> list[np.ndarray]:
    data = zstandard.decompress(data)
    n = int(np.frombuffer(data, "<i8", 1)[0])
    ends = 8 * (2 * n + 1) + np.cumsum(np.frombuffer(data, "<i8", n, 8))
    starts = np.append(8 * (2 * n + 1), ends[:-1])
    kinds = np.frombuffer(data, "<i8", n, 8 * (n + 1))
    values = [from_planes(data[a:b], "<i8") for a, b in zip(starts.tolist(), ends.tolist())]
    return [np.cumsum(v) if k else v for v, k in zip(values, kinds.tolist())]


def heads_of(*columns: np.ndarray) -> np.ndarray:
    """Places where sorted rows change."""
    new = np.zeros(len(columns[0]), dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


SENT = "part int, block long, base int, keys binary, many binary"
TOLD = "block long, local binary"


def _sent(part: int, block: int, base: int, keys: bytes, many: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([part], pa.int32()), pa.array([block], pa.int64()), pa.array([base], pa.int32())]
    columns += [pa.array([v], pa.binary()) for v in (keys, many.astype(np.uint8).tobytes())]
    return pa.RecordBatch.from_arrays(columns, ["part", "block", "base", "keys", "many"])


def _told(block: int, local: np.ndarray, names: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([pack(local, names)], pa.binary())], ["block", "local"])


def _gathered(told: DataFrame, name: str, buckets: int) -> DataFrame:
    """One list of answers for each block; a block gets at most as many as it asked."""
    return told.repartition(buckets, "block").groupBy("block").agg(F.collect_list("local").alias(name))


def names_of(told: list[bytes] | None, keys: int) -> np.ndarray:
    """The name of each of a block's keys, ALONE where there is none."""
    out = np.full(keys, ALONE, dtype=np.int64)
    for data in told or ():
        local, names = unpack(data)
        out[local] = names
    return out


# -- words ----------------------------------------------------------------------------------------


@dataclass
class Words:
    """A block's distinct words, by part, and for each of its words the place of its distinct one."""

    joined: bytes  # a newline after each
    begin: np.ndarray  # where each begins there, and the end
    many: np.ndarray  # documents that have the word, 2 for more
    cuts: np.ndarray  # where each part's words begin
    of: np.ndarray
    text: np.ndarray  # the text of each of its words

    @classmethod
    def of_texts(cls, texts: list[bytes], parts: int) -> Words:
        data = b"\n".join(texts) + b"\n"
        hashes, starts, ends, number, first, last = distinct_words(data)
        upto = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
        text = np.searchsorted(upto, starts, side="right")
        part = (mix(hashes[first]) % np.uint64(parts)).astype(np.int64)
        eights = np.ndarray(len(data), "<u8", data + bytes(8), strides=(1,))
        order = np.lexsort((eights[starts[first]].byteswap(), part))  # neighbours alike, which packs well
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        size = (ends - starts)[first[order]] + 1
        begin = np.append(0, np.cumsum(size))
        joined = np.frombuffer(data, np.uint8)[ranges(starts[first[order]], size)]
        joined[begin[1:] - 1] = 10
        many = 1 + (text[first] != text[last])[order]
        return cls(joined.tobytes(), begin, many, np.searchsorted(part[order], np.arange(parts + 1)), place[number], text)


def named_words(blocks: DataFrame, words_of: Callable[[dict], Words], parts: int, buckets: int) -> DataFrame:
    """(block, words): the names of each block's words, by their place in its ``Words``."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words = words_of(row)
                for p in np.flatnonzero(np.diff(words.cuts)).tolist():
                    a, b = words.cuts[p], words.cuts[p + 1]
                    keys = words.joined[words.begin[a] : words.begin[b]]
                    yield _sent(p, row["block"], int(a), zstandard.compress(keys, 1), words.many[a:b])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, blocks, bases, keys, many = 0, [], [], [], []
        for batch in batches:
            for row in batch.to_pylist():
                part = row["part"]
                blocks.append(row["block"])
                bases.append(row["base"])
                keys.append(zstandard.decompress(row["keys"]))
                many.append(np.frombuffer(row["many"], np.uint8))
        if not blocks:
            return
        *_, number, first, _ = distinct_words(b"".join(keys))
        del keys
        total = np.bincount(number, np.concatenate(many), len(first)).astype(np.int64)
        # Frequent words get small names, which pack well.
        order = np.argsort(-total, kind="stable")
        shared = order[total[order] > 1]
        names = np.full(len(first), ALONE, dtype=np.int64)
        names[shared] = np.arange(len(shared)) * parts + part
        for block, base, own in zip(blocks, bases, np.split(names[number], np.cumsum([len(m) for m in many])[:-1])):
            local = np.flatnonzero(own >= 0)
            if len(local):
                yield _told(block, local + base, own[local])

    sent = blocks.mapInArrow(send, SENT).repartitionById(parts, F.col("part"))
    return _gathered(sent.mapInArrow(add, TOLD), "words", buckets)


# -- pairs of numbers -----------------------------------------------------------------------------


@dataclass
class Keys:
    """A block's distinct pairs, by part and value, and for each of its rows the place of its pair."""

    left: np.ndarray
    right: np.ndarray
    many: np.ndarray  # documents that have the pair, 2 for more
    cuts: np.ndarray  # where each part's pairs begin
    of: np.ndarray

    @classmethod
    def of_rows(cls, left: np.ndarray, right: np.ndarray, doc: np.ndarray, parts: int) -> Keys:
        values, rank = np.unique(np.concatenate([left, right]), return_inverse=True)  # ranks fit in half a number
        key = rank[: len(left)] * np.int64(len(values)) + rank[len(left) :]
        order = np.argsort(key)
        heads = heads_of(key[order])
        sizes = np.diff(np.append(heads, len(order)))
        many = np.zeros(0, dtype=np.int64)
        if len(heads):
            docs = doc[order]
            many = 1 + (np.minimum.reduceat(docs, heads) != np.maximum.reduceat(docs, heads))
        a, b = left[order[heads]], right[order[heads]]
        part = (mix(a.astype(np.uint64) * np.uint64(BASE) + b.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
        by_part = np.argsort(part, kind="stable")
        place = np.empty(len(heads), dtype=np.int64)
        place[by_part] = np.arange(len(heads))
        of = np.empty(len(order), dtype=np.int64)
        of[order] = np.repeat(place, sizes)
        return cls(a[by_part], b[by_part], many[by_part], np.searchsorted(part[by_part], np.arange(parts + 1)), of)


def named_pairs(states: DataFrame, keys_of: Callable[[dict], Keys], level: int, parts: int, buckets: int, name: str) -> DataFrame:
    """(block, name): the names of each block's pairs, by their place in its ``Keys``."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                keys = keys_of(row)
                for p in np.flatnonzero(np.diff(keys.cuts)).tolist():
                    a, b = keys.cuts[p], keys.cuts[p + 1]
                    yield _sent(p, row["block"], int(a), pack(keys.left[a:b], keys.right[a:b]), keys.many[a:b])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, blocks, bases, left, right, many = 0, [], [], [], [], []
        for batch in batches:
            for row in batch.to_pylist():
                part = row["part"]
                blocks.append(row["block"])
                bases.append(row["base"])
                a, b = unpack(row["keys"])
                left.append(a)
                right.append(b)
                many.append(np.frombuffer(row["many"], np.uint8).astype(np.int64))
        if not blocks:
            return
        sizes = [len(a) for a in left]
        left, right, many = np.concatenate(left), np.concatenate(right), np.concatenate(many)
        order = np.lexsort((right, left))
        heads = heads_of(left[order], right[order])
        shared = np.add.reduceat(many[order], heads) > 1
        names = np.full(len(heads), ALONE, dtype=np.int64)
        names[shared] = (level << LEVEL_SHIFT) + np.arange(int(shared.sum())) * parts + part
        own = np.empty(len(order), dtype=np.int64)
        own[order] = np.repeat(names, np.diff(np.append(heads, len(order))))
        for block, base, names in zip(blocks, bases, np.split(own, np.cumsum(sizes)[:-1])):
            local = np.flatnonzero(names >= 0)
            if len(local):
                yield _told(block, local + base, names[local])

    sent = states.mapInArrow(send, SENT).repartitionById(parts, F.col("part"))
    return _gathered(sent.mapInArrow(add, TOLD), name, buckets)


def next_states(states: DataFrame, change: Callable[[dict], bytes], buckets: int, path: str) -> DataFrame:
    """(block, state) as ``change`` makes them of each row, stored by block where they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                yield pa.RecordBatch.from_arrays([pa.array([row["block"]], pa.int64()), pa.array([change(row)], pa.binary())], ["block", "state"])

    made = states.mapInArrow(run, "block long, state binary")
    return stored_by(made, path, ["block"], buckets, dealt=True)
