"""Byte-level dedup by longest previous factors.

A byte is removed when a string of ``length`` bytes that covers it also starts earlier: in a
document with a smaller id, or further ahead in the same one.  That is the question whether the
longest previous factor of a suffix is at least ``length`` long, over all documents in order of id.

1. Every window of ``length`` bytes chooses an anchor, the least hashed gram within it, so equal
   windows choose the same one.  Blocks of documents exchange anchors; those met twice or more
   reveal where repeats can be.
2. The windows of one anchor follow each other; their bytes together are its context.  Each block
   sends its distinct contexts of such anchors to the anchor's task, with the first place of each.
   An anchor with very many different contexts is split: each window goes its own way.
3. The task keeps the first of equal contexts.  Where contexts of an anchor differ, it lays them
   out by position and takes the array of longest previous factors over them, up to ``length``; a
   window repeats an earlier one where its factor has that length.
4. The answers say which windows start earlier elsewhere; blocks cut out what these cover.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm import wordhash
from tallyforge.llm.blocks import Block, answered, asked, blocks_in, contains, finished, text_blocks, with_answers
from tallyforge.llm.factors import factors
from tallyforge.llm.wordhash import from_planes, from_steps, mix, planes, powers, steps

SPREAD = 64  # grams of a window; a context has at most so many windows, one bit each in an answer
KEY_BITS = 48
HOT_CONTEXTS = 4096  # different contexts of an anchor from which on its windows are sent one by one
BLOCK_BYTES = 4 << 20
PIECE_BYTES = 1 << 18  # bytes hashed at once
SORT_BYTES = 1 << 19  # bytes whose suffixes are sorted at once
PART_BYTES = 4 << 20  # text for each task that compares contexts, on average

_BYTES = np.random.default_rng(20240301).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = np.uint64((1 << 24) - 1)
_FULL = np.uint64(2**64 - 1)


# -- windows, anchors, contexts ------------------------------------------------------------------


def pieces(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Groups of (document, offset, bytes); long texts are cut so that each window lies in one piece."""
    group, size = [], 0
    for i, text in enumerate(texts):
        for offset in range(0, max(1, len(text) - length + 1), PIECE_BYTES):
            piece = text[offset : offset + PIECE_BYTES + length - 1]
            if len(piece) < length:
                continue
            if group and size + len(piece) > PIECE_BYTES:
                yield group
                group, size = [], 0
            group.append((i, offset, piece))
            size += len(piece)
    if group:
        yield group


def polynomial(buffer: np.ndarray):
    """A function that hashes the bytes from a to b, for arrays of a and b."""
    up, down = powers(len(buffer) + 1)
    sums = np.zeros(len(buffer) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[buffer] * up[: len(buffer)], out=sums[1:], dtype=np.uint64)
    return lambda a, b: mix((sums[b] - sums[a]) * down[a])


class Contexts:
    """The anchors' contexts of one group of pieces, as arrays."""

    def __init__(self, group: list[tuple[int, int, bytes]], length: int) -> None:
        gram = length - SPREAD + 1
        self.data = b"".join(p for _, _, p in group)
        buffer = np.frombuffer(self.data, np.uint8)
        sizes = np.array([len(p) for _, _, p in group])
        ends = np.cumsum(sizes)
        many = sizes - length + 1
        piece = np.repeat(np.arange(len(group)), many)
        starts = np.arange(len(piece)) - np.repeat(np.cumsum(many) - many, many) + (ends - sizes)[piece]
        self.hashed = polynomial(buffer)
        at = np.arange(len(buffer) - gram + 1)
        value = self.hashed(at, at + gram)
        least = (value & ~_PLACE) | at.astype(np.uint64)  # of equal grams the first
        size = 1
        while size < SPREAD:
            least = np.minimum(least[: len(least) - size], least[size:])
            size *= 2
        anchor = (least[starts] & _PLACE).astype(np.int64)
        new = np.ones(len(starts), dtype=bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1])
        heads = np.flatnonzero(new)
        self.length = length
        self.n = np.diff(np.append(heads, len(starts)))  # windows of each context
        self.begin = starts[heads]  # in the buffer
        self.end = self.begin + self.n + length - 1
        of = piece[heads]
        self.doc = np.array([d for d, _, _ in group])[of]
        self.start = self.begin - (ends - sizes)[of] + np.array([o for _, o, _ in group])[of]  # in the document
        self.key = value[anchor[heads]] >> np.uint64(64 - KEY_BITS)
        self.print = self.hashed(self.begin, self.end)

    def split(self, hot: np.ndarray) -> None:
        """Replaces the hot contexts by one for each window, with the window as its own anchor."""
        again = np.where(hot, self.n, 1)
        at = np.repeat(np.arange(len(again)), again)
        shift = np.arange(len(at)) - np.repeat(np.cumsum(again) - again, again)
        one = hot[at]
        self.begin, self.start, self.doc = self.begin[at] + shift, self.start[at] + shift, self.doc[at]
        self.n = np.where(one, 1, self.n[at])
        self.end = self.begin + self.n + self.length - 1
        self.print = self.hashed(self.begin, self.end)
        self.key = np.where(one, self.print >> np.uint64(64 - KEY_BITS), self.key[at])


COUNT = np.dtype([("places", "<u4"), ("contexts", "<u4")])


def heads_of(*columns: np.ndarray) -> np.ndarray:
    """Places where sorted rows change."""
    new = np.zeros(len(columns[0]), dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def first_of_equal(order: np.ndarray, bytes_of, *columns: np.ndarray) -> np.ndarray:
    """The first, in ``order``, of the rows that are equal: in the sorted columns and then in their bytes.

    Bytes are compared with those of the first row of the same hash; a row of other bytes is first itself.
    """
    heads = heads_of(*(c[order] for c in columns))
    many = np.diff(np.append(heads, len(order)))
    first = np.zeros(len(order), dtype=bool)
    first[heads] = True
    leader = order[np.repeat(heads, many)]
    last, said = -1, b""
    for k in np.flatnonzero(~first).tolist():
        if leader[k] != last:
            last, said = leader[k], bytes_of(leader[k])
        first[k] = bytes_of(order[k]) != said
    return order[first]


class Chosen:
    """A block's contexts of revealed anchors; ``first`` are the distinct ones' first places, by key."""

    def __init__(self, block: Block, row: dict, length: int) -> None:
        known, hot = answered(row, "shared", "u1")
        parts, self.bytes_of = [], []
        for group in pieces(block.texts, length):
            c = Contexts(group, length)
            hit, at = contains(known, c.key)
            hit &= block.known[c.doc]
            for name in ("key", "print", "doc", "start", "n", "begin", "end"):
                setattr(c, name, getattr(c, name)[hit])
            is_hot = hot[at[hit]] > 0 if len(known) else np.zeros(0, dtype=bool)
            if is_hot.any():
                c.split(is_hot)
            del c.hashed  # holds a number for each byte
            parts.append(c)
        join = lambda name, kind: np.concatenate([np.empty(0, dtype=kind), *(getattr(c, name) for c in parts)])
        self.key, self.print = join("key", np.uint64), join("print", np.uint64)
        self.doc, self.start, self.n = join("doc", np.int64), join("start", np.int64), join("n", np.int64)
        self.begin, self.end = join("begin", np.int64), join("end", np.int64)
        self.group = np.repeat(np.arange(len(parts)), [len(c.key) for c in parts]).astype(np.int64)
        self.data = [c.data for c in parts]
        self.ids = block.ids[self.doc]
        order = np.lexsort((self.start, self.ids, self.print, self.key))
        self.first = first_of_equal(order, self.bytes, self.key, self.print)

    def bytes(self, i: int) -> bytes:
        return self.data[self.group[i]][self.begin[i] : self.end[i]]


ROW = "part int, block long, keys binary, ids binary, starts binary, n binary, bytes binary"


def compare(keys, ids, starts, n, whole: bytes, length: int) -> np.ndarray:
    """For each context a mask: bit j is set if its j-th window starts earlier than there."""
    size = n + length - 1
    begin = np.cumsum(size) - size
    prints = np.concatenate(
        [np.empty(0, dtype=np.uint64)]
        + [
            polynomial(np.frombuffer(whole[begin[a] : begin[b - 1] + size[b - 1]], np.uint8))(begin[a:b] - begin[a], begin[a:b] - begin[a] + size[a:b])
            for a, b in slices_of(size)
        ]
    )
    order = np.lexsort((starts, ids, prints, keys))
    first = first_of_equal(order, lambda i: whole[begin[i] : begin[i] + size[i]], keys, prints)
    mask = np.full(len(keys), _FULL)
    mask[first] = 0
    # A key with one context is done.
    key = keys[first]
    alone = np.ones(len(key), dtype=bool)
    alone[1:] &= key[1:] != key[:-1]
    alone[:-1] &= key[1:] != key[:-1]
    open_ = first[~alone]
    open_ = open_[np.argsort(keys[open_], kind="stable")]
    for a, b in slices_of(size[open_], keys[open_]):
        part = open_[a:b]
        part = part[np.lexsort((starts[part], ids[part]))]  # positions in order of document and start
        buffer = np.frombuffer(b"".join([whole[begin[i] : begin[i] + size[i]] for i in part.tolist()]), np.uint8)
        at = np.cumsum(size[part]) - size[part]
        own = np.repeat(np.arange(len(part)), n[part])
        bit = np.arange(len(own)) - np.repeat(np.cumsum(n[part]) - n[part], n[part])
        found = factors(buffer, length, at[own] + bit) >= length
        bits = np.where(found, np.uint64(1) << bit.astype(np.uint64), np.uint64(0))
        mask[part] = np.add.reduceat(bits, np.flatnonzero(bit == 0))
    return mask


def slices_of(sizes: np.ndarray, keys: np.ndarray | None = None) -> Iterator[tuple[int, int]]:
    """Stretches of about SORT_BYTES that do not part equal keys."""
    ends, a = np.cumsum(sizes), 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] - sizes[a] + SORT_BYTES, side="right")))
        if keys is not None:
            b = int(np.searchsorted(keys, keys[b - 1], side="right"))
        yield a, b
        a = b


def suffix_dedup(docs: DataFrame, length: int = 100, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows with n_bytes, n_removed, n_spans and ``kept`` (the bytes left) for the text.

    Strings are judged on the input; n_spans counts the maximal removed runs.  Null and short texts
    lose nothing.  Rows with equal ids are one document to this rule, compared by start alone; rows
    without an id neither lose bytes nor make others lose them.  Ids are read as whole numbers.
    Other columns are kept; ones named like a result are replaced.
    """
    if length < SPREAD + 16:
        raise ValueError(f"length must be {SPREAD + 16} or more")
    spark = docs.sparkSession
    docs = docs.withColumn(doc_id, F.col(f"`{doc_id}`").cast("long"))
    blocks = text_blocks(docs, doc_id, text, BLOCK_BYTES)
    size = blocks.agg(F.sum("bytes")).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))

    def ask(block: Block, row: dict):
        keys, prints = [np.empty(0, dtype=np.uint64)], [np.empty(0, dtype=np.uint64)]
        for group in pieces(block.texts, length):
            c = Contexts(group, length)
            keys.append(c.key[block.known[c.doc]])
            prints.append(c.print[block.known[c.doc]])
        keys, prints = np.concatenate(keys), np.concatenate(prints)
        order = np.lexsort((prints, keys))
        keys, prints = keys[order], prints[order]
        heads = heads_of(keys)
        extra = np.empty(len(heads), dtype=COUNT)
        extra["places"] = np.minimum(np.diff(np.append(heads, len(keys))), 2)
        different = np.zeros(len(keys), dtype=np.int64)
        different[heads_of(keys, prints)] = 1
        extra["contexts"] = np.add.reduceat(different, heads) if len(heads) else 0
        return keys[heads], extra

    def shared(keys, of, extra):
        heads = heads_of(keys)
        many = np.diff(np.append(heads, len(keys)))
        twice = np.add.reduceat(extra["places"].astype(np.int64), heads) > 1
        hot = np.add.reduceat(extra["contexts"].astype(np.int64), heads) > HOT_CONTEXTS
        return np.repeat(twice, many), np.repeat(hot, many).astype(np.uint8)

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        borders = np.array([(p << KEY_BITS) // parts for p in range(1, parts)], dtype=np.uint64)
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for block, row in blocks_in(batches):
            c = Chosen(block, row, length)
            keys = c.key[c.first]
            cuts = [0, *np.searchsorted(keys, borders).tolist(), len(keys)]
            for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
                if b > a:
                    i = c.first[a:b]
                    data = squeeze(b"".join(map(c.bytes, i.tolist())))
                    cells = (p, block.number, steps(keys[a:b]), planes(c.ids[i]), planes(c.start[i]), c.n[i].astype(np.uint8).tobytes(), data)
                    yield pd.DataFrame([cells], columns=[f.split()[0] for f in ROW.split(", ")])

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got, texts = [], []
        expand = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for r in batch.itertuples(index=False):
                n = np.frombuffer(r.n, np.uint8).astype(np.int64)
                got.append((r.part, r.block, from_steps(r.keys), from_planes(r.ids, np.int64), from_planes(r.starts, np.int64), n))
                texts.append(expand(r.bytes))
        if got:
            arrays = [np.concatenate([g[k] for g in got]) for k in range(2, 6)]
            whole = b"".join(texts)
            texts.clear()
            mask = compare(*arrays, whole, length)
            at = 0
            for part, block, keys, *_ in got:
                yield pd.DataFrame({"part": [part], "block": [block], "masks": [planes(mask[at : at + len(keys)])]})
                at += len(keys)

    def result(block: Block, row: dict):
        c = Chosen(block, row, length)
        told = sorted(row["masks"], key=lambda a: a["part"]) if row["masks"] is not None else []
        masks = np.concatenate([np.empty(0, dtype=np.uint64)] + [from_planes(a["masks"], np.uint64) for a in told])
        # Of equal contexts in the block, all but the first repeat it.
        mask = np.full(len(c.key), _FULL)
        mask[c.first] = masks
        # Stretches of windows to remove: whole contexts, and single windows of others.
        full = _FULL >> (np.uint64(64) - c.n.astype(np.uint64))
        whole = np.flatnonzero((mask & full) == full)
        rest = np.flatnonzero(((mask & full) != full) & ((mask & full) > 0))
        own = np.repeat(rest, c.n[rest])
        bit = np.arange(len(own)) - np.repeat(np.cumsum(c.n[rest]) - c.n[rest], c.n[rest])
        one = (mask[own] >> bit.astype(np.uint64)) & np.uint64(1) > 0
        own, bit = own[one], bit[one]
        doc = np.concatenate([c.doc[whole], c.doc[own]])
        start = np.concatenate([c.start[whole], c.start[own] + bit])
        to = np.concatenate([c.start[whole] + c.n[whole], c.start[own] + bit + 1]) + length - 1
        order = np.lexsort((start, doc))
        doc, start, to = doc[order], start[order], to[order]
        # Windows are in one context each, so stretches that start later also end later.
        new = np.ones(len(doc), dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > to[:-1])
        heads = np.flatnonzero(new)
        span_doc, span_from = doc[heads], start[heads]
        span_to = to[np.append(heads[1:], len(doc)) - 1] if len(heads) else to
        cuts = np.searchsorted(span_doc, np.arange(len(block.texts) + 1)).tolist()
        out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept": []}
        for i, text in enumerate(block.texts):
            spans = list(zip(span_from[cuts[i] : cuts[i + 1]].tolist(), span_to[cuts[i] : cuts[i + 1]].tolist()))
            edges = [0, *(x for s in spans for x in s), len(text)]
            kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
            out["n_bytes"].append(len(text))
            out["n_removed"].append(len(text) - len(kept))
            out["n_spans"].append(len(spans))
            out["kept"].append(kept)
        return out

    reveal = asked(blocks, ask, shared, COUNT.descr, parts, KEY_BITS)
    revealed = with_answers(blocks, reveal, "shared")
    sent = revealed.mapInPandas(send, ROW).repartitionById(parts, F.col("part"))
    masks = sent.mapInPandas(judge, "part int, block long, masks binary")
    masks = masks.groupBy("block").agg(F.collect_list(F.struct("part", "masks")).alias("masks"))
    schema = "n_bytes long, n_removed long, n_spans long, kept binary"
    return finished(revealed.join(masks, "block", "left"), result, docs, text, schema)
