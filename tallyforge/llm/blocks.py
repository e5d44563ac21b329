"""Documents in blocks of bounded size, and questions about hashes that blocks ask one another.

A block is one row: ids, texts (compressed together) and the other columns of some megabytes of
documents.  Blocks are written once, so their numbers and contents stay the same whatever is lost
later.  Duplicate search then works block by block: a block sends sorted, packed hashes to the
tasks of their hash ranges and gets answers back, by block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyforge.llm.common import written
from tallyforge.llm.wordhash import from_planes, from_steps, planes, steps
from tallyforge.scale import new_path, stored_by

BLOCK_BYTES = 4 << 20
BLOCK_DOCS = 20_000
# Hashes that a task of a hash range gets, on average.
RANGE_HASHES = 2_000_000

SCHEMA = "block long, bytes long, ids binary, known binary, sizes binary, texts binary, rest binary"


@dataclass
class Block:
    """One block in memory.  ``known`` is False for documents without an id."""

    number: int
    ids: np.ndarray
    known: np.ndarray
    texts: list[bytes]  # null: empty
    null: np.ndarray
    rest: pa.Table

    @classmethod
    def of(cls, row: dict) -> Block:
        sizes = np.frombuffer(row["sizes"], "<i8")  # -1: null
        null, sizes = sizes < 0, np.maximum(sizes, 0)
        data = zstandard.ZstdDecompressor().decompress(row["texts"])
        ends = np.cumsum(sizes).tolist()
        texts = [data[e - s : e] for e, s in zip(ends, sizes.tolist())]
        rest = pa.ipc.open_stream(row["rest"]).read_all()
        ids = np.frombuffer(row["ids"], "<i8")
        return cls(row["block"], ids, np.frombuffer(row["known"], bool), texts, null, rest)


def _sink(table: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema) as writer:
        writer.write_table(table)
    return out.getvalue().to_pybytes()


def text_blocks(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block_bytes: int | None = None, buckets: int | None = None
) -> DataFrame:
    """``docs``, whose ids are longs, as written blocks of ``block_bytes`` (BLOCK_BYTES), or one longer text.

    The columns besides the text are kept in ``rest``.  With ``buckets`` the blocks are stored by
    number in so many files, where answers can be brought to them.
    """
    names, most = docs.columns, block_bytes or BLOCK_BYTES
    id_at, text_at = names.index(doc_id), names.index(text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=3).compress
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = batch.column(text_at)
            sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(texts), 0), dtype=np.int64)
            ends = np.cumsum(sizes)
            a = 0
            while a < batch.num_rows:
                limit = ends[a] - sizes[a] + most
                b = max(a + 1, min(int(np.searchsorted(ends, limit, side="right")), a + BLOCK_DOCS))
                part = batch.slice(a, b - a)
                ids = part.column(id_at)
                values = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in part.column(text_at)]
                rest = pa.Table.from_batches([part]).remove_column(text_at)
                row = {
                    "block": (task << 32) + number,
                    "bytes": int(sizes[a:b].sum()),
                    "ids": np.asarray(pa.compute.fill_null(ids, 0), dtype="<i8").tobytes(),
                    "known": np.asarray(pa.compute.is_valid(ids), dtype=bool).tobytes(),
                    "sizes": np.where(np.asarray(part.column(text_at).is_valid()), sizes[a:b], -1).astype("<i8").tobytes(),
                    "texts": compress(b"".join(values)),
                    "rest": _sink(rest),
                }
                number += 1
                a = b
                yield pa.RecordBatch.from_pylist([row], schema=arrow_schema)

    arrow_schema = pa.schema(
        [("block", pa.int64()), ("bytes", pa.int64()), *((n, pa.binary()) for n in ("ids", "known", "sizes", "texts", "rest"))]
    )
    if buckets:
        return stored_by(docs.mapInArrow(cut, SCHEMA), new_path(docs.sparkSession, "text_blocks"), ["block"], buckets)
    return written(docs.mapInArrow(cut, SCHEMA), "blocks")


def blocks_in(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[Block, dict]]:
    """One block after another, with its row (answers among its columns)."""
    for batch in batches:
        for row in batch.to_dict("records"):
            yield Block.of(row), row


ROW = "part int, block long, data binary, extra binary"
ROW_NAMES = ["part", "block", "data", "extra"]


def ranges(hashes: int, least: int) -> int:
    """How many tasks share the hash space."""
    return max(least, -(-hashes // RANGE_HASHES))


def by_range(block: int, hashes: np.ndarray, extra: np.ndarray | None, parts: int, bits: int = 64) -> pd.DataFrame:
    """Rows that bring ascending hashes, and a number or record for each, to the tasks of their ranges."""
    borders = np.array([(p << bits) // parts for p in range(1, parts)], dtype=np.uint64)
    cuts = [0, *np.searchsorted(hashes, borders).tolist(), len(hashes)]
    rows = [
        (p, block, steps(hashes[a:b]), None if extra is None else planes(extra[a:b]))
        for p, (a, b) in enumerate(zip(cuts, cuts[1:]))
        if b > a
    ]
    return pd.DataFrame(rows, columns=ROW_NAMES)


def asked(
    blocks: DataFrame,
    question: Callable[[Block, dict], tuple[np.ndarray, np.ndarray | None]],
    answer: Callable[[np.ndarray, np.ndarray, np.ndarray | None], tuple[np.ndarray, np.ndarray | None]],
    extra: str | list | None,
    parts: int,
    bits: int = 64,
) -> DataFrame:
    """(block, data, extra): for each block the answers to its hashes.

    ``question(block, row)`` gives the block's ascending distinct hashes and a number for each.
    ``answer(hashes, of, extra)`` sees all hashes of a range in ascending order, the place of their
    block in ``of``, and returns which to send back and what number with each.  A hash is sent once
    by a block however often it occurs there, so the hottest one costs a row for each block.
    """
    kind = None if extra is None else np.dtype(extra)

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block, row in blocks_in(batches):
            hashes, numbers = question(block, row)
            yield by_range(block.number, hashes, numbers, parts, bits)

    def reply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        numbers, hashes, extras = [], [], []
        for batch in batches:
            for block, data, more in zip(batch["block"], batch["data"], batch["extra"]):
                numbers.append(block)
                hashes.append(from_steps(data))
                extras.append(None if kind is None else from_planes(more, kind))
        if not numbers:
            return
        of = np.repeat(np.arange(len(numbers)), [len(h) for h in hashes])
        every = np.concatenate(hashes)
        every_extra = None if kind is None else np.concatenate(extras)
        del hashes, extras
        order = np.argsort(every, kind="stable")
        every, of = every[order], of[order]
        keep, told = answer(every, of, None if kind is None else every_extra[order])
        every, of = every[keep], of[keep]
        told = None if told is None else told[keep]
        back = np.argsort(of, kind="stable")  # by block, hashes ascending still
        every, of = every[back], of[back]
        told = None if told is None else told[back]
        cuts = np.searchsorted(of, np.arange(len(numbers) + 1))
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if b > a:
                row = (0, numbers[i], steps(every[a:b]), None if told is None else planes(told[a:b]))
                yield pd.DataFrame([row], columns=ROW_NAMES)

    sent = blocks.mapInPandas(send, ROW).repartitionById(parts, F.col("part"))
    told = sent.mapInPandas(reply, ROW)
    # One list for each block; a block gets at most as many answers as it asked.
    return told.groupBy("block").agg(F.collect_list(F.struct("data", "extra")).alias("answers"))


def with_answers(blocks: DataFrame, answers: DataFrame, name: str) -> DataFrame:
    """``blocks`` with the list of answers, null where there are none."""
    return blocks.join(answers.withColumnRenamed("answers", name), "block", "left")


def answered(row: dict, name: str, extra: str | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """The hashes answered to a block, ascending, and their numbers."""
    found = row[name]
    if found is None or len(found) == 0:
        return np.empty(0, dtype=np.uint64), None if extra is None else np.empty(0, dtype=extra)
    hashes = np.concatenate([from_steps(a["data"]) for a in found])
    order = np.argsort(hashes, kind="stable")
    if extra is None:
        return hashes[order], None
    return hashes[order], np.concatenate([from_planes(a["extra"], extra) for a in found])[order]


def contains(ordered: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values occur in ``ordered``, and where."""
    at = np.searchsorted(ordered, values)
    at[at == len(ordered)] = 0
    return (ordered[at] == values) if len(ordered) else np.zeros(len(values), dtype=bool), at


def finished(
    blocks: DataFrame, result: Callable[[Block, dict], dict[str, Sequence]], docs: DataFrame, text: str, schema: str
) -> DataFrame:
    """Documents again: the columns of ``docs`` but the text, and the columns ``result`` gives."""
    own = StructType.fromDDL(schema)
    new = {n.lower() for n in own.names}
    kept = [f for f in docs.schema.fields if f.name != text and f.name.lower() not in new]
    out = StructType(kept + own.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block.of(row)
                columns = {f.name: block.rest.column(f.name) for f in kept}
                columns.update({n: pa.array(v) for n, v in result(block, row).items()})
                table = pa.table(columns)
                yield from table.combine_chunks().to_batches()

    return blocks.mapInArrow(run, out)
