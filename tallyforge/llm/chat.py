"""Chat formatting of conversation tables by compiled templates, and reading the output back.

A conversation is rendered turn by turn where its rows lie; window functions only tell each row its
number and whether it is the first or last.  The output is one piece for each turn, in order; the
pieces of a conversation together are its formatted text.  No task holds a whole conversation, so
one of any length (or a third of all rows) is only sorted, on disk if need be.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.templates import compile_template, unescape, unescape_line

# Turns between control strings; what assistants say is learned.
CHAT = (
    "{% for message in messages %}"
    "<|im_start|>{{ message.role | line }}\n"
    "{% if message.role == 'assistant' %}"
    "{% generation %}{{ message.text | escape }}{% endgeneration %}"
    "{% else %}{{ message.text | escape }}{% endif %}"
    "<|im_end|>\n"
    "{% endfor %}"
)

PIECE = "conv_id long, piece long, formatted string, spans array<struct<start: int, end: int>>"


def format_conversations(
    rows: DataFrame, template: str = CHAT, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per turn: conv_id, piece (its number, from 0), formatted, spans.

    ``spans`` are the learned parts of the piece, in code points.  Turns are ordered by turn, and
    rows of one turn by role and text; null turns come first.  A null text or role counts as empty;
    repeated rows are repeated turns; rows without conv_id are one conversation, without id.  Other
    columns are not carried.  Empty tables give empty tables.
    """
    compile_template(template)  # errors are shown here rather than in a task
    own = rows.select(
        F.col(f"`{conv_id}`").cast("long").alias("conv_id"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = own.select(
        "conv_id",
        (F.row_number().over(order).cast("long") - 1).alias("piece"),
        F.lead(F.lit(1)).over(order).isNull().alias("last"),
        "role",
        "text",
    )

    def render(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compiled = compile_template(template)
        for b in batches:
            done = [
                compiled.turn({"role": r, "text": t}, n, n == 0, last)
                for n, last, r, t in zip(b["piece"].tolist(), b["last"].tolist(), b["role"], b["text"])
            ]
            out = b[["conv_id", "piece"]].copy()
            out["formatted"] = [d[0] for d in done]
            out["spans"] = [[{"start": s, "end": e} for s, e in d[1]] for d in done]
            yield out

    return placed.mapInPandas(render, PIECE)


_TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.DOTALL)

READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


class Reading:
    """Running sums over the pieces of one conversation."""

    def __init__(self) -> None:
        self.turns = self.loss_chars = self.chars = 0
        self.turns_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, spans) -> None:
        self.chars += len(formatted)
        at = 0
        for m in _TURN.finditer(formatted):
            if m.start() != at:
                raise ValueError(f"not a turn: {formatted[at:][:80]!r}")
            at = m.end()
            self.turns += 1
            self.turns_hash.update(f"{unescape_line(m[1])}\n{unescape(m[2])}\n".encode())
        if at != len(formatted):
            raise ValueError(f"not a turn: {formatted[at:][:80]!r}")
        for span in spans:
            learned = unescape(formatted[span["start"] : span["end"]])
            self.loss_chars += len(learned)
            self.loss_hash.update(learned.encode())

    def row(self, conversation) -> tuple:
        return conversation, self.turns, self.turns_hash.hexdigest(), self.loss_chars, self.loss_hash.hexdigest(), self.chars


def read_back(pieces: DataFrame) -> DataFrame:
    """Per conversation what its formatted text (of the CHAT template) says.

    Pieces are sorted within their task and read one after another; only running hashes are kept.
    """
    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "piece")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in READ.split(", ")]
        current, reading = None, None
        for b in batches:
            rows = []
            for c, formatted, spans in zip(b["conv_id"], b["formatted"], b["spans"]):
                c = None if pd.isna(c) else int(c)
                if reading is None or c != current:
                    if reading is not None:
                        rows.append(reading.row(current))
                    current, reading = c, Reading()
                reading.add(formatted, spans)
            yield pd.DataFrame(rows, columns=names).astype({"conv_id": "Int64"})
        if reading is not None:
            yield pd.DataFrame([reading.row(current)], columns=names).astype({"conv_id": "Int64"})

    return ordered.mapInPandas(read, READ)
