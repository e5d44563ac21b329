"""Token ids of whole texts by a byte-level BPE of the ``tokenizers`` library.

Such a tokenizer cuts a text into pieces by a pattern and encodes each piece alone, so each
worker process keeps the ids of the pieces it has met, from task to task.  Only new pieces are encoded.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct

import regex

# Fixed value: the pattern of the byte-level pre-tokenizer.
PIECES = regex.compile(
    r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# The same pieces from the faster standard module, for texts of the characters below only: those on
# which its classes agree with the pattern's (no numbers that are not digits, no separators that
# only one of the two takes for white space).
PLAIN_PIECES = re.compile(r"'(?:[sdmt]|ll|ve|re)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
PLAIN = re.compile(r"[\x00-\x1b\x20-\x7f\xa0-\xb1\xb4-\xb8\xba\xbb\xbf-ɏ‐-‧]*")

# Pieces kept by a worker process; some 200 bytes each.  Beyond that it starts anew.
KEPT_PIECES = 1_000_000


def cut(text: str) -> list[str]:
    return (PLAIN_PIECES if PLAIN.fullmatch(text) else PIECES).findall(text)


@functools.cache
def encoder(path: str) -> Encoder:
    """The one encoder of this process for the tokenizer file."""
    return Encoder(path)


def byte_of_sign() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for.

    Visible bytes of Latin-1 stand for themselves, the others are numbered from 256 on.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


def by_ranks(tokenizer):
    """A function that encodes a piece by the vocabulary's ids as ranks, or None.

    The ids of a byte-level vocabulary are ranks if they ascend in the order of the merges.  The
    ``tiktoken`` library then gives the same ids, several times faster for single pieces.
    """
    import tiktoken

    model = json.loads(tokenizer.to_str())["model"]
    vocab, merges = model.get("vocab"), model.get("merges")
    if model.get("type") != "BPE" or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
        return None
    added = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in merges]
    sign = byte_of_sign()
    if made != sorted(set(made)) or len(made) + 256 != len(set(vocab) - added):
        return None
    ranks = {bytes(sign[c] for c in token): number for token, number in vocab.items() if token not in added}
    return tiktoken.Encoding("pieces", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class Known(dict):
    """Packed ids by piece; a piece is encoded when it is first asked for."""

    def __init__(self, encode) -> None:
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        ids = self.encode(piece)
        packed = self[piece] = struct.pack(f"<{len(ids)}I", *ids)
        return packed


class Encoder:
    """Texts to little-endian unsigned 32-bit ids, as the library gives them without its own marks.

    Strings of added tokens inside a text are those tokens; what is between is encoded alone.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word for t in added.values()):
            raise ValueError("added tokens that take up their surroundings are not supported")
        self.added = {t.content: struct.pack("<I", number) for number, t in added.items()}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.marks = re.compile("|".join(map(re.escape, longest_first))) if longest_first else None
        self.tokenizer.encode_special_tokens = True  # they are taken out before
        encode = self.tokenizer.encode
        self.known = Known(by_ranks(self.tokenizer) or (lambda piece: encode(piece, add_special_tokens=False).ids))

    def encode(self, texts: list[str], kept: int = KEPT_PIECES) -> list[bytes]:
        if self.marks is not None and any(map(self.marks.search, texts)):
            return [self._with_marks(t, kept) for t in texts]
        return self._plain(texts, kept)

    def _with_marks(self, text: str, kept: int) -> bytes:
        marks = [self.added[m] for m in self.marks.findall(text)]
        between = self._plain(self.marks.split(text), kept)
        return b"".join(part for pair in zip(between, [*marks, b""]) for part in pair)

    def _plain(self, texts: list[str], kept: int) -> list[bytes]:
        out, known = [], self.known
        for text in texts:
            if len(known) > kept:
                known.clear()
            out.append(b"".join(map(known.__getitem__, cut(text))))
        return out
