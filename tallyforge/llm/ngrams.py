"""Hashed character n-grams of many texts at once, as sparse counts."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

# Texts are handled in slices of about this many characters, so memory does not follow the batch.
SLICE_CHARS = 1 << 18
SLICE_TEXTS = 32

_ODD = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], dtype=np.uint32)


def slices(texts: Iterable[str | None]) -> Iterator[list[str]]:
    """Consecutive texts, null as empty, in groups of bounded size (or a single longer text)."""
    group: list[str] = []
    chars = 0
    for text in texts:
        text = text or ""
        if group and (chars + len(text) > SLICE_CHARS or len(group) >= SLICE_TEXTS):
            yield group
            group, chars = [], 0
        group.append(text)
        chars += len(text)
    if group:
        yield group


def packed(row: np.ndarray, values: np.ndarray, rows: int) -> list[bytes]:
    """The values of each row as bytes: small on their way to the driver, unlike lists of objects."""
    return [part.tobytes() for part in np.split(values, np.searchsorted(row, np.arange(1, rows)))]


def counts(texts: list[str], bits: int, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, count) of the n-grams of 1 to ``longest`` lower-cased characters.

    Rows ascend, and buckets ascend within a row.  Each text is framed by spaces; every run of
    white space counts as one space and every digit as a zero.
    """
    framed = [" " + " ".join(t.lower().split()) + " " for t in texts]
    lengths = np.array([len(t) for t in framed], dtype=np.int64)
    # surrogatepass: a lone surrogate is a character like any other here
    chars = np.frombuffer("".join(framed).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint32)
    chars = np.where((chars >= 48) & (chars <= 57), np.uint32(48), chars)
    row = np.repeat(np.arange(len(texts), dtype=np.int64), lengths)
    ends = np.repeat(np.cumsum(lengths), lengths)
    place = np.arange(len(chars))
    width = 1 << bits
    total = np.zeros(len(texts) * width, dtype=np.int64)
    mixed = np.zeros(len(chars), dtype=np.uint32)
    for n in range(1, longest + 1):
        # The n-gram that starts here: what is known of its first n - 1 characters, and the next one.
        step = chars[n - 1 :]
        mixed = (mixed[: len(step)] ^ step) * _ODD[n % len(_ODD)]
        mixed ^= mixed >> np.uint32(15)
        inside = place[: len(step)] + n <= ends[: len(step)]
        bucket = ((mixed * _ODD[0]) >> np.uint32(32 - bits)).astype(np.int64)
        total += np.bincount((row[: len(step)] * width + bucket)[inside], minlength=len(total))
    hit = np.flatnonzero(total)
    return hit >> bits, hit & (width - 1), total[hit]
