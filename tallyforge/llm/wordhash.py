"""64-bit hashes of the words of many texts at once.

A word is a run of bytes other than ASCII white space.  Its hash is a polynomial over a fixed
random value for each byte, taken from running sums over the whole buffer and then mixed, so no
Python code runs for each word.  Equal words have equal hashes everywhere; different ones meet with
probability about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTES[_SPACE] = 0

CHUNK = 1 << 19  # bytes hashed at once; a longer word makes its chunk longer

_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """BASE**i and BASE**-i for i below at least n, modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, CHUNK + 4096)
        for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _hash_chunk(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    space = np.empty(len(data) + 2, dtype=bool)
    space[0] = space[-1] = True
    space[1:-1] = _SPACE[data]
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[0::2], edges[1::2]
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[data] * up[: len(data)], out=sums[1:], dtype=np.uint64)
    return mix((sums[ends] - sums[starts]) * down[starts]), starts, ends


def hash_words(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of every word of ``data``, in order."""
    buffer = np.frombuffer(data, dtype=np.uint8)
    parts, at = [], 0
    while at < len(buffer):
        end = min(len(buffer), at + CHUNK)
        if end < len(buffer):  # cut at white space
            back = np.flatnonzero(_SPACE[buffer[at:end]])
            if len(back):
                end = at + int(back[-1]) + 1
            else:
                ahead = np.flatnonzero(_SPACE[buffer[end:]])
                end = end + int(ahead[0]) + 1 if len(ahead) else len(buffer)
        h, s, e = _hash_chunk(buffer[at:end])
        parts.append((h, s + at, e + at))
        at = end
    if not parts:
        empty = np.empty(0, dtype=np.int64)
        return np.empty(0, dtype=np.uint64), empty, empty
    return tuple(np.concatenate(x) for x in zip(*parts))


def distinct_words(data: bytes) -> tuple[np.ndarray, ...]:
    """(hash, start, end, number) of every word of ``data``, and the first and last place of each number.

    Equal words have equal numbers and others do not: words of one hash are compared byte by byte.
    """
    hashes, starts, ends = hash_words(data)
    order = np.argsort(hashes)
    heads = np.flatnonzero(np.diff(hashes[order], prepend=~hashes[order[:1]]))
    if not len(heads):
        return hashes, starts, ends, order, order, order
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(order))))
    first, last = np.minimum.reduceat(order, heads), np.maximum.reduceat(order, heads)
    leader = first[number]
    sizes = ends - starts
    odd = sizes != sizes[leader]
    eights = np.ndarray(len(data) + 1, "<u8", data + bytes(8), strides=(1,))  # the eight bytes from each place on
    left = np.flatnonzero(~odd & (leader != np.arange(len(order))))
    for depth in range(0, 64, 8):
        more = sizes[left] - depth
        beyond = (8 * (8 - np.minimum(more, 8))).astype(np.uint64)
        odd[left] = (eights[starts[left] + depth] ^ eights[starts[leader[left]] + depth]) << beyond != 0
        left = left[~odd[left] & (more > 8)]
    for k in left.tolist():
        odd[k] = data[starts[k] : ends[k]] != data[starts[leader[k]] : ends[leader[k]]]
    if odd.any():
        others: dict[bytes, int] = {}
        for k in np.flatnonzero(odd).tolist():
            number[k] = others.setdefault(data[starts[k] : ends[k]], len(heads) + len(others))
        first, last = np.full(len(heads) + len(others), len(order)), np.zeros(len(heads) + len(others), dtype=np.int64)
        np.minimum.at(first, number, np.arange(len(order)))
        np.maximum.at(last, number, np.arange(len(order)))
    return hashes, starts, ends, number, first, last


def word_arrays(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and for each text the place of its first word (plus the end)."""
    hashes, starts, _ = hash_words(b"\n".join(texts))
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
    return hashes, np.searchsorted(starts, offsets)


def runs_of(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` hashes, by its first place."""
    n = max(0, len(hashes) - width + 1)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(width):
        out = out * np.uint64(BASE) + hashes[j : j + n]
    return mix(out)


def grouped(texts, limit: int = 1 << 18) -> Iterator[list[bytes]]:
    """Consecutive texts as UTF-8 (null: empty), in groups of about ``limit`` bytes."""
    return in_groups((b"" if text is None else text.encode() for text in texts), limit)


def in_groups(texts, limit: int = 1 << 18) -> Iterator[list[bytes]]:
    """Consecutive texts in groups of about ``limit`` bytes; a longer text is a group of its own."""
    group: list[bytes] = []
    size = 0
    for data in texts:
        if group and size + len(data) > limit:
            yield group
            group, size = [], 0
        group.append(data)
        size += len(data)
    if group:
        yield group


def planes(values: np.ndarray) -> bytes:
    """Numbers stored byte by byte, all first bytes, then all second bytes: small ones compress well."""
    size = values.dtype.itemsize
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, size).T).tobytes()


def from_planes(data: bytes, dtype) -> np.ndarray:
    dtype = np.dtype(dtype)
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(dtype.itemsize, -1).T).view(dtype).ravel()


def steps(values: np.ndarray) -> bytes:
    """Ascending uint64 numbers as planes of their differences."""
    return planes(np.diff(values, prepend=np.uint64(0)))


def from_steps(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data, np.uint64), dtype=np.uint64)
