"""CRC-32 of many spans of a buffer at once, from a table of byte and distance from the span's end.

A checksum register is linear in the message: each byte adds (by exclusive or) an amount that
depends on the byte and on how many bytes follow it, and the start value adds one that depends on
the length alone.  Both are tabulated, so a span's checksum is the exclusive or of looked-up
values, taken by ``bitwise_xor.reduceat``.  The table has DEPTH distances; a longer span is taken
in blocks of DEPTH bytes counted from its end, and neighbouring blocks are folded, the earlier one
moved over the bytes of the later.
"""

from __future__ import annotations

import zlib

import numpy as np

POLYNOMIAL = 0xEDB88320  # CRC-32 as in zlib
DEPTH = 64
SLICE = 1 << 18  # bytes of spans looked up at once


def _byte_steps() -> np.ndarray:
    """What eight shifts make of each low byte."""
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, (value >> 1) ^ np.uint32(POLYNOMIAL), value >> 1).astype(np.uint32)
    return value


_STEP = _byte_steps()


def _positions() -> np.ndarray:
    """[distance from the end, byte]: what the byte adds."""
    table = np.empty((DEPTH, 256), dtype=np.uint32)
    table[0] = _STEP
    for d in range(1, DEPTH):
        table[d] = (table[d - 1] >> 8) ^ _STEP[table[d - 1] & 0xFF]
    return table


_POSITIONS = _positions().ravel()
_EMPTY = np.array([zlib.crc32(bytes(n)) for n in range(DEPTH + 1)], dtype=np.uint32)


def _shifter(zeros: int) -> np.ndarray:
    """[byte of the register, its value]: the register after as many zero bytes."""
    table = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)
    for _ in range(zeros):
        table = (table >> 8) ^ _STEP[table & 0xFF]
    return table


_BLOCK_SHIFT = _shifter(DEPTH)


def _shifted(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    return table[0][values & 0xFF] ^ table[1][values >> 8 & 0xFF] ^ table[2][values >> 16 & 0xFF] ^ table[3][values >> 24]


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the ranges, one range after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def _constants(sizes: np.ndarray) -> np.ndarray:
    """What the start value adds, by length."""
    out = _EMPTY[np.minimum(sizes, DEPTH)]
    for n in np.unique(sizes[sizes > DEPTH]).tolist():
        out[sizes == n] = zlib.crc32(bytes(n))
    return out


def _registers(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """XOR of the bytes' contributions of each span, which is not empty."""
    blocks = -(-sizes // DEPTH)
    behind = np.cumsum(sizes)
    left = np.repeat(behind, sizes) - 1 - np.arange(behind[-1])  # bytes that follow in the span
    values = _POSITIONS[(left % DEPTH) * 256 + data[ranges(starts, sizes)]]
    if blocks.max() == 1:
        return np.bitwise_xor.reduceat(values, behind - sizes)
    span = np.repeat(np.arange(len(sizes)), blocks)
    block = np.repeat(np.cumsum(blocks), blocks) - 1 - np.arange(len(span))  # counted from the span's end
    begins = np.repeat(behind, blocks) - np.minimum((block + 1) * DEPTH, np.repeat(sizes, blocks))
    values = np.bitwise_xor.reduceat(values, begins)
    shift = _BLOCK_SHIFT
    while len(values) > len(sizes):
        late = (block & 1) == 1
        values[late] = _shifted(values[late], shift)
        block >>= 1
        first = np.flatnonzero(np.append(True, (span[1:] != span[:-1]) | (block[1:] != block[:-1])))
        values, span, block = np.bitwise_xor.reduceat(values, first), span[first], block[first]
        shift = np.stack([_shifted(row, shift) for row in shift])
    return values


def crc32_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Unsigned CRC-32 of data[start:end] for each span; spans may overlap, and may be empty."""
    sizes = ends - starts
    out = _constants(sizes)
    filled = np.flatnonzero(sizes > 0)
    upto = np.cumsum(sizes[filled])
    a = 0
    while a < len(filled):
        done = upto[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(upto, done + SLICE, side="right")))
        part = filled[a:b]
        out[part] ^= _registers(data, starts[part], sizes[part])
        a = b
    return out
