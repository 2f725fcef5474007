"""Words of whole Arrow text columns, found and hashed with numpy on the UTF-8 bytes."""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa

#: Bytes hashed at a time: bounds the memory of the hash (24 bytes for each).
BLOCK = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def byte_table(ranges: list[tuple[int, int, int]]) -> np.ndarray:
    """256 classes from (first byte, last byte, class); 0 elsewhere."""
    out = np.zeros(256, np.uint8)
    for first, last, kind in ranges:
        out[first : last + 1] = kind
    return out


#: Everything but blanks and control characters 9 to 13.
NOT_SPACE = byte_table([(0, 255, 1), (0x20, 0x20, 0), (0x09, 0x0D, 0)])
#: Digits, letters and everything beyond ASCII.
WORD = byte_table([(0x30, 0x39, 1), (0x41, 0x5A, 1), (0x61, 0x7A, 1), (0x80, 0xFF, 1)])
#: Words (1) and runs of other visible characters (2).
WORD_OR_SIGN = np.where(WORD == 1, 1, np.where(NOT_SPACE == 1, 2, 0)).astype(np.uint8)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offset of each row, without a copy; nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z."""
    return _LOWER[data]


def spans(data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each maximal run of one class (class 0 separates)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    kind = kinds[data]
    edge = np.empty(len(data) + 1, bool)
    edge[0] = edge[-1] = True
    np.not_equal(kind[1:], kind[:-1], out=edge[1:-1])
    edge[offsets] = True
    cut = np.flatnonzero(edge)
    inside = kind[cut[:-1]] != 0
    starts, ends = cut[:-1][inside], cut[1:][inside]
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    up, down = np.full(size, _BASE), np.full(size, inverse)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes; spans are in order and equal bytes give equal hashes."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK, "right")))
        a, b = int(starts[i]), int(ends[j - 1])
        need = max(BLOCK, 1 << (b - a).bit_length()) + 1
        up, down = _powers(need)
        total = np.zeros(b - a + 1, np.uint64)
        np.cumsum((data[a:b].astype(np.uint64) + np.uint64(1)) * up[: b - a], out=total[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        h = (total[e] - total[s]) * down[s]
        h ^= h >> np.uint64(29)
        h *= _MIX
        h ^= h >> np.uint64(32)
        out[i:j] = h
        i = j
    return out


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One hash of two, order included."""
    h = a * _BASE + (b ^ (b >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(32))
