"""Numpy helpers over the UTF-8 bytes of Arrow text columns.

Texts are handled in slices of about ``SLICE_BYTES`` bytes, so that the arrays made for one slice stay small however
many rows an Arrow batch has; a longer text is a slice of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

#: White space that separates words: tab to carriage return, and space.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_TABLE = np.random.Generator(np.random.PCG64(20240501)).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_POWERS = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seed(k: int) -> np.uint64:
    """The k-th of a fixed series of 64-bit constants."""
    return mix(np.array([(k + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF], np.uint64))[0]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the rolling hash's base, and of its inverse modulo 2**64."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(n, SLICE_BYTES + 4096)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """H[i] for the first i bytes; ``(H[e] - H[s]) * down[s]`` depends on the bytes from s to e only."""
    out = np.zeros(len(data) + 1, np.uint64)
    terms = _TABLE.take(data)
    terms *= powers(len(data))[0]
    np.cumsum(terms, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes between starts and ends."""
    down = powers(len(prefix))[1]
    return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def text_slices(column: pa.Array, limit: int = SLICE_BYTES):
    """(first row, last row + 1, bytes, offsets) of slices of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, where, what = column.buffers()
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(what, np.uint8) if what is not None and what.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        stop = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        stop = min(max(stop, row + 1), row + 4096, len(column))
        yield row, stop, data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        row = stop


def word_spans(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SPACE):
    """Starts, ends and rows of the words between separators; words end with their text."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = (data - np.uint8(0x09) >= 5) & (data != 0x20) if separator is SPACE else ~separator[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | first[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(offsets, starts, "right") - 1


def window_hash(words: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n consecutive words of one row, and the index of their first word."""
    if len(words) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    count = len(words) - n + 1
    total = words[:count].copy()
    for k in range(1, n):
        total = total * np.uint64(0xD6E8FEB86659FD93) + words[k : k + count]
    whole = np.flatnonzero(rows[:count] == rows[n - 1 :])
    return mix(total[whole]), whole
