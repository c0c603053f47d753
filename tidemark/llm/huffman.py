"""Canonical, length-limited Huffman codes over integer ids, with block checkpoints.

Bits are written from the highest to the lowest. A stream is cut into blocks of ``BLOCK`` ids; the bit offset of every
block is kept, so that blocks are decoded independently, here side by side.
"""

from __future__ import annotations

import numpy as np

BLOCK = 256


def limited_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Code lengths, at most ``limit``, with the least total size (package-merge); 0 for counts of 0."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n == 0:
        return out
    if n == 1:
        out[used] = 1
        return out
    if n > 1 << limit:
        raise ValueError(f"{n} symbols need codes longer than {limit} bits")
    order = used[np.lexsort((used, counts[used]))]
    leaves = counts[order].astype(np.float64)
    leaf_flags, level = [], leaves
    leaf_flags.append(np.ones(n, bool))
    for _ in range(limit - 1):
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([leaves, pairs])
        places = np.argsort(both, kind="stable")
        leaf_flags.append(places < n)
        level = both[places]
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for flags in reversed(leaf_flags):
        taken = int(flags[:take].sum())
        lengths[:taken] += 1
        take = 2 * (take - taken)
    out[order] = lengths
    return out


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes counted upwards in the order of (length, id)."""
    codes = np.zeros(len(lengths), np.uint64)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    if len(order):
        size = lengths[order].astype(np.int64)
        top = int(size.max())
        step = np.uint64(1) << (top - size).astype(np.uint64)
        start = np.concatenate([[np.uint64(0)], np.cumsum(step)[:-1]])
        codes[order] = start >> (top - size).astype(np.uint64)
    return codes


def pack(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bits of all ids, and the bit offset of every block."""
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    offsets = ends - size
    total = int(ends[-1]) if len(ends) else 0
    words = np.zeros(total // 64 + 2, np.uint64)
    if len(ids):
        code, word, inside = codes[ids], offsets >> 6, offsets & 63
        over = inside + size - 64
        whole = np.where(over <= 0, code << np.maximum(-over, 0).astype(np.uint64), code >> np.maximum(over, 0).astype(np.uint64))
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        words[word[first]] = np.bitwise_or.reduceat(whole, first)
        crossing = np.flatnonzero(over > 0)
        words[word[crossing] + 1] |= code[crossing] << (64 - over[crossing]).astype(np.uint64)
    return words.byteswap().tobytes()[: (total + 7) // 8], offsets[::BLOCK]


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For every value of the next ``top`` bits: the id and its length."""
    top = int(lengths.max()) if len(lengths) else 0
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    repeat = 1 << (top - lengths[order].astype(np.int64))
    ids, sizes = np.zeros(1 << top, np.uint32), np.zeros(1 << top, np.int64)
    filled = int(repeat.sum())
    ids[:filled], sizes[:filled] = np.repeat(order, repeat), np.repeat(lengths[order], repeat)
    return ids, sizes, top


def unpack(data: bytes, count: int, checkpoints: np.ndarray, table) -> np.ndarray:
    """The ids; every block is read from its own checkpoint, all blocks one id at a time side by side."""
    ids, sizes, top = table
    if not count:
        return np.zeros(0, np.uint32)
    raw = np.frombuffer(data + bytes(8), np.uint8).astype(np.uint32)
    ahead = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
    at = checkpoints.astype(np.int64)
    out = np.zeros((BLOCK, len(at)), np.uint32)
    last = count - (len(at) - 1) * BLOCK
    mask = (1 << top) - 1
    for k in range(min(BLOCK, count)):
        live = len(at) if k < last else len(at) - 1
        here = at[:live]
        key = ahead[here >> 3] >> (32 - top - (here & 7)).astype(np.uint32) & mask
        out[k, :live] = ids[key]
        at[:live] = here + sizes[key]
    return out.T.reshape(-1)[:count]
