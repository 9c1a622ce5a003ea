"""Counting quotient filters: lossless compact counters of 64-bit keys.

An invertible permutation spreads the keys evenly over 64 bits.  The upper
bits of a permuted key are its quotient, which is its place in the filter; the
others are its remainder, which is kept in full.  So a filter forgets nothing:
its keys come back through the inverse permutation.  Stored are the length of
each quotient's run, the sorted remainders in as few bytes as they need, and
counters of one byte, with an escape to eight.

Filters are sorted, so filters of shards merge as sorted runs do.  The first
bits of the quotient name the block: a filter is cut into blocks, and equal
blocks of all shards meet in one task.
"""

from __future__ import annotations

import numpy as np

from .common import ship

ship(__name__)

#: Odd multipliers of the permutation and their inverses modulo 2**64.
_MULTIPLIERS = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_INVERSES = tuple(pow(m, -1, 1 << 64) for m in _MULTIPLIERS)
#: One-byte counters from here on are escapes.
ESCAPE = 255


def permute(keys: np.ndarray) -> np.ndarray:
    """A bijection of the unsigned 64-bit numbers."""
    h = keys.astype(np.uint64)
    for m in _MULTIPLIERS:
        h ^= h >> np.uint64(32)
        h *= np.uint64(m)
    return h ^ (h >> np.uint64(32))


def restore(permuted: np.ndarray) -> np.ndarray:
    """The inverse of ``permute``."""
    h = permuted ^ (permuted >> np.uint64(32))
    for m in reversed(_INVERSES):
        h = h * np.uint64(m)
        h ^= h >> np.uint64(32)
    return h


def block_bounds(permuted: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The blocks that sorted permuted keys fall into, and the ends of each one's stretch (one more than blocks)."""
    if bits == 0:
        return np.zeros(min(1, len(permuted)), np.int64), np.unique([0, len(permuted)])
    of = (permuted >> np.uint64(64 - bits)).astype(np.int64)
    blocks, first = np.unique(of, return_index=True)
    return blocks, np.append(first, len(permuted))


def to_bytes(permuted: np.ndarray, counts: np.ndarray, bits: int) -> bytes:
    """The filter of sorted distinct permuted keys of one block (of 2**bits) and their counts."""
    n = len(permuted)
    q = max(1, int(n).bit_length())
    r = 64 - bits - q
    own = permuted & np.uint64(2 ** (64 - bits) - 1)
    runs = np.bincount((own >> np.uint64(r)).astype(np.int64), minlength=1 << q)
    wide = int(runs.max(initial=0) > 255)
    remainders = (own & np.uint64(2**r - 1)).astype("<u8").view(np.uint8).reshape(n, 8)[:, : -(-r // 8)]
    large = counts >= ESCAPE
    head = np.array([n, q, wide, int(large.sum())], "<i8")
    return b"".join([head.tobytes(), runs.astype("<u4" if wide else np.uint8).tobytes(), remainders.tobytes(), np.where(large, ESCAPE, counts).astype(np.uint8).tobytes(), counts[large].astype("<u8").tobytes()])


def from_bytes(data: bytes, block: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted permuted keys and counts of a filter."""
    n, q, wide, escaped = np.frombuffer(data, "<i8", 4).tolist()
    at, r = 32, 64 - bits - q
    runs = np.frombuffer(data, "<u4" if wide else np.uint8, 1 << q, at)
    at += runs.nbytes
    width = -(-r // 8)
    remainders = np.zeros((n, 8), np.uint8)
    remainders[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(n, width)
    at += n * width
    counts = np.frombuffer(data, np.uint8, n, at).astype(np.uint64)
    counts[counts == ESCAPE] = np.frombuffer(data, "<u8", escaped, at + n)
    permuted = np.repeat(np.arange(1 << q, dtype=np.uint64), runs) << np.uint64(r)
    permuted |= remainders.view("<u8").reshape(n)
    if bits:
        permuted |= np.uint64(block << (64 - bits))
    return permuted, counts


def merge(filters: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The filter of all: sorted runs merged, counters of equal keys added."""
    if len(filters) == 1:
        return filters[0]
    keys, counts = np.concatenate([k for k, _ in filters]), np.concatenate([c for _, c in filters])
    order = np.argsort(keys, kind="stable")  # merges the runs that are there
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts[order], first)


def block_bits(total_bytes: int, each: int, least: int = 5) -> int:
    """Bits of a block's number such that a block stands for at most ``each`` bytes of input."""
    return max(least, (max(1, -(-total_bytes // each)) - 1).bit_length())
