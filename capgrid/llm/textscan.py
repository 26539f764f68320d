"""Vectorised word spans and word hashes over a byte buffer (NumPy, one Arrow batch at a time).

A word's hash is a polynomial over its bytes modulo 2^64, taken from prefix
sums; callers that need exact answers compare the words themselves after a
hash has matched.
"""

from __future__ import annotations

import numpy as np

SLICE = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_tables: dict[str, np.ndarray] = {}


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Boolean table of 256 entries, true inside the given inclusive byte ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Words of lower-cased text: digits, a-z and every byte of a non-ASCII character.
ALNUM = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
#: Words between ASCII white space.
NONSPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))


def spans(buffer: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every maximal run of bytes of the class."""
    if not len(buffer):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    mask = table[buffer]
    edges = np.flatnonzero(mask[1:] != mask[:-1]) + 1
    if mask[0]:
        edges = np.concatenate(([0], edges))
    if mask[-1]:
        edges = np.concatenate((edges, [len(buffer)]))
    return edges[0::2], edges[1::2]


def _powers(kind: str, base: int, n: int) -> np.ndarray:
    have = _tables.get(kind)
    if have is None or len(have) < n:
        have = np.full(max(n, SLICE + 1), base, np.uint64)
        have[0] = 1
        have = np.cumprod(have)
        if n <= 4 * SLICE:  # tables for one giant word are not kept
            _tables[kind] = have
    return have


def word_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, a slice of the buffer at a time so memory stays bounded."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + SLICE, side="right")))
        piece = buffer[base : ends[j - 1]].astype(np.uint64)
        piece += np.uint64(1)
        up, down = _powers("up", _BASE, len(piece) + 1), _powers("down", _INVERSE, len(piece) + 1)
        piece *= up[: len(piece)]
        prefix = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(piece, out=prefix[1:])
        first, last = starts[i:j] - base, ends[i:j] - base
        h = (prefix[last] - prefix[first]) * down[first]
        h ^= h >> np.uint64(31)
        h *= _MIX
        h ^= h >> np.uint64(29)
        out[i:j] = h
        i = j
    return out
