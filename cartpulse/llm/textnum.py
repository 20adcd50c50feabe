"""Vectorised word hashing for the tasks of Arrow-batched operators.

Texts are joined into one byte buffer, so that splitting and hashing run over
whole arrays instead of single words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

MULTIPLIER = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
INVERSE = pow(MULTIPLIER, -1, 1 << 64)
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2**64; kept for the usual sizes."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(n, base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if n <= 2 * CHUNK_BYTES:
            _POWERS[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``limit`` bytes together."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def range_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``codes[starts[i]:ends[i]]`` for every i, from running sums."""
    sums = np.empty(len(codes) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * _powers(MULTIPLIER, len(codes)),
              out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _powers(INVERSE, len(codes))[starts])


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words ``[^\\x20\\x09-\\x0D]+`` of the texts, in order, and
    bounds: words ``bounds[i]:bounds[i + 1]`` are those of text ``i``."""
    buf = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    inside = np.empty(len(buf) + 1, bool)
    inside[0] = False
    np.logical_not(_SPACE[buf], out=inside[1:])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    hashes = range_hashes(buf, starts, ends)
    offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    return hashes, np.searchsorted(starts, offsets)


def grams(codes: np.ndarray, orders: tuple[int, ...], buckets: int):
    """For each order n: (buckets of the n-grams ending at each position, mask).

    ``codes`` has 0 at word boundaries. An n-gram counts if its inner characters
    are letters; its ends may be the boundaries beside a word.
    """
    x = codes.astype(np.uint64)
    letter = codes != 0
    for n in orders:
        h = np.full(len(x), n, np.uint64)
        ok = letter.copy() if n == 1 else np.ones(len(x), bool)
        if n == 2:
            ok[1:] = letter[1:] | letter[:-1]
        for j in range(min(n, len(x))):
            past = np.zeros(len(x), np.uint64)
            past[j:] = x[:len(x) - j]
            h = (h ^ past) * np.uint64(0x100000001B3)
            if 0 < j < n - 1:
                ok[j:] &= letter[:len(x) - j]
        ok[:n - 1] = False
        yield (mix(h) >> np.uint64(20)).astype(np.int64) % buckets, ok


def runs(letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True; the array must end with False."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], letter]).astype(np.int8)))
    return edge[0::2], edge[1::2]
