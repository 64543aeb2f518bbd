"""Hashes of the words of many texts at once, on arrays."""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finisher of SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(n: int, start: int) -> np.ndarray:
    """n odd 64-bit numbers, the same everywhere."""
    return mix(np.arange(start, start + n, dtype=np.uint64) * BASE) | np.uint64(1)


def word_hashes(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, and the number of words of each text.

    Words are runs of bytes other than ASCII white space, lower-cased in A-Z on request.  The hash of a word is a
    polynomial of its bytes, read off running sums.
    """
    joined = b" ".join(texts) + b" "
    data = np.frombuffer(joined.lower() if lower else joined, dtype=np.uint8)
    inside = np.concatenate([[False], ~SPACE[data]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    powers = np.full(data.size, BASE, dtype=np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers)])
    powers[:] = INVERSE
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    hashes = mix((sums[ends] - sums[starts]) * powers[starts] + (ends - starts).astype(np.uint64))
    limits = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.diff(np.searchsorted(starts, limits), prepend=0)


def slices(sizes: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Ranges of rows of about ``limit`` in size each, one row at least."""
    out, start, sum_ = [], 0, 0
    for i, size in enumerate(sizes.tolist()):
        sum_ += size
        if sum_ >= limit:
            out.append((start, i + 1))
            start, sum_ = i + 1, 0
    if start < len(sizes):
        out.append((start, len(sizes)))
    return out
