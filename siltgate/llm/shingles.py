"""Word shingles, their MinHash signatures, and Bayesian pruning of candidate pairs."""

from __future__ import annotations

import math

import numpy as np

from siltgate.llm.common import WordHasher, mix64

_SEED = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(
    texts: list[str | None], width: int = 4, hasher: WordHasher | None = None
) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles of each whole text.

    A text with fewer words is one shingle of all its words; without words, none.
    """
    hashes, _, counts = (hasher or WordHasher())(texts)
    sets, at = [], 0
    for n in counts.tolist():
        h = hashes[at : at + n]
        at += n
        if not n:
            sets.append(h)
            continue
        size = min(width, n)
        # Order matters and so does the size: (((w1 * m + w2) * m + w3) * m + w4), mixed.
        s = np.full(n - size + 1, size, dtype=np.uint64)
        for k in range(size):
            s = mix64(s * _SEED + h[k : k + len(s)])
        sets.append(np.unique(s))
    return sets


def multipliers(hashes: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(4)
    a = draw.integers(0, 2**32, hashes, dtype=np.uint32) | np.uint32(1)
    b = draw.integers(0, 2**32, hashes, dtype=np.uint32)
    return a, b


def signature(
    shingles: np.ndarray, drawn: tuple[np.ndarray, np.ndarray], block: int = 1024
) -> np.ndarray:
    """Smallest value of each hash function over a set (uint32); all ones for none.

    A function multiplies and adds in 32 bits on one half of the shingle's hash and adds
    the other half, rotated: cheap, and independent enough across functions.
    """
    a, b = drawn
    out = np.full(len(a), 0xFFFFFFFF, dtype=np.uint32)
    low = (shingles & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    high = (shingles >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(low), block):
        x = low[start : start + block, None] * a
        x ^= x >> np.uint32(15)
        x += high[start : start + block, None] * b
        np.minimum(out, x.min(axis=0), out=out)
    return out


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` hashes, for a matrix of signatures."""
    n, hashes = signatures.shape
    bands = signatures.reshape(n, hashes // rows, rows).astype(np.uint64)
    keys = np.broadcast_to(np.arange(hashes // rows, dtype=np.uint64), bands.shape[:2]).copy()
    for k in range(rows):
        keys = mix64(keys * _SEED + bands[:, :, k])
    return keys.view(np.int64)


def prune_limits(
    threshold: float, miss: float, batch: int = 16, hashes: int = 128
) -> list[tuple[int, int]]:
    """``(n, m)`` for each batch: after ``n`` hashes, drop a pair with fewer than ``m`` equal.

    With a uniform prior the similarity of a pair with ``m`` of ``n`` equal hashes follows
    Beta(m + 1, n - m + 1).  A pair is dropped once the probability that its similarity
    reaches ``threshold`` is below ``miss``.
    """
    return [
        (n, next(m for m in range(n + 2) if m > n or _above(threshold, m, n) >= miss))
        for n in range(batch, hashes + 1, batch)
    ]


def _above(t: float, m: int, n: int) -> float:
    """P(similarity >= t): a Beta tail with whole parameters is a binomial sum."""
    return sum(math.comb(n + 1, k) * t**k * (1 - t) ** (n + 1 - k) for k in range(m + 1))


def survivors(
    left: np.ndarray, right: np.ndarray, limits: list[tuple[int, int]]
) -> tuple[np.ndarray, np.ndarray]:
    """Which aligned pairs of signatures pass every batch, and their equal hashes."""
    alive = np.arange(len(left))
    equal = np.zeros(len(left), dtype=np.int32)
    before = 0
    for n, least in limits:
        equal[alive] += (left[alive, before:n] == right[alive, before:n]).sum(axis=1)
        alive = alive[equal[alive] >= least]
        before = n
    return alive, equal


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """``100 * |A & B| >= percent * |A | B|`` on sorted sets; empty sets are like nothing."""
    if not len(a) or not len(b):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)
