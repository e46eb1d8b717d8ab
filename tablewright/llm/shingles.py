"""Word shingles as sorted 64-bit hashes, and what is computed from them in numpy."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

WORDS = 5
STEP = np.uint64(0x9E3779B97F4A7C15)
#: Groups up to this size are compared pair by pair, larger ones by matrix products.
FEW = 12
COLUMNS = 4096
#: Larger groups are compared range by range of the hashes, about so many shingles at once.
VALUES = 500_000


def text_key(words: list[bytes]) -> bytes:
    """128 bits that stand for a sequence of words."""
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def shingle_set(words: list[bytes], n: int = WORDS) -> np.ndarray:
    """Sorted hashes of the ``n``-word shingles; a shorter text is one shingle, none without words."""
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = min(n, len(words))
    m = len(words) - n + 1
    out = np.full(m, n, np.uint64)
    for j in range(n):
        out = out * STEP + h[j : j + m]
        out ^= out >> np.uint64(29)
    return np.unique(out)


class MinHash:
    """``trees`` times ``depth`` minima of the shingles under fixed mixing functions."""

    def __init__(self, trees: int, depth: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.trees, self.depth = trees, depth
        self.factors = rng.integers(0, 2**63, trees * depth, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.shifts = rng.integers(0, 2**63, trees * depth, dtype=np.uint64)

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        """Signature as (trees, depth) values of 32 bits."""
        out = np.empty(len(self.factors), np.uint64)
        for i in range(0, len(out), self.depth):
            s = slice(i, i + self.depth)
            out[s] = ((shingles[None, :] * self.factors[s, None] + self.shifts[s, None]) >> np.uint64(32)).min(axis=1)
        return out.reshape(self.trees, self.depth)


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of blocks of the shared values' incidences."""
    m = len(sets)
    out = np.zeros((m, m), np.int64)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    _, column, times = np.unique(values, return_inverse=True, return_counts=True)
    shared = times[column] > 1
    column, owner = column[shared], owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = np.unique(column[order], return_inverse=True)[1], owner[order]
    width = int(column[-1]) + 1 if len(column) else 0
    for at in range(0, width, COLUMNS):
        a, b = np.searchsorted(column, [at, at + COLUMNS])
        held = np.zeros((m, min(COLUMNS, width - at)), np.float32)
        held[owner[a:b], column[a:b] - at] = 1.0
        # Sums of at most COLUMNS ones are exact in single precision.
        out += (held @ held.T).astype(np.int64)
    return out


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections of sorted sets; the sizes of the sets on the diagonal.

    What is held beside the sets does not grow with their lengths.
    """
    m = len(sets)
    out = np.zeros((m, m), np.int64)
    if m <= FEW:
        for i in range(m):
            for j in range(i):
                out[i, j] = out[j, i] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
    else:
        ranges = -(-sum(map(len, sets)) // VALUES) or 1
        edges = np.array([2**64 * i // ranges for i in range(1, ranges)], np.uint64)
        cuts = [[0, *np.searchsorted(s, edges), len(s)] for s in sets]
        for i in range(ranges):
            out += _common([s[c[i] : c[i + 1]] for s, c in zip(sets, cuts)])
    np.fill_diagonal(out, [len(s) for s in sets])
    return out


def spanning(linked: np.ndarray) -> list[tuple[int, int]]:
    """For a symmetric boolean matrix: (first, other) for the others of each component."""
    free = linked.any(axis=1)
    pairs = []
    for i in range(len(linked)):
        if not free[i]:
            continue
        free[i] = False
        front = np.array([i])
        while len(front):
            front = np.flatnonzero(linked[front].any(axis=0) & free)
            free[front] = False
            pairs += [(i, int(j)) for j in front]
    return pairs
