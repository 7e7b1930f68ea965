"""Word-shingle sets and minhashes, vectorised over many texts."""

from __future__ import annotations

import numpy as np

from .common import LOWER, SPACES, mix, word_hashes, word_spans

_RNG = np.random.default_rng(77003)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def shingle_hashes(data: np.ndarray, bounds: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the `words`-word shingles of the texts between the bounds, A-Z in lower case, and each text's first place.

    A text with fewer words has its whole sequence as one shingle; one without words has none.
    """
    rows = len(bounds) - 1
    data = LOWER[data]
    starts, ends = word_spans(data, bounds, SPACES)
    hashes = word_hashes(data, starts, ends)
    first = np.searchsorted(starts, bounds)
    counts = np.diff(first)
    n = len(hashes)
    joined = hashes * _A
    for k in range(1, words):
        joined = mix(joined[: n - k] + hashes[k:] * _B) * _A if n > k else joined[:0]
    keep = np.maximum(counts - words + 1, 0)
    where = np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(keep)[:-1]]), keep) + np.arange(int(keep.sum()))
    out, sizes = joined[where], keep
    short = np.flatnonzero((counts > 0) & (counts < words))
    if len(short):
        sizes = keep.copy()
        sizes[short] = 1
        extra = []
        for r in short:
            h = np.uint64(counts[r])
            for x in hashes[first[r] : first[r + 1]]:
                h = mix(np.array([(int(h) * int(_A) + int(x) * int(_B)) & (2**64 - 1)], np.uint64))[0]
            extra.append(h)
        out = np.insert(out, np.concatenate([[0], np.cumsum(keep)])[short], np.array(extra, np.uint64))
    at = np.zeros(rows + 1, np.int64)
    np.cumsum(sizes, out=at[1:])
    return out, at


def shingle_sets(data: np.ndarray, bounds: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, sorted, and each text's first place."""
    hashes, at = shingle_hashes(data, bounds, words)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    return hashes[fresh], np.searchsorted(row[fresh], np.arange(len(at)))


class MinHashes:
    """`count` minhashes of each set; empty sets get zeros."""

    def __init__(self, count: int, seed: int = 77003):
        rng = np.random.default_rng(seed)
        self.flip = rng.integers(0, 2**63, count, dtype=np.uint64)
        self.factor = rng.integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def of(self, sets: np.ndarray, at: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.flip), len(at) - 1), np.uint64)
        some = np.flatnonzero(np.diff(at))
        if len(some):
            for k in range(len(self.flip)):
                out[k, some] = np.minimum.reduceat((sets ^ self.flip[k]) * self.factor[k], at[some])
        return out


def tensor_halves(minhashes: np.ndarray, per_half: int) -> np.ndarray:
    """Half keys of `per_half` minhashes each: (texts, halves)."""
    count, n = minhashes.shape
    halves = np.zeros((count // per_half, n), np.uint64)
    for j in range(count // per_half):
        h = np.full(n, j + 1, np.uint64)
        for row in minhashes[j * per_half : (j + 1) * per_half]:
            h = mix(h * _A + row)
        halves[j] = h
    return halves.T
