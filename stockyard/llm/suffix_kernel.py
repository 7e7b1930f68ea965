"""Vectorised digits of byte suffixes: k-gram hashes, window minima and window hashes over a run of texts."""

from __future__ import annotations

import numpy as np

from .common import mix

#: Bytes of the first digit.
GRAM = 32
_A, _B, _C = (np.uint64(x) for x in (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """The 64-bit hash of the GRAM bytes at each place."""
    n = len(data) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    x = np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data), strides=(1,)) * _A
    x ^= x >> np.uint64(32)
    x = x[: n + 16] * _B + x[8 : n + 24]
    x ^= x >> np.uint64(29)
    x = x[:n] * _C + x[16 : n + 16]
    return mix(x)


def window_hashes(grams: np.ndarray, at: np.ndarray, threshold: int) -> np.ndarray:
    """The hash of the `threshold` bytes at each of the places, from overlapping grams."""
    out = grams[at]
    if threshold < GRAM:
        raise ValueError(f"a string of {threshold} bytes is shorter than the first digit")
    for step in [*range(GRAM, threshold - GRAM, GRAM), threshold - GRAM]:
        out = mix(out * _A + grams[at + step])
    return out


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    step = 1
    while 2 * step <= width:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    return np.minimum(x[: len(x) - (width - step)], x[width - step :]) if width > step else x


def anchors(data: np.ndarray, bounds: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The first digit of each window of `threshold` bytes that lies in one text, as the leftmost least gram in it.

    bounds: starts of the texts and the end of the last. Returns the gram hashes at all places, and for each run of
    windows with the same least gram its first and last window start and the gram's place.
    """
    empty = np.zeros(0, np.int64)
    grams = gram_hashes(data)
    if len(data) < threshold:
        return grams, empty, empty, empty
    bits = np.uint64(max(21, int(len(data)).bit_length()))
    keys = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
    least = (sliding_min(keys, threshold - GRAM + 1) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    # No window starts in the last threshold - 1 bytes of a text.
    change = np.zeros(len(data) + 1, np.int32)
    np.add.at(change, np.maximum(bounds[1:] - threshold + 1, bounds[:-1]), 1)
    np.add.at(change, bounds[1:], -1)
    ok = np.cumsum(change)[: len(least)] == 0
    starts = np.flatnonzero(ok)
    if not len(starts):
        return grams, empty, empty, empty
    chosen = least[starts]
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (chosen[1:] != chosen[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(starts)) - 1
    return grams, starts[first], starts[last], chosen[first]
