"""Sets of word shingles and their min-hash signatures, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

WORDS = 2
BLOCK = 2048
_MIX = np.uint64(0x9E3779B97F4A7C15)
_LINK = np.uint64(0xC2B2AE3D27D4EB4F)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct two-word shingles of a text; fewer words make one
    shingle, no word none. A-Z are lower-cased, words end at ASCII white space."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(words[0], 1)], np.uint64)
    each = xxhash.xxh3_64_intdigest
    hashed = np.fromiter(map(each, words), np.uint64, len(words))
    pairs = hashed[:-1] * _MIX + (hashed[1:] ^ (hashed[1:] >> np.uint64(32))) * _LINK
    pairs ^= pairs >> np.uint64(29)
    pairs = np.sort(pairs * _MIX)
    return pairs[np.append(True, pairs[1:] != pairs[:-1])]


class MinHash:
    """`count` min-hashes of a set. An element's two halves are multiplied by odd factors and added;
    the least sum counts."""

    def __init__(self, count: int, seed: int = 7):
        draws = np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 32, (2, count, 1), np.uint64)
        self.low, self.high = draws.astype(np.uint32) | np.uint32(1)

    def signature(self, elements: np.ndarray) -> np.ndarray:
        least = np.full(len(self.low), 0xFFFFFFFF, np.uint32)
        for at in range(0, len(elements), BLOCK):
            part = elements[at: at + BLOCK]
            sums = part.astype(np.uint32) * self.low
            sums += (part >> np.uint64(32)).astype(np.uint32) * self.high
            np.minimum(least, sums.min(axis=1), out=least)
        return least
