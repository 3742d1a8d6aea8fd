"""Sets of word n-grams as sorted 64-bit hashes, and their MinHash bands."""
from __future__ import annotations

import hashlib
from math import comb

import numpy as np

from regulus.llm.words import Words, grams


def sets_of(words: Words, n: int) -> list[np.ndarray]:
    """The distinct n-grams of each document of a slice. Fewer than n words are one gram, no words none."""
    hashes = words.hashes()
    every = grams(hashes, n)
    out = []
    for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(every[a:b - n + 1]))
        elif b > a:
            out.append(grams(hashes[a:b], b - a) ^ np.uint64(b - a))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def set_id(grams_: np.ndarray) -> bytes:
    """A 128-bit name of a set."""
    return hashlib.blake2b(grams_.tobytes(), digest_size=16).digest()


class Banding:
    """``bands`` bands of ``rows`` MinHash values each. Two sets of similarity s share a band with chance 1 - (1 - s^rows)^bands."""

    def __init__(self, bands: int, rows: int) -> None:
        self.bands, self.rows = bands, rows
        random = np.random.default_rng(20)
        self.factor = random.integers(1, 1 << 63, bands * rows, dtype=np.uint64) | np.uint64(1)
        self.shift = random.integers(0, 1 << 63, bands * rows, dtype=np.uint64)
        self.mix = random.integers(1, 1 << 63, rows, dtype=np.uint64) | np.uint64(1)

    def recall(self, similarity: float) -> float:
        return 1 - (1 - similarity ** self.rows) ** self.bands

    def least_agreeing(self, similarity: float, loss: float = 1e-9) -> int:
        """The number of MinHash values that two sets of this similarity share, but for a chance of at most ``loss``."""
        n, below = self.bands * self.rows, 0.0
        for agreeing in range(n + 1):
            below += comb(n, agreeing) * similarity ** agreeing * (1 - similarity) ** (n - agreeing)
            if below > loss:
                return agreeing
        return n

    def of(self, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """A 64-bit hash of every band and a byte of every MinHash value, a row for each set; sets may not be empty."""
        if not sets:
            return np.zeros((0, self.bands), dtype=np.int64), np.zeros((0, self.bands * self.rows), dtype=np.uint8)
        joined = np.concatenate(sets)
        starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
        out = np.zeros((len(sets), self.bands), dtype=np.uint64)
        values = np.zeros((len(sets), self.bands * self.rows), dtype=np.uint8)
        scratch = np.empty_like(joined)
        for k in range(self.bands * self.rows):
            np.multiply(joined, self.factor[k], out=scratch)
            np.add(scratch, self.shift[k], out=scratch)
            least = np.minimum.reduceat(scratch, starts)
            band = k // self.rows
            values[:, k] = (least >> np.uint64(16)) & np.uint64(255)
            out[:, band] = (out[:, band] ^ (least >> np.uint64(7))) * self.mix[k % self.rows]
        return (out ^ (out >> np.uint64(29))).view(np.int64), values
