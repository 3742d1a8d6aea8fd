"""An FM-index over word sequences: a suffix array's Burrows-Wheeler transform in a wavelet matrix with rank counts.

Many patterns are searched side by side: a step extends every open pattern by one word to the left.
"""
from __future__ import annotations

import numpy as np


class Ranks:
    """Bits packed into 64-bit words with the number of ones before each word."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros((len(bits) // 64 + 1) * 64, dtype=np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first i bits."""
        word, bit = i >> 6, (i & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))


class FMIndex:
    """Over texts given as one array of symbols from 1; 0 ends every text and is never searched."""

    def __init__(self, symbols: np.ndarray) -> None:
        n = len(symbols)
        before = np.roll(symbols, 1)[suffix_array(symbols)] if n else symbols
        self.size = n
        kinds = int(symbols.max()) + 1 if n else 1
        counts = np.bincount(symbols, minlength=kinds)
        self.levels: list[tuple[int, int, Ranks]] = []
        place, values = np.zeros(kinds, dtype=np.int64), before
        kind = np.arange(kinds)
        for level in range(max(1, (kinds - 1).bit_length()) - 1, -1, -1):
            bits = (values >> level) & 1
            ranks, zeros = Ranks(bits), int(n - bits.sum())
            self.levels.append((level, zeros, ranks))
            ones = ranks.ones(place)
            place = np.where((kind >> level) & 1, zeros + ones, place - ones)
            values = np.concatenate([values[bits == 0], values[bits == 1]])
        # where a symbol's suffixes begin, less where its occurrences lie below the last level
        self.shift = np.cumsum(counts) - counts - place

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix intervals of each symbol put before the patterns with the intervals low to high."""
        k = len(symbol)
        both, own = np.concatenate([low, high]), np.concatenate([symbol, symbol])
        for level, zeros, ranks in self.levels:
            ones = ranks.ones(both)
            both = np.where((own >> level) & 1, zeros + ones, both - ones)
        both = both + self.shift[own]
        return both[:k], both[k:]


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling the sorted prefix. The zeros count as different symbols, in their order."""
    n = len(symbols)
    ends = symbols == 0
    rank = np.where(ends, np.cumsum(ends) - 1, symbols + int(ends.sum()))
    step = 1
    while True:
        following = np.zeros(n, dtype=np.int64)
        following[:n - step] = rank[step:] + 1 if step < n else 0
        key = rank * (int(rank.max()) + 2) + following
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(np.append(0, sorted_key[1:] != sorted_key[:-1]))
        if rank.max() == n - 1:
            return order
        step *= 2


def repeated_stretches(index: FMIndex, symbols: np.ndarray, begins: np.ndarray, ends: np.ndarray, least: int, probe: int = 4) -> np.ndarray:
    """(text, begin, end) of stretches of the texts begins to ends in which every run of ``least`` symbols occurs twice or more.

    Matching statistics from right to left: from an end the match grows to the left while it still has two occurrences. If it stops before
    f, no run that holds f and the end is repeated, so the next end is one further left; and if the few symbols from f on occur only
    once (the probe), no run that holds them is, and the next end is theirs.
    """
    found = []
    lane = np.flatnonzero(ends - begins >= least)
    begin, end = begins[lane].copy(), ends[lane].copy()
    at, stop, back = end.copy(), begin.copy(), np.full(len(lane), -1)  # back: the end that follows a probe
    low, high = np.zeros(len(lane), dtype=np.int64), np.full(len(lane), index.size)
    while len(lane):
        new_low, new_high = index.extend(symbols[at - 1], low, high)
        grows = new_high - new_low >= 2
        low, high, at = np.where(grows, new_low, low), np.where(grows, new_high, high), at - grows
        probing = back >= 0
        settled = ~grows | (at == stop)
        if not settled.any():
            continue
        # a match that has ended; f is the place it stopped at, at - 1
        main, probed = settled & ~probing, settled & probing
        long = main & (end - at >= least)
        if long.any():
            found.append(np.column_stack([lane[long], at[long], end[long]]))
        done, failed = main & grows, main & ~grows  # done: it reached the begin of its text
        following = np.minimum(end - 1, at - 1 + least)  # one further left, and no further from f than a run reaches
        probe_next = failed & (end - at + 1 > probe)
        end = np.where(probe_next, at - 1 + probe, np.where(failed, following, np.where(probed & grows, back, np.where(probed, stop + probe - 1, end))))
        back = np.where(probe_next, following, np.where(settled, -1, back))
        stop = np.where(probe_next, at - 1, np.where(settled, begin, stop))
        at = np.where(settled, end, at)
        low, high = np.where(settled, 0, low), np.where(settled, index.size, high)
        over = done | (settled & (np.maximum(end, back) - begin < least))
        if over.any():
            keep = ~over
            lane, begin, end, at, stop, back, low, high = (x[keep] for x in (lane, begin, end, at, stop, back, low, high))
    return np.concatenate(found) if found else np.zeros((0, 3), dtype=np.int64)
