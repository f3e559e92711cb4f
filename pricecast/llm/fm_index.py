"""FM-index over sequences of words: suffix order, wavelet matrix of the transform, backward search in step.

Many short sequences share one index. Every sequence ends in a separator of its own, so no two suffixes are equal and
the order is settled after as many doublings as the longest sequence needs.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """Bit vector with rank: one count of set bits for every word of 64."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) + 64) // 64 * 64, dtype=np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.zeros(len(self.words) + 1, dtype=np.int32)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Set bits before every given place."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Ranks of any symbol, a level a bit of the symbols."""

    def __init__(self, symbols: np.ndarray, depth: int):
        self.depth, self.levels, self.zeros = depth, [], []
        for b in range(depth - 1, -1, -1):
            bit = ((symbols >> b) & 1).astype(bool)
            self.levels.append(Bits(bit))
            self.zeros.append(int(len(bit) - bit.sum()))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])

    def follow(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Place of ``at`` in the last level along the symbol; differences of two such places are ranks."""
        for k, (bits, zeros) in enumerate(zip(self.levels, self.zeros)):
            ones = bits.rank(at)
            at = np.where((symbol >> (self.depth - 1 - k)) & 1, zeros + ones, at - ones)
        return at


def suffix_order(text: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Order of all suffixes, and each suffix's class by its first ``known`` symbols (known <= keep, a power of 2)."""
    n = len(text)
    _, rank = np.unique(text, return_inverse=True)
    rank = rank.astype(np.int64)
    kept, known, k = rank, 1, 1
    while True:
        second = np.zeros(n, dtype=np.int64)
        second[: max(0, n - k)] = rank[k:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        step = np.zeros(n, dtype=np.int64)
        step[1:] = np.cumsum(ordered[1:] != ordered[:-1])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = step
        k *= 2
        if k <= keep:
            kept, known = rank, k
        if step[-1] == n - 1 and k >= keep:
            return order, kept, known


class FMIndex:
    """Index of sequences of words; ``window`` is the length whose matches are told apart."""

    def __init__(self, sequences: list[list[bytes]], window: int):
        m = len(sequences)
        number: dict[bytes, int] = {}
        for s in sequences:
            for w in s:
                number.setdefault(w, m + len(number))
        self.codes = [np.fromiter((number[w] for w in s), dtype=np.int64, count=len(s)) for s in sequences]
        self.text = np.concatenate([np.append(c, i) for i, c in enumerate(self.codes)])
        self.owner = np.repeat(np.arange(m), [len(c) + 1 for c in self.codes])
        n = len(self.text)
        keep = 1 << (window.bit_length() - 1)
        self.order, ranks, known = suffix_order(self.text, keep)
        last = self.text[self.order - 1]  # the transform; the text counts as a ring
        depth = max(1, int(self.text.max()).bit_length())
        self.wavelet = WaveletMatrix(last, depth)
        counts = np.bincount(self.text, minlength=m + len(number) + 1)
        self.smaller = np.cumsum(counts) - counts
        self.base = self.wavelet.follow(np.arange(len(counts)), np.zeros(len(counts), dtype=np.int64))
        padded = np.append(ranks, np.full(window, -1))
        a, b = padded[self.order], padded[self.order + window - known]
        fresh = np.ones(n, dtype=bool)
        fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        self.starts = np.flatnonzero(fresh)
        self.group = np.cumsum(fresh) - 1  # of a place in the suffix order: its class by the first ``window`` symbols

    def least(self, value: np.ndarray) -> np.ndarray:
        """Least value, given by sequence, in every class of windows."""
        return np.minimum.reduceat(value[self.owner[self.order]], self.starts)

    def classes(self, window: int) -> list[np.ndarray]:
        """Class of every window of every indexed sequence, found by backward search of all sequences in step.

        Each sequence is streamed from its last word to its first; the interval of the suffix order that holds all
        matches of what was read names the class once a whole window has been read.
        """
        sizes = np.array([len(c) for c in self.codes])
        ends = np.cumsum(sizes + 1) - 1
        found = [np.zeros(max(0, s - window + 1), dtype=np.int64) for s in sizes]
        low, high = np.zeros(len(sizes), dtype=np.int64), np.full(len(sizes), len(self.text), dtype=np.int64)
        live = np.arange(len(sizes))
        for step in range(1, int(sizes.max(initial=0)) + 1):
            live = live[sizes[live] >= step]
            symbol = self.text[ends[live] - step]
            start = self.smaller[symbol] - self.base[symbol]
            low[live] = start + self.wavelet.follow(symbol, low[live])
            high[live] = start + self.wavelet.follow(symbol, high[live])
            if step >= window:
                group = self.group[low[live]]
                for i, g in zip(live.tolist(), group.tolist()):
                    found[i][sizes[i] - step] = g
        if (low >= high).any():
            raise AssertionError("an indexed sequence was not found")
        return found
