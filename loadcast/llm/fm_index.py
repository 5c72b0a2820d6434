"""A compressed full-text index of word sequences: backward search over a wavelet matrix.

The texts of a shard are concatenated, each followed by its own separator.  The index keeps the
Burrows-Wheeler transform as packed bit vectors (one per bit of the word codes) with rank
counts, and the lengths of common prefixes of neighbouring suffixes, which give the interval of
a shortened match.  Searches run for many queries at once, one backward step per turn each.
"""

from __future__ import annotations

import numpy as np


class _Bits:
    """A packed bit vector with ranks."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int32)
        self.before = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype(np.int32)
        self.zeros = len(bits) - int(ones.sum())

    def ones_before(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class _Wavelet:
    """Occurrences of a code before a position, one packed bit vector per bit of the codes."""

    def __init__(self, codes: np.ndarray, size: int) -> None:
        self.shifts = list(range(max(1, int(size - 1).bit_length())))[::-1]
        self.levels = []
        for shift in self.shifts:
            bits = (codes >> shift) & 1
            self.levels.append(_Bits(bits.astype(np.uint8)))
            codes = np.concatenate([codes[bits == 0], codes[bits == 1]])
        every = np.arange(size)
        self.origin = self._down(every, np.zeros(size, np.int64))

    def _down(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, level in zip(self.shifts, self.levels, strict=True):
            ones = level.ones_before(at)
            at = np.where((codes >> shift) & 1, level.zeros + ones, at - ones)
        return at

    def rank(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self._down(codes, at) - self.origin[codes]


class FmIndex:
    """Index over ``texts`` (sequences of 64-bit word hashes); matches are capped at ``width``."""

    def __init__(self, texts: list[np.ndarray], width: int) -> None:
        self.width = width
        sizes = np.array([len(t) + 1 for t in texts])
        joined = np.concatenate([np.append(t, np.uint64(0)) for t in texts])
        ends = np.cumsum(sizes) - 1
        is_end = np.zeros(len(joined), bool)
        is_end[ends] = True
        self.alphabet, inner = np.unique(joined[~is_end], return_inverse=True)
        n = self.n = len(joined)
        self.owner = np.repeat(np.arange(len(texts)), sizes)
        # Separators are distinct and smaller than every word: no suffixes are equal.
        rank = np.empty(n, np.int64)
        rank[ends] = np.arange(len(ends))
        rank[~is_end] = inner + len(ends)
        code = np.zeros(n, np.int64)
        code[~is_end] = inner + 1
        ladder, step = [rank], 1
        while True:
            rank = self._doubled(rank, step)
            step *= 2
            if rank.max() == n - 1:
                break
            ladder.append(rank)
        order = np.argsort(rank)
        self.order = order
        bwt = code[order - 1]
        self.wavelet = _Wavelet(bwt, len(self.alphabet) + 1)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=len(self.alphabet) + 1))])
        self.common = self._common(order, ladder)
        heads = np.flatnonzero(self.common[:-1] < width)
        self.class_start = heads
        self.class_end = np.append(heads[1:], n)
        self.class_of = np.repeat(np.arange(len(heads)), self.class_end - heads)
        self._least = None

    @staticmethod
    def _doubled(rank: np.ndarray, step: int) -> np.ndarray:
        """Ranks by twice as many symbols."""
        n = len(rank)
        after = np.full(n, 0, np.int64)
        after[: max(0, n - step)] = rank[step:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key)
        fresh = np.empty(n, np.int64)
        ordered = key[order]
        fresh[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        return fresh

    def _common(self, order: np.ndarray, ladder: list[np.ndarray]) -> np.ndarray:
        """Length of the prefix each suffix shares with the one before; 0 at both ends."""
        n = len(order)
        a, b = order[:-1].copy(), order[1:].copy()
        found = np.zeros(n - 1, np.int64)
        for k in reversed(range(len(ladder))):
            inside = (a < n) & (b < n)
            same = np.zeros(n - 1, bool)
            same[inside] = ladder[k][a[inside]] == ladder[k][b[inside]]
            a, b, found = a + (same << k), b + (same << k), found + (same << k)
        return np.concatenate([[0], found, [0]])

    def codes(self, words: np.ndarray) -> np.ndarray:
        """Codes of word hashes, -1 for words that the index lacks."""
        if not len(self.alphabet):
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(self.alphabet, words), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == words, at + 1, -1)

    def _shorter(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
        """The smallest larger interval and its match length (the parent in the suffix tree)."""
        if self._least is None:
            table = [self.common]
            while 1 << len(table) <= len(self.common):
                last, half = table[-1], 1 << (len(table) - 1)
                table.append(np.minimum(last[:-half], last[half:]))
            self._least = table
        size = np.maximum(self.common[lo], self.common[hi])
        for k in reversed(range(len(self._least))):
            table = self._least[k]
            at = lo - (1 << k) + 1
            down = (at >= 1) & (table[np.maximum(at, 0)] >= size) & (size > 0)
            lo = np.where(down, at - 1, lo)
            up = (hi + (1 << k) <= self.n) & (table[np.minimum(hi, len(table) - 1)] >= size)
            hi = np.where(up & (size > 0), hi + (1 << k), hi)
        return np.where(size > 0, lo, 0), np.where(size > 0, hi, self.n), size

    def statistics(self, queries: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of the concatenated queries (sequences of word hashes).

        For each position: the length of the longest match that starts there (at most
        ``width``) and the interval ``[lo, hi)`` of the suffixes that begin with it.
        """
        sizes = np.array([len(q) for q in queries], np.int64)
        start = np.concatenate([[0], np.cumsum(sizes)])
        codes = self.codes(np.concatenate(queries) if queries else np.empty(0, np.uint64))
        length = np.zeros(len(codes), np.int64)
        low, high = np.zeros(len(codes), np.int64), np.full(len(codes), self.n)
        at = start[1:].copy()
        lo, hi = np.zeros(len(sizes), np.int64), np.full(len(sizes), self.n)
        size = np.zeros(len(sizes), np.int64)
        live = np.flatnonzero(at > start[:-1])
        while len(live):
            c = codes[at[live] - 1]
            known = np.maximum(c, 0)
            ends = np.concatenate([lo[live], hi[live]])
            to_lo, to_hi = (
                self.first[known] + self.wavelet.rank(np.tile(known, 2), ends).reshape(2, -1)
            )
            grown = (c > 0) & (to_lo < to_hi)
            g = live[grown]
            lo[g], hi[g], size[g] = to_lo[grown], to_hi[grown], size[g] + 1
            full = g[size[g] >= self.width]
            same = self.class_of[lo[full]]
            lo[full], hi[full], size[full] = self.class_start[same], self.class_end[same], self.width
            lost = live[~grown & (size[live] == 0)]
            moved = np.concatenate([g, lost])
            at[moved] -= 1
            length[at[moved]], low[at[moved]], high[at[moved]] = size[moved], lo[moved], hi[moved]
            cut = live[~grown & (size[live] > 0)]
            # A word that occurs nowhere ends every match.
            gone = cut[codes[at[cut] - 1] < 0]
            lo[gone], hi[gone], size[gone] = 0, self.n, 0
            rest = cut[codes[at[cut] - 1] >= 0]
            if len(rest):
                lo[rest], hi[rest], size[rest] = self._shorter(lo[rest], hi[rest])
            live = live[at[live] > start[live]]
        return length, low, high

    def least_owner(self, values: np.ndarray) -> np.ndarray:
        """Per class of suffixes with equal first ``width`` words, the smallest owner value."""
        return np.minimum.reduceat(values[self.owner[self.order]], self.class_start)
