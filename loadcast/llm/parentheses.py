"""Tries of sorted sequences as balanced parentheses with range min-max excess blocks.

A node is an opening parenthesis in preorder; its subtree ends at the closing one.  The excess (open
minus closed so far) falls by one below the node's own there for the first time.  ``findclose`` looks
for that place in the node's block, then climbs a tree of block minima to the first block that
reaches it, and looks into that block; all nodes are looked up together.
"""

from __future__ import annotations

import numpy as np

BLOCK = 64
_TOGETHER = 1 << 16
_HIGH = np.iinfo(np.int32).max


def encode(lengths: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Parentheses (True opens) of the trie of sorted distinct sequences.

    ``common[i]`` is the length of the prefix that sequence i shares with the one before (0 first).
    """
    n = len(lengths)
    runs = np.zeros(2 * n, np.int64)
    runs[0::2] = lengths - common
    runs[1:-1:2] = lengths[:-1] - common[1:]
    runs[0] += 1
    runs[-1] = lengths[-1] + 1
    return np.repeat(np.arange(2 * n) % 2 == 0, runs)


def _in_block(blocks: np.ndarray, row: np.ndarray, after: np.ndarray, goal: np.ndarray) -> np.ndarray:
    """First column behind ``after`` whose excess is at most ``goal``; -1 if there is none."""
    found = np.empty(len(row), np.int64)
    columns = np.arange(BLOCK)
    for low in range(0, len(row), _TOGETHER):
        part = slice(low, low + _TOGETHER)
        hit = (blocks[row[part]] <= goal[part, None]) & (columns > after[part, None])
        found[part] = np.where(hit.any(axis=1), hit.argmax(axis=1), -1)
    return found


def findclose(bits: np.ndarray) -> np.ndarray:
    """Place of the closing parenthesis of each opening one, in preorder."""
    excess = np.cumsum(np.where(bits, 1, -1), dtype=np.int32)
    count = 1 << max(0, (-(-len(bits) // BLOCK) - 1).bit_length())
    blocks = np.full(count * BLOCK, _HIGH, np.int32)
    blocks[: len(bits)] = excess
    blocks = blocks.reshape(count, BLOCK)
    levels = [blocks.min(axis=1)]
    while len(levels[-1]) > 1:
        levels.append(levels[-1].reshape(-1, 2).min(axis=1))

    opening = np.flatnonzero(bits)
    goal = excess[opening] - 1
    row, column = opening // BLOCK, opening % BLOCK
    close = _in_block(blocks, row, column, goal)
    close[close >= 0] += row[close >= 0] * BLOCK

    open_ = np.flatnonzero(close < 0)
    node, target = row[open_], goal[open_]
    at_level = np.full(len(open_), -1)
    for k, minima in enumerate(levels[:-1]):
        climbing = at_level < 0
        sibling = node + 1
        here = climbing & (node % 2 == 0)
        here[here] = minima[sibling[here]] <= target[here]
        at_level[here] = k
        node = np.where(here, sibling, np.where(climbing, node // 2, node))
    for k in range(len(levels) - 2, 0, -1):
        down = at_level == k
        left = 2 * node[down]
        node[down] = np.where(levels[k - 1][left] <= target[down], left, left + 1)
        at_level[down] = k - 1
    start = np.full(len(open_), -1)
    close[open_] = node * BLOCK + _in_block(blocks, node, start, target)
    return close


class Minima:
    """Minimum of any range of an array, from the minima of ranges of 2^k values."""

    def __init__(self, values: np.ndarray) -> None:
        self.tables = [values]
        while 2 << (len(self.tables) - 1) <= len(values):
            last, step = self.tables[-1], 1 << (len(self.tables) - 1)
            self.tables.append(np.minimum(last[:-step], last[step:]))

    def of(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Minima of the ranges low to high (exclusive; none is empty)."""
        out = np.empty(len(low), self.tables[0].dtype)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        for k in np.unique(level):
            own = level == k
            table = self.tables[k]
            out[own] = np.minimum(table[low[own]], table[high[own] - (1 << int(k))])
        return out


def parents(depth: np.ndarray) -> np.ndarray:
    """Preorder number of each node's parent from the depths in preorder; -1 for the root."""
    order = np.arange(len(depth))
    wide = np.int64(len(depth) + 1)
    keys = depth.astype(np.int64) * wide + order
    ranked = np.sort(keys)
    above = (depth.astype(np.int64) - 1) * wide + order
    place = np.searchsorted(ranked, above, side="right") - 1
    return np.where(depth == 0, -1, ranked[np.maximum(place, 0)] % wide)
