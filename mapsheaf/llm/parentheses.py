"""Balanced parentheses of a tree, with a range-minimum tree over blocks of excess."""

from __future__ import annotations

import numpy as np

BLOCK = 64


class Parentheses:
    """A forest in preorder: 1 opens a node, 0 closes it."""

    def __init__(self, runs: np.ndarray):
        """``runs``: lengths of runs of closing and opening parentheses in turn, closing ones first."""
        self.bits = np.repeat(np.arange(len(runs)) % 2 == 1, runs)
        self.excess = np.cumsum(np.where(self.bits, 1, -1))
        self.opens = np.flatnonzero(self.bits)
        # Nodes opened, and pairs "()" opened, before each position.
        self.rank = np.concatenate([[0], np.cumsum(self.bits)])
        self.pairs = np.concatenate([[0], np.cumsum(self.bits & ~np.append(self.bits[1:], True))])
        blocks = -(-len(self.bits) // BLOCK)
        padded = np.full(max(1, blocks) * BLOCK, len(self.bits) + 1)
        padded[:len(self.bits)] = self.excess
        self._padded = padded
        self._least = [padded.reshape(-1, BLOCK).min(axis=1)]
        while len(self._least[-1]) > 1:
            below = self._least[-1]
            self._least.append(np.minimum(below, np.append(below[1:], below[-1]))[::2])

    def _scan(self, start: np.ndarray, target: np.ndarray) -> np.ndarray:
        """First position from ``start`` on, in the block of ``start``, at the target excess; -1 if none."""
        found = np.full(len(start), -1)
        left, at = np.arange(len(start)), start.copy()
        while len(left):
            hit = self._padded[at] == target[left]
            found[left[hit]] = at[hit]
            on = ~hit & ((at + 1) % BLOCK != 0)
            left, at = left[on], at[on] + 1
        return found

    def find_close(self) -> np.ndarray:
        """The position that closes each node, in preorder."""
        target = self.excess[self.opens] - 1
        close = np.full(len(target), -1)
        near = np.flatnonzero((self.opens + 1) % BLOCK != 0)
        close[near] = self._scan(self.opens[near] + 1, target[near])
        rest = np.flatnonzero(close < 0)
        # Up to the first block to the right that reaches the target, then down to it.
        node, goal = self.opens[rest] // BLOCK, target[rest]
        level = np.full(len(rest), -1)
        for height, least in enumerate(self._least):
            right = np.minimum(node + 1, len(least) - 1)
            hit = (level < 0) & (node % 2 == 0) & (right > node) & (least[right] <= goal)
            level[hit] = height
            node = np.where(hit, right, np.where(level < 0, node // 2, node))
        for height in range(len(self._least) - 2, -1, -1):
            down = level > height
            child = node * 2
            least = self._least[height]
            node = np.where(down, child + (least[np.minimum(child, len(least) - 1)] > goal), node)
        close[rest] = self._scan(node * BLOCK, goal)
        return close
