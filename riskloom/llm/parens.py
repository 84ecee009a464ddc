"""A trie's shape as balanced parentheses, with least excesses of blocks and of a binary tree over them.

Node k is the k-th opening parenthesis. Its subtree ends at the closing one that is found by the excess
(opened less closed): the first later place whose excess is one less than at the opening. Blocks that do not
reach it are passed over by their least excess, many at once by the tree.
"""

from __future__ import annotations

import numpy as np

#: Parentheses in a block.
BLOCK = 128


class Parens:
    """Shape given by True for each opening parenthesis and False for each closing one; it must be balanced."""

    def __init__(self, opens: np.ndarray):
        self.opens = np.asarray(opens, bool)
        self.excess = np.cumsum(np.where(self.opens, 1, -1))
        if len(self.excess) and (self.excess[-1] or self.excess.min() < 0):
            raise ValueError("unbalanced")
        high = np.iinfo(np.int64).max
        blocks = -(-len(self.excess) // BLOCK)
        padded = np.full(blocks * BLOCK, high)
        padded[: len(self.excess)] = self.excess
        self.blocks = padded.reshape(blocks, BLOCK)
        #: levels[0] holds the least excess of each block, each further level that of pairs
        self.levels = [self.blocks.min(axis=1)] if blocks else []
        while self.levels and len(self.levels[-1]) > 1:
            low = self.levels[-1]
            if len(low) % 2:
                low = self.levels[-1] = np.append(low, high)
            self.levels.append(low.reshape(-1, 2).min(axis=1))
        pair = self.opens[:-1] & ~self.opens[1:]
        #: leaf pairs "()" whose opening is before each place
        self.leaf_rank = np.append(0, np.cumsum(np.append(pair, False))) if len(self.opens) else np.zeros(1, np.int64)

    def nodes(self) -> np.ndarray:
        """Places of the opening parentheses, in preorder."""
        return np.flatnonzero(self.opens)

    def _in_block(self, block: np.ndarray, start: np.ndarray, target: np.ndarray) -> np.ndarray:
        """First place from ``start`` (within each block) whose excess is at most the target; -1 if none."""
        out = np.full(len(block), -1)
        left, k = np.arange(len(block)), start.copy()
        while len(left):
            inside = k[left] < BLOCK
            left = left[inside]
            hit = self.blocks[block[left], k[left]] <= target[left]
            out[left[hit]] = block[left[hit]] * BLOCK + k[left[hit]]
            left = left[~hit]
            k[left] += 1
        return out

    def close(self, place: np.ndarray) -> np.ndarray:
        """The closing parenthesis of each opening one."""
        place = np.asarray(place, np.int64)
        target = self.excess[place] - 1
        block = place // BLOCK
        out = self._in_block(block, place % BLOCK + 1, target)
        todo = np.flatnonzero(out < 0)
        if len(todo):
            found = self._first_block(block[todo] + 1, target[todo])
            out[todo] = self._in_block(found, np.zeros(len(todo), np.int64), target[todo])
        return out

    def _first_block(self, at: np.ndarray, target: np.ndarray) -> np.ndarray:
        """The first block from ``at`` on that reaches the target; every opening parenthesis has one."""
        at, level = at.copy(), np.zeros(len(at), np.int64)
        stop = np.full(len(at), -1)  # level at which a tree node that reaches the target was found
        for h, low in enumerate(self.levels):  # upwards: this node, then its right neighbour, then their parents'
            for _ in range(2):
                here = np.flatnonzero((stop < 0) & (level == h) & (at < len(low)))
                reached = low[at[here]] <= target[here]
                stop[here[reached]] = h
                rest = here[~reached]
                odd = at[rest] % 2 == 1
                at[rest] += 1
                up = rest[odd]
                at[up] //= 2
                level[up] += 1
        for h in range(len(self.levels) - 1, 0, -1):  # downwards: the left child if it reaches the target
            here = np.flatnonzero(stop == h)
            at[here] *= 2
            at[here] += self.levels[h - 1][at[here]] > target[here]
            stop[here] = h - 1
        return at

    def leaves(self, place: np.ndarray, close: np.ndarray) -> np.ndarray:
        """Leaf pairs from each opening parenthesis to its closing one."""
        return self.leaf_rank[close] - self.leaf_rank[place]

    def totals(self, weight: np.ndarray, place: np.ndarray, close: np.ndarray) -> np.ndarray:
        """Sums of the nodes' weights (in preorder) over each subtree."""
        before = np.append(0, np.cumsum(self.opens))  # nodes opened before each place
        sums = np.append(0, np.cumsum(weight))
        return sums[before[close]] - sums[before[place]]
