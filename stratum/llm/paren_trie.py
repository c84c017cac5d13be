"""Balanced-parentheses encoding of a trie: subtrees by findclose, everything about them by cumulative arrays.

A trie in preorder is a string of parentheses: one opens where a node is entered and closes where it is left. The excess
(open minus closed) at a place tells the depth, a node closes at the first later place where the excess falls below its
own, and the pair "()" is a leaf. ``findclose`` skips blocks whose least excess stays too high, on two levels. Counts over a
subtree are differences of arrays that are cumulative over the places.
"""

from __future__ import annotations

import numpy as np

BLOCK = 64


class Parentheses:
    def __init__(self, opening: np.ndarray):
        """``opening``: True at "(", False at ")", balanced."""
        self.opening = opening
        self.excess = np.cumsum(np.where(opening, 1, -1), dtype=np.int64)
        self.nodes = np.flatnonzero(opening)
        self._least = [self.excess]
        while len(self._least) < 3:
            below = self._least[-1]
            padded = np.full(-(-len(below) // BLOCK) * BLOCK, np.iinfo(np.int64).max)
            padded[:len(below)] = below
            self._least.append(padded.reshape(-1, BLOCK).min(axis=1) if len(below) else padded)

    def findclose(self) -> np.ndarray:
        """The closing place of each node, in preorder."""
        found = np.zeros(len(self.nodes), dtype=np.int64)
        wanted = self.excess[self.nodes] - 1
        at, level, open_ = self.nodes + 1, np.zeros(len(self.nodes), dtype=np.int64), np.arange(len(self.nodes))
        while len(open_):
            low = np.empty(len(open_), dtype=np.int64)
            for k, least in enumerate(self._least):
                here = level == k
                low[here] = least[at[here]]
            inside = low <= wanted  # the place is in this block, or here
            done = inside & (level == 0)
            found[open_[done]] = at[done]
            down, on = inside & (level > 0), ~inside
            at = np.where(down, at * BLOCK, np.where(on, at + 1, at))
            level = np.where(down, level - 1, level)
            up = on & (at % BLOCK == 0) & (level < len(self._least) - 1)
            at, level = np.where(up, at // BLOCK, at), np.where(up, level + 1, level)
            at, level, wanted, open_ = at[~done], level[~done], wanted[~done], open_[~done]
        return found

    def leaf_ranks(self) -> np.ndarray:
        """How many pairs "()" open before each place; one value more than places."""
        pairs = np.zeros(len(self.opening), dtype=np.int64)
        if len(pairs):
            pairs[:-1] = self.opening[:-1] & ~self.opening[1:]
        return self.cumulative(pairs)

    def over_places(self, of_nodes: np.ndarray) -> np.ndarray:
        """Values of nodes, in preorder, cumulative over the places."""
        values = np.zeros(len(self.opening), dtype=np.int64)
        values[self.nodes] = of_nodes
        return self.cumulative(values)

    @staticmethod
    def cumulative(values: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(values, dtype=np.int64)])
