"""Suffix trees of number sequences, and longest common extensions answered from them.

A tree is built by Ukkonen's algorithm.  Of its Euler tour only the visits of leaves are kept, with
the least depth passed between one leaf and the next: the depth of the lowest common ancestor of
two leaves is the least of those between them, and a sparse table of minima gives it in constant
time.  Queries come as arrays and are answered together.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


class SuffixTree:
    """The tree of a sequence of numbers from 1 to `top`; 0 ends it."""

    def __init__(self, sequence: Sequence[int], top: int) -> None:
        self.text = [*sequence, 0]
        self.width = top + 1
        self._grow()
        self._sort()

    def _grow(self) -> None:
        """Ukkonen's algorithm; the leaf of suffix k is the k-th leaf made."""
        text, width = self.text, self.width
        total = len(text)
        begin, end, link = [0], [0], [0]
        edges: dict[int, int] = {}  # parent * width + first number of the edge -> child
        leaves: list[int] = []
        node = at = length = open_suffixes = 0
        for place, number in enumerate(text):
            waiting = 0  # the inner node made last, which still lacks its link
            open_suffixes += 1
            while open_suffixes:
                if length == 0:
                    at = place
                key = node * width + text[at]
                child = edges.get(key)
                if child is None:
                    leaves.append(len(begin))
                    edges[key] = len(begin)
                    begin.append(place)
                    end.append(total)
                    link.append(0)
                    if waiting:
                        link[waiting] = node
                        waiting = 0
                else:
                    first = begin[child]
                    size = min(end[child], place + 1) - first
                    if length >= size:
                        at += size
                        length -= size
                        node = child
                        continue
                    if text[first + length] == number:
                        if waiting:
                            link[waiting] = node
                        length += 1
                        break
                    inner = len(begin)
                    edges[key] = inner
                    begin.append(first)
                    end.append(first + length)
                    link.append(0)
                    leaves.append(len(begin))
                    edges[inner * width + number] = len(begin)
                    begin.append(place)
                    end.append(total)
                    link.append(0)
                    begin[child] = first + length
                    edges[inner * width + text[first + length]] = child
                    if waiting:
                        link[waiting] = inner
                    waiting = inner
                open_suffixes -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    at = place - open_suffixes + 1
        self.leaves = leaves
        self._sizes = np.asarray(end, np.int64) - np.asarray(begin, np.int64)
        self._keys = np.fromiter(edges.keys(), np.int64, len(edges))
        self._children = np.fromiter(edges.values(), np.int64, len(edges))

    def _tour(self, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in the order their leaves are visited, and the least depth between neighbours.

        `order` sorts the edges, those of one parent together.
        """
        nodes = len(self._sizes)
        children = self._children[order]
        parents = self._keys[order] // self.width
        starts = np.searchsorted(parents, np.arange(nodes + 1)).tolist()
        # reversed, so that taking from the end of the stack meets the first child first
        listed = children.tolist()
        sizes = self._sizes.tolist()
        suffix_of = dict(zip(self.leaves, range(len(self.leaves)), strict=True))
        suffixes: list[int] = []
        between: list[int] = []
        stack = [0]
        above = [0]  # depth of each stacked node's parent
        lowest = 0
        after_leaf = False
        while stack:
            child = stack.pop()
            depth = above.pop()
            if after_leaf:
                lowest = depth
                after_leaf = False
            suffix = suffix_of.get(child)
            if suffix is not None:
                suffixes.append(suffix)
                between.append(lowest)
                after_leaf = True
                continue
            depth += sizes[child]
            a, b = starts[child], starts[child + 1]
            stack.extend(listed[a:b][::-1])
            above.extend([depth] * (b - a))
        return np.array(suffixes, np.int64), np.array(between, np.int64)

    def _sort(self) -> None:
        suffixes, between = self._tour(np.argsort(self._keys))
        self.rank = np.empty(len(suffixes), np.int64)
        self.rank[suffixes] = np.arange(len(suffixes))
        table = [between.astype(np.int32)]
        step = 1
        while 2 * step <= len(between):
            table.append(np.minimum(table[-1][:-step], table[-1][step:]))
            step *= 2
        self._minima = table

    def reverse_rank(self) -> np.ndarray:
        """Ranks of the suffixes when larger numbers come first; a prefix still comes before the longer."""
        number = self._keys % self.width
        turned = self._keys - number + np.where(number == 0, 0, self.width - number)
        suffixes, _ = self._tour(np.argsort(turned))
        rank = np.empty(len(suffixes), np.int64)
        rank[suffixes] = np.arange(len(suffixes))
        return rank

    def common(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at two different places, pair by pair."""
        a, b = self.rank[left], self.rank[right]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b) + 1  # minima of [low, high)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        found = np.empty(len(low), np.int64)
        for k in np.unique(level).tolist():
            of = level == k
            row = self._minima[k]
            found[of] = np.minimum(row[low[of]], row[high[of] - (1 << k)])
        return found
