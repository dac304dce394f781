"""Longest common extensions of a sequence by a suffix tree and its Euler tour."""

from __future__ import annotations

import numpy as np


def _grow(text: list[int], size: int) -> tuple[dict[int, int], list[int]]:
    """Ukkonen's tree of ``text``, whose last symbol occurs once, and its nodes' string depths.

    Edges are one map from ``node * size + first symbol`` to what is below: an inner node, or
    ``~suffix`` for the leaf of a suffix.  The active point is kept as its node and the number
    of symbols that are not yet leaves; the labels follow from any suffix through the node.
    """
    below: dict[int, int] = {}
    depth, passes, link = [0], [0], [0]
    node = rest = 0
    for i, symbol in enumerate(text):
        rest += 1
        pending = 0  # the inner node made last, whose suffix link is still to be set
        while rest:
            key = node * size + text[i - rest + 1 + depth[node]]
            child = below.get(key)
            if child is None:
                below[key] = ~(i - rest + 1)
                if pending:
                    link[pending] = node
                    pending = 0
            else:
                if child >= 0:
                    if depth[child] < rest:
                        node = child
                        continue
                    suffix = passes[child]
                else:
                    suffix = ~child
                other = text[suffix + rest - 1]
                if other == symbol:
                    if pending:
                        link[pending] = node
                    break
                inner = len(depth)
                depth.append(rest - 1)
                passes.append(suffix)
                link.append(0)
                below[key] = inner
                below[inner * size + other] = child
                below[inner * size + symbol] = ~(i - rest + 1)
                if pending:
                    link[pending] = inner
                pending = inner
            rest -= 1
            node = link[node]
    return below, depth


def _tour(text: list[int], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The leaves' suffixes as an Euler tour meets them, smaller symbols first, and for every
    leaf the string depth of the highest node passed since the leaf before."""
    below, depth = _grow(text, size)
    keys = np.fromiter(below.keys(), dtype=np.int64, count=len(below))
    order = np.argsort(-keys)
    children = np.fromiter(below.values(), dtype=np.int64, count=len(below))[order].tolist()
    ends = np.searchsorted(-keys[order], -np.arange(len(depth)) * size, "right").tolist()
    ends.append(0)
    del below, keys, order
    leaves, highest = [], []
    todo, passed = [0], [0]
    while todo:
        node, top = todo.pop(), passed.pop()
        if node < 0:
            leaves.append(~node)
            highest.append(top)
        else:
            # larger symbols first, so that the smallest is taken up next
            first, last = ends[node + 1], ends[node]
            todo += children[first:last]
            passed += [depth[node]] * (last - first - 1)
            passed.append(top)
    return np.array(leaves), np.array(highest, dtype=np.int32)


class Extensions:
    """How far two suffixes of a sequence of small non-negative numbers agree, in constant time.

    The lowest common ancestor of two leaves is the highest node between their visits in the
    Euler tour, so its depth is a range minimum, kept for all ranges of a power of two.
    """

    def __init__(self, symbols: np.ndarray):
        text = (symbols + 1).tolist()
        text.append(0)
        leaves, highest = _tour(text, int(symbols.max(initial=0)) + 2)
        #: The place of every suffix among all sorted ones; a prefix comes before what it starts.
        self.rank = np.empty(len(text), dtype=np.int64)
        self.rank[leaves] = np.arange(len(text))
        self._least = [highest]
        width = 1
        while 2 * width <= len(highest):
            low = self._least[-1]
            self._least.append(np.minimum(low[:-width], low[width:]))
            width *= 2

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the longest common prefixes of the suffixes at ``a`` and ``b``, ``a <> b``."""
        first, last = self.rank[a], self.rank[b]
        first, last = np.minimum(first, last) + 1, np.maximum(first, last)
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        out = np.empty(len(first), dtype=np.int64)
        for k in np.unique(level):
            here = np.flatnonzero(level == k)
            least = self._least[k]
            out[here] = np.minimum(least[first[here]], least[last[here] + 1 - (1 << int(k))])
        return out
