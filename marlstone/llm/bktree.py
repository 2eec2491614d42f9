"""Burkhard-Keller trees over 64-bit fingerprints, many at once, as numpy arrays.

A tree keys the children of a node by their integer Hamming distance to it.
By the triangle inequality, whatever lies within r of a query at distance d
from the node hangs below edges d-r to d+r, and only those are followed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


class Forest:
    """One tree per distinct shard number. Fingerprints are uint64; equal ones in a shard are all kept (edge 0)."""

    def __init__(self, shard: np.ndarray, prints: np.ndarray):
        order = np.argsort(shard, kind="stable")
        self.order, self.prints = order, prints[order].astype(np.uint64)
        self.shard, first, self.sizes = np.unique(shard[order], return_index=True, return_counts=True)
        n = len(order)
        parent, edge = np.full(n, -1, np.int64), np.zeros(n, np.int64)
        left = np.arange(n)
        at = np.repeat(first, self.sizes) if n else np.zeros(0, np.int64)
        left, at = left[left != at], at[left != at]
        self.roots = first
        while len(left):
            d = np.bitwise_count(self.prints[left] ^ self.prints[at]).astype(np.int64)
            key = at * 65 + d
            _, pick, back = np.unique(key, return_index=True, return_inverse=True)
            child = left[pick]
            parent[child], edge[child] = at[pick], d[pick]
            stay = left != child[back]
            left, at = left[stay], child[back][stay]
        # children of a node, ordered by edge: positions from start[node] on in self.kids
        inner = np.flatnonzero(parent >= 0)
        keys = parent[inner] * 65 + edge[inner]
        by = np.argsort(keys, kind="stable")
        self.kids, self.keys = inner[by], keys[by]

    def within(self, radius: int, budget: int = 300_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (i, j) of input positions in one shard with a distance of at most radius, i<>j; both directions."""
        sizes = np.repeat(self.sizes, self.sizes)
        roots = np.repeat(self.roots, self.sizes)
        chunk = np.cumsum(sizes) // budget
        for c in np.unique(chunk):
            q = np.flatnonzero(chunk == c)
            node = roots[q]
            while len(q):
                d = np.bitwise_count(self.prints[q] ^ self.prints[node]).astype(np.int64)
                hit = (d <= radius) & (q != node)
                if hit.any():
                    yield self.order[q[hit]], self.order[node[hit]]
                lo = np.searchsorted(self.keys, node * 65 + np.maximum(d - radius, 0), "left")
                hi = np.searchsorted(self.keys, node * 65 + np.minimum(d + radius, 64), "right")
                many = hi - lo
                if not many.any():
                    break
                q = np.repeat(q, many)
                step = np.arange(len(q)) - np.repeat(np.cumsum(many) - many, many)
                node = self.kids[np.repeat(lo, many) + step]


def least_labels(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]], value: np.ndarray) -> np.ndarray:
    """For each of n items the smallest value among the items that pairs connect it to, itself included."""
    rank = np.argsort(np.argsort(value, kind="stable"), kind="stable")
    label, back = rank.copy(), np.sort(value, kind="stable")
    us, vs = [], []

    def settle() -> None:
        u, v = np.concatenate(us), np.concatenate(vs)
        while True:
            m = np.minimum(label[u], label[v])
            if (m == label[u]).all() and (m == label[v]).all():
                break
            np.minimum.at(label, u, m)
            np.minimum.at(label, v, m)
        # one link from each item to its least keeps what was joined so far
        owner = np.empty(n, np.int64)
        owner[rank] = np.arange(n)
        tied = np.flatnonzero(label != rank)
        us[:], vs[:] = [tied], [owner[label[tied]]]

    held = 0
    for u, v in pairs:
        us.append(u)
        vs.append(v)
        held += len(u)
        if held > 1_000_000:
            settle()
            held = 0
    if us:
        settle()
    return back[label]
