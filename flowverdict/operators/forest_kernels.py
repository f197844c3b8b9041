"""Numpy work done inside one task: grow one tree, walk packed trees."""

from __future__ import annotations

import hashlib
import math

import numpy as np


def uniform(seed: int, *tags) -> float:
    """Same draw as ``flowverdict.functions.draws.uniform``."""
    text = ":".join(str(t) for t in (seed, *tags))
    return int(hashlib.md5(text.encode()).hexdigest()[:13], 16) / 2**52


def mean_path(n):
    """Expected path length of an unsuccessful search among ``n`` rows."""
    n = np.asarray(n, dtype=np.float64)
    m = np.maximum(n, 3.0)
    general = 2.0 * (np.log(m - 1.0) + np.euler_gamma) - 2.0 * (m - 1.0) / m
    return np.where(n >= 3, general, np.where(n == 2, 1.0, 0.0))


def depth_limit(sample_rows: int) -> int:
    return math.ceil(math.log2(max(sample_rows, 2)))


def grow_tree(rows: np.ndarray, tree: int, seed: int, limit: int) -> list[tuple]:
    """Nodes (tree, node, depth, feature, threshold, n_rows) in heap numbering: the root is
    1, node k splits into 2k (value <= threshold) and 2k+1.  A leaf has feature -1."""
    nodes = []
    open_nodes = [(1, 0, rows.astype(np.float64))]
    while open_nodes:
        node, depth, part = open_nodes.pop()
        low, high = part.min(axis=0), part.max(axis=0)
        usable = np.flatnonzero(low < high)
        if depth >= limit or len(part) < 2 or len(usable) == 0:
            nodes.append((tree, node, depth, -1, 0.0, len(part)))
            continue
        feature = int(usable[int(uniform(seed, "feature", tree, node) * len(usable))])
        lo, hi = float(low[feature]), float(high[feature])
        cut = lo + uniform(seed, "cut", tree, node) * (hi - lo)
        if cut >= hi:
            cut = lo
        nodes.append((tree, node, depth, feature, cut, len(part)))
        left = part[:, feature] <= cut
        open_nodes.append((2 * node, depth + 1, part[left]))
        open_nodes.append((2 * node + 1, depth + 1, part[~left]))
    return nodes


class PackedForest:
    """All trees as full heaps of equal depth, so that every row takes the same number of
    steps.  Below a leaf the path leads left (threshold = infinity) to a bottom slot that
    holds the leaf's path length."""

    def __init__(self, tree, node, depth, feature, threshold, n_rows, n_trees: int):
        tree, node, depth = (np.asarray(a, dtype=np.int64) for a in (tree, node, depth))
        feature = np.asarray(feature, dtype=np.int64)
        self.levels = int(depth.max())
        self.n_trees = n_trees
        width = 1 << self.levels
        self.feature = np.zeros((n_trees, width), dtype=np.intp)
        self.threshold = np.full((n_trees, width), np.inf)
        self.path = np.zeros((n_trees, width))
        split = feature >= 0
        self.feature[tree[split], node[split]] = feature[split]
        self.threshold[tree[split], node[split]] = np.asarray(threshold)[split]
        leaf = ~split
        slot = (node[leaf] << (self.levels - depth[leaf])) - width
        self.path[tree[leaf], slot] = depth[leaf] + mean_path(np.asarray(n_rows)[leaf])

    def mean_depth(self, rows: np.ndarray) -> np.ndarray:
        """Mean path length of each row over all trees."""
        n, width = len(rows), 1 << self.levels
        by_feature = np.ascontiguousarray(rows.T).reshape(-1)
        position = np.arange(n)
        total = np.zeros(n)
        for t in range(self.n_trees):
            start, threshold = self.feature[t] * n, self.threshold[t]
            node = np.ones(n, dtype=np.intp)
            for _ in range(self.levels):
                value = by_feature[start[node] + position]
                node = 2 * node + (value > threshold[node])
            total += self.path[t][node - width]
        return total / self.n_trees
