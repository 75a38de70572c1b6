"""Balanced trees over integer points, and the dual-tree assignment of points to their nearest entries.

A tree halves its points again and again along the widest side of each node's box, so node j of level v holds the points
from `n * j >> v` to `n * (j + 1) >> v` of one permutation; only permutation, points, boxes and sums are kept.

The assignment walks pairs of a point node and an entry node, level by level in both trees. A pair is dropped when the
least distance between its boxes exceeds the greatest distance of another pair of the same point node; among single
entries, one is also dropped when another is at least as near everywhere in the box. A point node left with a single
entry is assigned whole, by its cached count and sum; points of a leaf that keeps several entries are compared with those
entries one by one. All arithmetic is on 64-bit integers, so bounds, distances and ties are exact.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LEAF_POINTS = 16


def bounds_of(n: int, level: int) -> np.ndarray:
    """Where the nodes of a level begin, and the end of the last."""
    return n * np.arange((1 << level) + 1, dtype=np.int64) >> level


def levels_of(n: int, leaf: int) -> int:
    level = 0
    while n > leaf << level:
        level += 1
    return level


@dataclass
class Tree:
    order: np.ndarray  # position in the tree -> position in the input
    points: np.ndarray  # (n, d), in tree order
    low: np.ndarray  # (nodes, d), level by level; node j of level v stands at 2^v - 1 + j
    high: np.ndarray
    sums: np.ndarray

    @property
    def levels(self) -> int:
        return (len(self.low) + 1).bit_length() - 2


def build(points: np.ndarray, leaf: int = LEAF_POINTS) -> Tree:
    """The tree of at least one point."""
    points = points.astype(np.int64)
    n, levels = len(points), levels_of(len(points), leaf)
    order = np.arange(n)
    low, high, sums = [], [], []
    for level in range(levels + 1):
        edges = bounds_of(n, level)
        here = points[order]
        low.append(np.minimum.reduceat(here, edges[:-1]))
        high.append(np.maximum.reduceat(here, edges[:-1]))
        sums.append(np.add.reduceat(here, edges[:-1]))
        if level < levels:
            node = np.repeat(np.arange(1 << level), np.diff(edges))
            widest = (high[-1] - low[-1]).argmax(axis=1) if points.shape[1] else np.zeros(1 << level, np.int64)
            side = here[np.arange(n), widest[node]] if points.shape[1] else np.zeros(n, np.int64)
            order = order[np.lexsort((side, node))]
    return Tree(order, points[order], np.concatenate(low), np.concatenate(high), np.concatenate(sums))


def _least(a_low, a_high, b_low, b_high) -> np.ndarray:
    gap = np.maximum(np.maximum(b_low - a_high, a_low - b_high), 0)
    return (gap * gap).sum(axis=1)


def _greatest(a_low, a_high, b_low, b_high) -> np.ndarray:
    reach = np.maximum(a_high - b_low, b_high - a_low)
    return (reach * reach).sum(axis=1)


def _dominated(tree: Tree, node: np.ndarray, entry: np.ndarray, entries: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Pairs (node, entry) whose entry loses to the node's most promising entry everywhere in the box.

    |x - e|^2 - |x - b|^2 is linear in x, so its least value over the box is reached at a corner. An entry with a larger
    number also loses where the two are equal.
    """
    first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
    run = np.cumsum(np.concatenate([[True], node[1:] != node[:-1]])) - 1
    rank = np.lexsort((entry, upper, run))
    best = entry[rank[first]][run]
    slope = 2 * (entries[best] - entries[entry])
    corner = np.where(slope > 0, tree.low[node], tree.high[node])
    squares = (entries * entries).sum(axis=1)
    least = (slope * corner).sum(axis=1) + squares[entry] - squares[best]
    return (entry != best) & ((least > 0) | ((least == 0) & (entry > best)))


@dataclass
class Assigned:
    owner: np.ndarray  # entry of each point, in tree order
    sums: np.ndarray  # (entries, d)
    counts: np.ndarray
    whole_points: int  # points that were assigned with their node


def assign(tree: Tree, entries: np.ndarray) -> Assigned:
    """Nearest entry of every point of the tree; the smaller number wins a tie."""
    entries = entries.astype(np.int64)
    n, k = len(tree.points), len(entries)
    book = build(entries, 1)
    depth, book_depth = tree.levels, book.levels
    owner = np.full(n, -1, np.int64)
    sums, counts = np.zeros(entries.shape, np.int64), np.zeros(k, np.int64)
    node, other = np.zeros(1, np.int64), np.zeros(1, np.int64)
    for step in range(max(depth, book_depth) + 1):
        level, book_level = min(step, depth), min(step, book_depth)
        at, near = (1 << level) - 1 + node, (1 << book_level) - 1 + other
        boxes = tree.low[at], tree.high[at], book.low[near], book.high[near]
        upper = _greatest(*boxes)
        first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        run = np.cumsum(np.concatenate([[True], node[1:] != node[:-1]])) - 1
        keep = _least(*boxes) <= np.minimum.reduceat(upper, first)[run]
        node, other, at, upper = node[keep], other[keep], at[keep], upper[keep]
        # Halves of an odd number of entries make empty nodes on the last level; bounds_of tells which hold one.
        if book_level == book_depth:
            single = book.order[bounds_of(k, book_depth)[other]]
            lost = _dominated(tree, at, single, entries, upper)
            node, other, at, single = node[~lost], other[~lost], at[~lost], single[~lost]
            alone = np.concatenate([[True], node[1:] != node[:-1]]) & np.concatenate([node[1:] != node[:-1], [True]])
            edges = bounds_of(n, level)
            for j, a, e in zip(node[alone], at[alone], single[alone]):
                owner[edges[j] : edges[j + 1]] = e
                sums[e] += tree.sums[a]
                counts[e] += edges[j + 1] - edges[j]
            node, other = node[~alone], other[~alone]
        if not len(node):
            break
        if step < max(depth, book_depth):
            if level < depth:
                node, other = np.concatenate([2 * node, 2 * node + 1]), np.concatenate([other, other])
            if book_level < book_depth:
                node, other = np.concatenate([node, node]), np.concatenate([2 * other, 2 * other + 1])
                edges = bounds_of(k, book_level + 1)
                holds = edges[other + 1] > edges[other]
                node, other = node[holds], other[holds]
            ranked = np.lexsort((other, node))
            node, other = node[ranked], other[ranked]
    whole_points = int(counts.sum())
    if len(node):
        _compare(tree, entries, node, book.order[bounds_of(k, book_depth)[other]], owner, sums, counts)
    return Assigned(owner, sums, counts, whole_points)


def _compare(tree: Tree, entries, node, entry, owner, sums, counts) -> None:
    """Integer comparison of the points of undecided leaves with the entries that are left for them."""
    edges = bounds_of(len(tree.points), tree.levels)
    nearest = np.full(len(tree.points), np.iinfo(np.int64).max, np.int64)
    for e in np.unique(entry):
        leaves = node[entry == e]
        rows = np.concatenate([np.arange(edges[j], edges[j + 1]) for j in leaves])
        away = tree.points[rows] - entries[e]
        distance = (away * away).sum(axis=1)
        closer = distance < nearest[rows]
        nearest[rows[closer]], owner[rows[closer]] = distance[closer], e
    rows = np.flatnonzero(nearest < np.iinfo(np.int64).max)
    np.add.at(sums, owner[rows], tree.points[rows])
    counts += np.bincount(owner[rows], minlength=len(entries))
