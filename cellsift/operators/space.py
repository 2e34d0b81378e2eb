"""Cuts of the feature space and boxes around its parts, as flat arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Leaves that are ruled out together before they are looked at one by one.
LEAF_RUN = 64
SLACK = 1e-8
# Cells of one matrix of points and boxes in a Python worker.
MATRIX_CELLS = 2_000_000
# Cells of one matrix of queries and rows, which is passed over many times and stays in a core's cache.
PAIR_CELLS = 1 << 16


@dataclass(frozen=True)
class SpaceCuts:
    """Binary cuts over the feature space; leaves are numbered from 0."""

    axis: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    leaf: np.ndarray

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def locate(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), dtype=np.int64)
        rows = np.arange(len(points))
        while True:
            inner = self.leaf[node] < 0
            if not inner.any():
                return self.leaf[node]
            at = node[inner]
            goes_left = points[rows[inner], self.axis[at]] <= self.cut[at]
            node[inner] = np.where(goes_left, self.left[at], self.right[at])


def cut_space(sample: np.ndarray, numeric: int, leaves: int) -> SpaceCuts:
    """Cut at sample medians, always across the axis that separates rows most."""
    nodes: list[list] = []
    next_leaf = 0

    def spread(rows: np.ndarray, axis: int) -> float:
        column = sample[rows, axis]
        # The variance of equal numbers may differ from 0 by rounding.
        if column.min() == column.max():
            return 0.0
        if axis < numeric:
            return 2.0 * float(column.var())
        _, counts = np.unique(column, return_counts=True)
        return 2.0 * (1.0 - float(((counts / len(rows)) ** 2).sum()))

    todo = [(np.arange(len(sample)), max(1, leaves), None, 0)]
    while todo:
        rows, want, parent, side = todo.pop()
        here = len(nodes)
        nodes.append([0, 0.0, 0, 0, -1])
        if parent is not None:
            nodes[parent][side] = here
        axis = -1
        if want > 1 and len(rows) > 1 and sample.shape[1]:
            spreads = [spread(rows, a) for a in range(sample.shape[1])]
            axis = int(np.argmax(spreads))
            if spreads[axis] <= 0:
                axis = -1
        if axis < 0:
            nodes[here][4] = next_leaf
            next_leaf += 1
            continue
        ordered = np.sort(sample[rows, axis])
        cut = ordered[(len(ordered) - 1) // 2]
        if cut == ordered[-1]:
            cut = ordered[ordered < cut][-1]
        below = sample[rows, axis] <= cut
        share = below.mean()
        left_want = min(want - 1, max(1, round(want * share)))
        nodes[here][:2] = [axis, cut]
        todo.append((rows[~below], want - left_want, here, 3))
        todo.append((rows[below], left_want, here, 2))
    columns = list(zip(*nodes))
    return SpaceCuts(
        np.array(columns[0]), np.array(columns[1], dtype=float), np.array(columns[2]),
        np.array(columns[3]), np.array(columns[4]),
    )


@dataclass(frozen=True)
class LeafBoxes:
    low: np.ndarray
    high: np.ndarray
    rows: np.ndarray
    numeric: int

    @property
    def leaves(self) -> int:
        return len(self.rows)

    def gaps(self, points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Least squared distance from each point to anything inside each box.

        A missing category code stands for a category unknown at fit time.
        """
        out = np.zeros((len(points), len(low)))
        for axis in range(points.shape[1]):
            x = points[:, axis, None]
            if axis < self.numeric:
                gap = np.maximum(np.maximum(low[:, axis] - x, x - high[:, axis]), 0.0)
                out += gap * gap
            else:
                outside = (x < low[:, axis]) | (x > high[:, axis])
                out += np.where(np.isnan(x), 1.0, np.where(outside, 2.0, 0.0))
        return out

    def close_leaves(self, points: np.ndarray, limit: np.ndarray) -> list[np.ndarray]:
        """For each point the leaves that may hold a row within its squared distance.

        Leaves next to each other in number are next to each other in space, so
        runs of them are ruled out together by their common box, and so are runs
        of runs: a point looks at a number of boxes that grows with the levels.
        """
        levels = [(self.low, self.high)]
        while len(levels[-1][0]) > LEAF_RUN:
            starts = np.arange(0, len(levels[-1][0]), LEAF_RUN)
            low, high = levels[-1]
            levels.append((np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)))
        reach = limit[:, None] + SLACK
        found_points, found_leaves = [], []
        todo = [(len(levels) - 1, 0, np.arange(len(points)))]
        while todo:
            level, start, some = todo.pop()
            low, high = (side[start : start + LEAF_RUN] for side in levels[level])
            near = self.gaps(points[some], low, high) <= reach[some]
            if level:
                # The last one is taken first, so leaves come in order.
                inner = np.flatnonzero(near.any(axis=0))[::-1].tolist()
                todo += [(level - 1, (start + run) * LEAF_RUN, some[near[:, run]]) for run in inner]
                continue
            q, leaf = np.nonzero(near & (self.rows[start : start + LEAF_RUN] > 0))
            found_points.append(some[q])
            found_leaves.append((leaf + start).astype(np.int32))
        if not found_points:
            return [np.zeros(0, dtype=np.int32)] * len(points)
        owner, leaves = np.concatenate(found_points), np.concatenate(found_leaves)
        leaves = leaves[np.argsort(owner, kind="stable")]
        ends = np.cumsum(np.bincount(owner, minlength=len(points)))
        return np.split(leaves, ends[:-1])


def batches(total: int, width: int, cells: int = MATRIX_CELLS):
    step = max(1, cells // max(1, width))
    for start in range(0, total, step):
        yield start, min(total, start + step)


def part_of(columns: list[str], parts: Column) -> Column:
    """Number of the part a row of a split leaf goes to."""
    return F.pmod(F.xxhash64(*columns), parts).cast("int")


def matrix(axes) -> np.ndarray:
    if not axes:
        return np.zeros((0, 0))
    return np.column_stack([a.to_numpy(dtype=float) for a in axes])
