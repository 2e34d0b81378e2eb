"""Distances of a group and boxes in reach, against every pair and every box."""

import numpy as np
import pyarrow as pa
import pytest

from cellsift.operators import neighbours, space


def _table(random, n):
    return pa.table({
        "z__a": random.integers(0, 9, n).astype(float), "z__b": random.normal(size=n) * 1e3,
        "c__a": pa.array([None if x == 3 else f"c{x}" for x in random.integers(0, 4, n)], pa.string()),
        "_key": [f"k{x:05d}" for x in random.permutation(n) // 2],
    })


@pytest.mark.parametrize("rows", [3, 7, 100, 1500])
def test_nearest_pairs_equal_the_sorted_pairs(rows):
    random = np.random.default_rng(rows)
    reference, asked = _table(random, rows), _table(random, 150)
    q, r, d = neighbours.nearest_pairs(reference, asked, ["z__a", "z__b"], ["c__a"], 6)
    ref, qry = reference.to_pylist(), asked.to_pylist()
    rank = np.argsort(np.argsort([x["_key"] for x in ref], kind="stable"))
    for i, x in enumerate(qry):
        all_ = []
        for j, y in enumerate(ref):
            apart = 1.0 if x["c__a"] is None else 2.0 * (x["c__a"] != y["c__a"])
            all_.append((round((x["z__a"] - y["z__a"]) ** 2 + (x["z__b"] - y["z__b"]) ** 2 + apart, 9), rank[j], j))
        want = sorted(all_)[:6]
        assert r[q == i].tolist() == [j for _, _, j in want]
        assert d[q == i] == pytest.approx([e for e, _, _ in want], abs=1e-8)


def test_bound_holds_where_distances_are_unknown():
    dist = np.random.default_rng(1).random((50, 1000))
    dist[3, :990], dist[4, ::2], dist[5] = np.nan, np.nan, np.nan
    reach = neighbours._reach(dist, 6)
    kth = np.partition(dist, 5, axis=1)[:, 5]
    assert (np.isnan(kth) | (reach >= kth)).all()
    assert ((dist <= reach[:, None]).sum(axis=1)[:3] < 20).all()


def test_boxes_looked_at_do_not_grow_with_the_leaves(monkeypatch):
    """F6 to F22: every query looked at one box for each 64 leaves, so work grew with the square of the table."""
    seen = []
    gaps = space.LeafBoxes.gaps
    monkeypatch.setattr(space.LeafBoxes, "gaps", lambda self, p, low, high: (seen.append(len(p) * len(low)), gaps(self, p, low, high))[1])
    random = np.random.default_rng(2)
    points, limit = random.random((40, 2)) * 100, np.full(40, 1e-4)
    limit[0] = np.inf
    each = {}
    for n in (60, 5_000, 131_072):
        low = np.column_stack([np.arange(n) * 100 / n, np.zeros(n)])
        high = np.column_stack([low[:, 0] + 100 / n, np.full(n, 100.0)])
        rows = np.where(np.arange(n) % 7 == 3, 0, 5)
        boxes = space.LeafBoxes(low, high, rows, 2)
        want = [np.flatnonzero(row & (rows > 0)) for row in gaps(boxes, points, low, high) <= limit[:, None] + space.SLACK]
        found = boxes.close_leaves(points, limit)
        assert all(f.dtype == np.int32 and np.array_equal(f, w) for f, w in zip(found, want, strict=True))
        seen.clear()
        boxes.close_leaves(points[1:], limit[1:])
        each[n] = sum(seen) / 39
    assert each[131_072] < 400
