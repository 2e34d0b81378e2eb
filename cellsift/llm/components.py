"""Connected components of an edge table, by alternating star contractions.

Nothing but counters reaches the driver. Each round is a written table in the
shared folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsift.sources.scratch import cut_lineage, drop_written

EDGE = "a long, b long"


def join_labels(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union the sets of positions a and b; a set's label is its least position."""
    while len(a):
        one, two = parent[a], parent[b]
        apart = one != two
        a, b, one, two = a[apart], b[apart], one[apart], two[apart]
        np.minimum.at(parent, np.maximum(one, two), np.minimum(one, two))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up
    return parent


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch's edges as stars around the least id: the same components, fewer edges."""
    for batch in batches:
        a, b = (batch.column(i).to_numpy() for i in range(2))
        ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        parent = join_labels(np.arange(len(ids)), at[: len(a)], at[len(a) :])
        off = np.flatnonzero(parent != np.arange(len(ids)))
        yield pa.RecordBatch.from_arrays([pa.array(ids[off]), pa.array(ids[parent[off]])], names=["a", "b"])


def _stamp(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], int(row[1] or 0)


def components(edges: DataFrame, kept: list[str]) -> DataFrame:
    """``(id, root)`` of each id of ``edges(a, b)`` that is not the least of its component.

    Edges are longs in either direction; loops and repeated edges do no harm.
    Ids on no row are their own root. ``kept`` collects the last table's path.
    """
    edges = edges.where("a <> b").mapInArrow(_contract, EDGE)
    paths: list[str] = []
    edges = cut_lineage(edges, "edges", paths)
    stamp = _stamp(edges)
    while True:
        # Large star: the greater neighbours of an id move to the least one around it.
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # Small star: an id and its lesser neighbours move to the least of these.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(
                F.array(
                    F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
                    F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                )
            ).alias("e")
        )
        small = small.select("e.*").where("a <> b").distinct()
        old, paths_old = stamp, paths
        paths = []
        edges = cut_lineage(small, "edges", paths)
        stamp = _stamp(edges)
        drop_written(edges.sparkSession, paths_old)
        if stamp == old:
            break
    kept.extend(paths)
    return edges.select(F.col("a").alias("id"), F.col("b").alias("root"))
