"""Exact k-nearest-neighbour join between two tables.

Distance is squared Euclidean over z-scores plus the category penalty of
``features``. The join never pairs every query with every reference row:

1. Identical reference points keep only their first k + 1 rows by key, which
   is all any query can use. A hot point shrinks to k + 1 rows before the
   shuffle of the window ends.
2. A small random sample of the points places cuts that divide the space into
   leaves of about ``LEAF_ROWS`` rows. The sample decides only where the cuts
   are. Every leaf then gets its true bounding box.
3. A query looks into the leaf it falls into, which yields an upper bound of its
   k-th distance, and then into just those leaves whose box is closer than the
   bound. All others are ruled out by the box, so the result is exact.
   Leaves above ``MAX_LEAF_ROWS`` are cut into cells on the executors, and the
   same is done with cells, so that the number of leaves bounds no table.
4. Leaf and query rows meet in groups of bounded size: big leaves are split by
   key hash, hot leaves get as many query chunks as their query count asks for.

Ties are ordered by key; distances are compared after rounding to 9 places.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.storagelevel import StorageLevel

from cellsift.operators.features import FittedFeatures, PreparedFeatures
from cellsift.operators.leaf_cells import LeafCells
from cellsift.operators.space import (
    LEAF_RUN, PAIR_CELLS, SLACK, LeafBoxes, SpaceCuts, batches, cut_space, matrix, part_of,
)
from cellsift.spec import SpecError

LEAF_ROWS = 1024
# Leaves of the first level, which the driver knows; larger tables get larger leaves.
MAX_LEAVES = 131_072
# Leaves above this have a second level.
MAX_LEAF_ROWS = 16 * LEAF_ROWS
SAMPLE_PER_LEAF = 16
# Largest sides of one group of the leaf join.
MAX_GROUP_REFERENCE = 65_536
MAX_GROUP_QUERIES = 8_192
# Category lists up to this size are turned into a literal.
MAX_KNOWN_LITERALS = 10_000
DIST_DIGITS = 9


def _codes(reference: pa.ChunkedArray, queries: pa.ChunkedArray):
    """Shared integer codes of two text columns; -1 for null."""
    joined = pa.chunked_array([*reference.chunks, *queries.chunks], type=reference.type)
    coded = joined.combine_chunks().dictionary_encode().indices
    codes = pc.fill_null(coded, -1).to_numpy(zero_copy_only=False)
    return codes[: len(reference)], codes[len(reference):]


def _reach(dist: np.ndarray, keep: int) -> np.ndarray:
    """For each row a bound that ``keep`` of its distances do not exceed, as low as is cheap to find."""
    sets = 16 * keep
    deep = dist.shape[1] // sets
    if deep < 4:
        return np.partition(dist, keep - 1, axis=1)[:, keep - 1]
    # Least distances of disjoint sets of columns are distances themselves.
    least = dist[:, : deep * sets].reshape(len(dist), deep, sets).min(axis=1)
    reach = np.partition(least, keep - 1, axis=1)[:, keep - 1]
    unknown = np.isnan(reach)
    if unknown.any():
        reach[unknown] = np.partition(dist[unknown], keep - 1, axis=1)[:, keep - 1]
    return reach


def nearest_pairs(
    reference: pa.Table, queries: pa.Table, z_names: Sequence[str], c_names: Sequence[str], keep: int
):
    """The ``keep`` nearest reference rows per query: (query, reference, distance) positions."""
    numbers = [
        (reference[z].to_numpy(), queries[z].to_numpy()) for z in z_names
    ]
    texts = [_codes(reference[c], queries[c]) for c in c_names]
    key_rank = pc.rank(reference["_key"], sort_keys="ascending", tiebreaker="first").to_numpy()
    found = []
    for start, stop in batches(queries.num_rows, reference.num_rows, PAIR_CELLS):
        dist = np.zeros((stop - start, reference.num_rows))
        part = np.empty_like(dist)
        for ref, qry in numbers:
            np.subtract(qry[start:stop, None], ref, out=part)
            np.multiply(part, part, out=part)
            dist += part
        for ref, qry in texts:
            here = qry[start:stop]
            np.multiply(here[:, None] != ref, 2.0, out=part)
            part[here < 0] = 1.0
            dist += part
        if reference.num_rows > keep:
            q, r = np.divmod(np.flatnonzero(dist <= _reach(dist, keep)[:, None] + SLACK), reference.num_rows)
        else:
            q, r = np.nonzero(np.ones_like(dist, dtype=bool))
        d = np.round(dist[q, r], DIST_DIGITS)
        order = np.lexsort((key_rank[r], d, q))
        q, r, d = q[order], r[order], d[order]
        place = np.arange(len(q)) - np.searchsorted(q, q, side="left")
        near = place < keep
        found.append((q[near] + start, r[near], d[near]))
    if not found:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, np.zeros(0)
    return tuple(np.concatenate(part) for part in zip(*found))


class NeighbourIndex:
    """Reference rows arranged for exact nearest-neighbour lookups."""

    def __init__(
        self,
        reference: DataFrame,
        features: FittedFeatures | PreparedFeatures,
        key: str,
        payload: Sequence[str],
        k: int,
        leaf_rows: int = LEAF_ROWS,
        seed: int = 42,
        max_leaves: int = MAX_LEAVES,
        max_leaf_rows: int = MAX_LEAF_ROWS,
    ):
        if not features.names:
            raise SpecError("neighbour search needs at least one feature column")
        self.features, self.k, self.keep = features, k, k + 1
        self.payload = list(payload)
        self.spark = reference.sparkSession
        self._held: list[DataFrame] = []
        rows = reference.select(
            *features.columns(reference),
            F.col(key).cast("string").alias("_key"),
            *[F.col(c).alias(f"p__{c}") for c in self.payload],
        )
        distinct = self._first_per_point(rows).persist(StorageLevel.MEMORY_AND_DISK)
        total = distinct.count()
        leaves = max(1, min(max_leaves, math.ceil(total / leaf_rows)))
        self._cuts = self._sample_cuts(distinct, total, leaves, seed)
        self.rows = distinct.withColumn("_leaf", self._leaf_of()).persist(StorageLevel.MEMORY_AND_DISK)
        self._boxes = self._measure_boxes()
        self._cells = None
        if self._boxes.rows.max() > max_leaf_rows:
            self._cells = LeafCells(
                self.rows, self.features.names, self._axes(), len(self.features.z_names),
                leaf_rows, max_leaf_rows, MAX_GROUP_REFERENCE, MAX_GROUP_QUERIES,
            )
            self.rows.unpersist()
            self.rows = self._cells.rows
        distinct.unpersist()
        self._known = self._known_categories()

    def close(self) -> None:
        """Free the cached tables; frames that a search returned are recomputed."""
        for df in (self.rows, *self._held):
            df.unpersist()
        self._held.clear()
        if self._cells:
            self._cells.close()

    # Building ------------------------------------------------------------
    def _first_per_point(self, rows: DataFrame) -> DataFrame:
        by_point = Window.partitionBy(*self.features.names).orderBy("_key")
        return (
            rows.withColumn("_copy", F.row_number().over(by_point))
            .filter(F.col("_copy") <= self.keep)
            .drop("_copy")
        )

    def _axes(self) -> list[Column]:
        """Coordinates as numbers; a category counts by the order of its hash."""
        names = self.features
        return [F.col(z) for z in names.z_names] + [
            F.when(F.col(c).isNotNull(), F.xxhash64(c).cast("double")) for c in names.c_names
        ]

    def _sample_cuts(self, distinct: DataFrame, total: int, leaves: int, seed: int) -> SpaceCuts:
        numeric = len(self.features.z_names)
        if leaves == 1:
            return cut_space(np.zeros((0, 0)), numeric, 1)
        # A fixed number of rows per leaf, at most 2**21 short rows in all.
        fraction = min(1.0, leaves * SAMPLE_PER_LEAF / total)
        axes = [a.alias(f"a{i}") for i, a in enumerate(self._axes())]
        sample = distinct.select(*axes).sample(fraction, seed).toPandas()
        return cut_space(sample.to_numpy(dtype=float), numeric, leaves)

    def _leaf_of(self) -> Column:
        if self._cuts.leaves == 1:
            return F.lit(0)
        cuts = self._cuts

        @F.pandas_udf("int")
        def locate(*axes):
            return pd.Series(cuts.locate(matrix(axes)))

        return locate(*self._axes())

    def _measure_boxes(self) -> LeafBoxes:
        axes = self._axes()
        leaves = self._cuts.leaves
        # One row per leaf, so at most MAX_LEAVES rows reach the driver.
        found = self.rows.groupBy("_leaf").agg(
            F.count(F.lit(1)).alias("n"),
            *[F.min(a).alias(f"l{i}") for i, a in enumerate(axes)],
            *[F.max(a).alias(f"h{i}") for i, a in enumerate(axes)],
        ).collect()
        low = np.full((leaves, len(axes)), np.inf)
        high = np.full((leaves, len(axes)), -np.inf)
        rows = np.zeros(leaves, dtype=np.int64)
        for r in found:
            rows[r["_leaf"]] = r["n"]
            low[r["_leaf"]] = [r[f"l{i}"] for i in range(len(axes))]
            high[r["_leaf"]] = [r[f"h{i}"] for i in range(len(axes))]
        return LeafBoxes(low, high, rows, len(self.features.z_names))

    def _known_categories(self) -> dict[str, list[str] | None]:
        """Distinct reference categories where they are few, else None."""
        names = self.features.c_names
        if not names:
            return {}
        pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).alias("v")) for i, c in enumerate(names)]))
        distinct = self.rows.select(pairs.alias("p")).select("p.*").distinct()
        limit = MAX_KNOWN_LITERALS
        few = distinct.limit(limit + 1).collect()
        if len(few) > limit:
            return {c: None for c in names}
        return {c: [r["v"] for r in few if r["i"] == i] for i, c in enumerate(names)}

    # Searching -----------------------------------------------------------
    def search(self, queries: DataFrame, name: str = "neighbours") -> DataFrame:
        """Add an array of the k + 1 nearest rows, nearest first.

        The spare entry allows a row to drop itself, see ``k_nearest``.
        """
        names = self.features.names
        points = queries.select(
            "*", *[c.alias(f"_q_{n}") for n, c in zip(names, self.features.columns(queries))]
        )
        wanted = points.select(*[F.col(f"_q_{n}").alias(n) for n in names])
        found = self._nearest(self._mark_unknown(wanted).distinct(), name)
        marked = self._mark_unknown(points, "_q_")
        found = found.select(*[F.col(n).alias(f"_n_{n}") for n in names], name)
        same = [F.col(f"_q_{n}").eqNullSafe(F.col(f"_n_{n}")) for n in names]
        return marked.join(found, reduce(lambda a, b: a & b, same), "left").select(
            *[F.col(f"`{c}`") for c in queries.columns], name
        )

    def k_nearest(self, queries: DataFrame, exclude_self: str | None = None, name: str = "neighbours") -> DataFrame:
        """Add an array of the k nearest rows, without the row of the same key on demand."""
        near = F.col(name)
        if exclude_self is not None:
            own = F.col(exclude_self).cast("string")
            # Only one entry is the row itself; equal keys beyond it stay.
            at = F.coalesce(F.array_position(near["key"], own), F.lit(0)).cast("int")
            without = F.concat(
                F.slice(near, F.lit(1), F.greatest(at - 1, F.lit(0))),
                F.slice(near, at + 1, F.greatest(F.size(near) - at, F.lit(0))),
            )
            near = F.when(near.isNull(), near).when(at > 0, without).otherwise(near)
        return self.search(queries, name).withColumn(name, F.slice(near, 1, self.k))

    def _mark_unknown(self, df: DataFrame, prefix: str = "") -> DataFrame:
        """Null for categories that the reference does not have."""
        for c in self.features.c_names:
            column, known = f"{prefix}{c}", self._known[c]
            if known is not None:
                df = df.withColumn(column, F.when(F.col(column).isin(known), F.col(column)))
            else:
                values = self.rows.select(F.col(c).alias("_known")).distinct()
                df = df.join(values, F.col(column) == F.col("_known"), "left").withColumn(
                    column, F.col("_known")
                ).drop("_known")
        return df

    def _nearest(self, points: DataFrame, name: str) -> DataFrame:
        names, cells = self.features.names, self._cells
        if self._cuts.leaves == 1 and not cells:
            hits = self._leaf_join(points.withColumn("_leaf", F.lit(0)), self._pairs_schema(), bound_only=False)
        else:
            home = points.withColumn("_leaf", self._leaf_of())
            home = cells.home(home, self.keep) if cells else home
            bounds = self._leaf_join(home, self._bound_schema(), bound_only=True)
            wide = bounds.withColumn("_leaf", F.explode(self._close_leaves()))
            wide = cells.within(wide) if cells else wide.drop("_bound")
            hits = self._leaf_join(wide, self._pairs_schema(), bound_only=False)
        by_point = Window.partitionBy(*names).orderBy("dist2", "_key")
        top = hits.withColumn("_place", F.row_number().over(by_point)).filter(F.col("_place") <= self.keep)
        return top.groupBy(*names).agg(self._as_array(name))

    def _as_array(self, name: str) -> Column:
        entry = F.struct(
            F.col("dist2"), F.col("_key").alias("key"), *[F.col(f"p__{c}").alias(c) for c in self.payload]
        )
        return F.sort_array(F.collect_list(entry)).alias(name)

    def _close_leaves(self) -> Column:
        boxes = self._boxes
        runs = math.ceil(boxes.leaves / LEAF_RUN)

        @F.pandas_udf("array<int>")
        def close_leaves(bound, *axes):
            points, limit = matrix(axes), bound.to_numpy(dtype=float)
            out = []
            for start, stop in batches(len(points), runs):
                out.extend(boxes.close_leaves(points[start:stop], limit[start:stop]))
            return pd.Series(out)

        return close_leaves(F.col("_bound"), *self._axes())

    def _point_fields(self) -> list[T.StructField]:
        return [
            T.StructField(n, T.DoubleType() if n.startswith("z__") else T.StringType())
            for n in self.features.names
        ]

    def _bound_schema(self) -> T.StructType:
        return T.StructType([*self._point_fields(), T.StructField("_bound", T.DoubleType())])

    def _pairs_schema(self) -> T.StructType:
        extra = [f for f in self.rows.schema.fields if f.name == "_key" or f.name.startswith("p__")]
        return T.StructType([*self._point_fields(), T.StructField("dist2", T.DoubleType()), *extra])

    def _splits(self, queries: DataFrame) -> tuple[list[str], DataFrame, int]:
        """What a group is made of, parts of both sides for each leaf or cell, number of groups."""
        if self._cells:
            place = ["_leaf", "_cell"]
            # As many rows as cells, so the plan is a table and is joined like one.
            plan = queries.groupBy(*place).agg(F.count(F.lit(1)).alias("_n")).join(self._cells.cells, place).select(
                *place, F.ceil(F.col("_rows") / MAX_GROUP_REFERENCE).cast("int").alias("_subs"),
                F.ceil(F.col("_n") / MAX_GROUP_QUERIES).cast("int").alias("_chunks"),
            ).persist(StorageLevel.MEMORY_AND_DISK)
            self._held.append(plan)
            return place, plan, plan.agg(F.sum(F.col("_subs") * F.col("_chunks"))).first()[0] or 0
        asked = {r["_leaf"]: r["count"] for r in queries.groupBy("_leaf").count().collect()}
        # One row per leaf: at most MAX_LEAVES rows are broadcast.
        plan = [
            (leaf, math.ceil(int(self._boxes.rows[leaf]) / MAX_GROUP_REFERENCE), math.ceil(n / MAX_GROUP_QUERIES))
            for leaf, n in asked.items()
        ]
        splits = F.broadcast(self.spark.createDataFrame(plan, "_leaf int, _subs int, _chunks int"))
        return ["_leaf"], splits, sum(subs * chunks for _, subs, chunks in plan)

    def _leaf_join(self, queries: DataFrame, schema: T.StructType, bound_only: bool) -> DataFrame:
        """Meet queries and reference rows leaf by leaf, in groups of bounded size."""
        names, keep = self.features.names, self.keep
        z_names, c_names = self.features.z_names, self.features.c_names
        queries = queries.persist(StorageLevel.MEMORY_AND_DISK)
        self._held.append(queries)
        place, splits, groups = self._splits(queries)
        left = (
            self.rows.join(splits, place)
            # By key and point: rows of one shared id must not stay together.
            .withColumn("_sub", part_of(["_key", *names], F.col("_subs")))
            .withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
            .drop("_subs", "_chunks")
        )
        right = (
            queries.select(*names, *place).join(splits, place)
            .withColumn("_chunk", part_of(names, F.col("_chunks")))
            .withColumn("_sub", F.explode(F.sequence(F.lit(0), F.col("_subs") - 1)))
            .drop("_subs", "_chunks")
        )
        carried = [f.name for f in schema.fields if f.name not in names and f.name not in ("dist2", "_bound")]
        arrow_schema = to_arrow_schema(schema)

        def meet(reference: pa.Table, asked: pa.Table) -> pa.Table:
            if not reference.num_rows or not asked.num_rows:
                return arrow_schema.empty_table()
            q, r, d = nearest_pairs(reference, asked, z_names, c_names, keep)
            if bound_only:
                out = asked.select(names)
                worst = np.full(asked.num_rows, np.inf)
                full = np.bincount(q, minlength=asked.num_rows) >= keep
                ends = np.searchsorted(q, np.arange(asked.num_rows), side="right") - 1
                worst[full] = d[ends[full]]
                return out.append_column("_bound", pa.array(worst)).cast(arrow_schema)
            out = asked.select(names).take(pa.array(q)).append_column("dist2", pa.array(d))
            for c in carried:
                out = out.append_column(c, reference[c].take(pa.array(r)))
            return out.cast(arrow_schema)

        group = [*place, "_sub", "_chunk"]
        # Work grows with pairs, not bytes, so the number of tasks is set here.
        context = self.spark.sparkContext
        shuffles = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        tasks = max(1, min(groups, max(shuffles, context.defaultParallelism)))
        left, right = left.repartition(tasks, *group), right.repartition(tasks, *group)
        met = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(meet, schema)
        if bound_only:
            # Parts of a split leaf give one bound each; every one of them holds.
            return met.groupBy(*names).agg(F.min("_bound").alias("_bound"))
        return met
