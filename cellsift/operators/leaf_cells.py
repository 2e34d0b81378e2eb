"""Second level of the neighbour index: leaves cut into cells on the executors.

The first level is cut on the driver, so its number of leaves is bounded. Where
a leaf holds more rows than a cell may, its rows are cut again in place, level
by level, until no cell is above the bound or its points can't be told apart.
Cells, their boxes and the plan of a search are tables; none reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.storagelevel import StorageLevel

from cellsift.operators.space import SLACK, LeafBoxes, SpaceCuts, batches, cut_space, part_of
from cellsift.sources.scratch import cut_lineage, drop_written

# Children of a cell in one level, and rows that place the cuts of each.
FAN_OUT = 1024
SAMPLE_PER_CELL = 16
PLACE = ["_leaf", "_cell"]
_CUT_SCHEMA = "_leaf int, _cell long, axis array<int>, cut array<double>, below array<int>, above array<int>, part array<int>"


class LeafCells:
    """Rows with the number of their cell, and a table of the cells with their boxes.

    ``rows`` have ``_leaf`` and the feature columns ``names``; ``axes`` are the
    coordinates of a row, the first ``numeric`` of them numbers. ``group_rows``
    and ``group_queries`` bound the sides of the groups that meet in a task.
    """

    def __init__(
        self, rows: DataFrame, names: Sequence[str], axes: Sequence[Column], numeric: int,
        cell_rows: int, max_rows: int, group_rows: int, group_queries: int,
    ):
        self.names, self.numeric = list(names), numeric
        self.group_rows, self.group_queries = group_rows, group_queries
        self._axes = [a.alias(f"a{i}") for i, a in enumerate(axes)]
        self._width = len(self._axes)
        self._written: list[str] = []
        self.rows = rows.withColumn("_cell", F.lit(0).cast("long"))
        self._refine(cell_rows, max_rows)
        self.cells = self._boxes().persist(StorageLevel.MEMORY_AND_DISK)

    def close(self) -> None:
        self.cells.unpersist()
        drop_written(self.rows.sparkSession, self._written)

    # Building ------------------------------------------------------------
    def _refine(self, cell_rows: int, max_rows: int) -> None:
        """Cut cells above ``max_rows`` until none is left or a level separates nothing.

        A level writes its rows. Every level makes cells up to ``FAN_OUT`` times
        smaller, so there are as many levels as the logarithm of the largest leaf.
        """
        large = F.col("_n") > max_rows
        above = None
        while True:
            sizes = self.rows.groupBy(*PLACE).agg(F.count(F.lit(1)).alias("_n")).filter(large)
            state = sizes.agg(F.count(F.lit(1)).alias("cells"), F.sum("_n").alias("n"), F.max("_n").alias("most")).first()
            # Points that no axis separates keep their cell; then the figures repeat.
            if not state["cells"] or tuple(state) == above:
                return
            above = tuple(state)
            wanted = sizes.withColumn("_want", F.least(F.lit(FAN_OUT), F.ceil(F.col("_n") / cell_rows)).cast("int"))
            done = list(self._written)
            self.rows = cut_lineage(self._cut_level(wanted), "leaf_cells", self._written)
            for path in done:
                self._written.remove(path)
            drop_written(self.rows.sparkSession, done)

    def _cut_level(self, wanted: DataFrame) -> DataFrame:
        """The rows with the cells of one more level."""
        columns = self.rows.columns
        axis_names = [f"a{i}" for i in range(self._width)]
        marked = self.rows.join(wanted, PLACE, "left")
        small = marked.filter("_n IS NULL").select(*columns)
        large = marked.filter("_n IS NOT NULL").select("*", *self._axes)
        # At most FAN_OUT * SAMPLE_PER_CELL rows of a cell are expected, whatever it holds.
        share = F.least(F.lit(1.0), F.col("_want") * SAMPLE_PER_CELL / F.col("_n"))
        draw = F.pmod(F.xxhash64(F.lit("cut"), "_key", *self.names), F.lit(1 << 30)) < share * (1 << 30)
        numeric = self.numeric

        def cut(sample: pa.Table) -> pa.Table:
            points = np.column_stack([sample[a].to_numpy().astype(float) for a in axis_names])
            # Sorted, so that the cuts do not depend on the order of arrival.
            points = points[np.lexsort(points.T)]
            cuts = cut_space(points, numeric, int(sample["_want"][0].as_py()))
            return pa.table({
                "_leaf": pa.array([sample["_leaf"][0].as_py()], pa.int32()),
                "_cell": pa.array([sample["_cell"][0].as_py()], pa.int64()),
                "axis": pa.array([cuts.axis.tolist()], pa.list_(pa.int32())),
                "cut": pa.array([cuts.cut.tolist()], pa.list_(pa.float64())),
                "below": pa.array([cuts.left.tolist()], pa.list_(pa.int32())),
                "above": pa.array([cuts.right.tolist()], pa.list_(pa.int32())),
                "part": pa.array([cuts.leaf.tolist()], pa.list_(pa.int32())),
            })

        sample = large.filter(draw).select(*PLACE, "_want", *axis_names)
        cuts = sample.groupBy(*PLACE).applyInArrow(cut, _CUT_SCHEMA)
        parts = F.ceil(F.col("_n") / self.group_rows)
        dealt = large.withColumn("_part", part_of(["_key", *self.names], parts)).drop("_n", "_want")
        every = cuts.join(wanted, PLACE).withColumn("_part", F.explode(F.sequence(F.lit(0), parts.cast("int") - 1)))
        schema = self.rows.schema
        arrow_schema = to_arrow_schema(schema)

        def locate(rows: pa.Table, cuts: pa.Table) -> pa.Table:
            if not rows.num_rows:
                return arrow_schema.empty_table()
            # Cells of which no row was drawn stay whole in this level.
            if cuts.num_rows:
                lists = [np.array(cuts[c][0].as_py()) for c in ("axis", "cut", "below", "above", "part")]
                points = np.column_stack([rows[a].to_numpy().astype(float) for a in axis_names])
                child = SpaceCuts(*lists).locate(points)
                # Numbers as in a heap, so that no two cells of a leaf share one.
                cell = rows["_cell"].to_numpy() * FAN_OUT + child + 1
                rows = rows.set_column(rows.column_names.index("_cell"), "_cell", pa.array(cell, pa.int64()))
            return rows.select(arrow_schema.names).cast(arrow_schema)

        group = [*PLACE, "_part"]
        located = dealt.groupBy(*group).cogroup(every.groupBy(*group)).applyInArrow(locate, schema)
        return small.unionByName(located)

    def _boxes(self) -> DataFrame:
        """One row per cell: number of rows, least and greatest coordinate of each axis."""
        rows = self.rows.select(*PLACE, *self._axes)
        ends = [f(f"a{i}").alias(f"{n}{i}") for i in range(self._width) for f, n in ((F.min, "l"), (F.max, "h"))]
        return rows.groupBy(*PLACE).agg(F.count(F.lit(1)).alias("_rows"), *ends)

    # Searching -----------------------------------------------------------
    def home(self, queries: DataFrame, keep: int) -> DataFrame:
        """Add the closest cell of the query's leaf, of those with ``keep`` rows if there are any."""
        best = self._meet(queries, keep, bounded=False)
        order = F.struct("_thin", "_gap", "_cell")
        return best.groupBy(*self.names, "_leaf").agg(F.min_by("_cell", order).alias("_cell"))

    def within(self, queries: DataFrame) -> DataFrame:
        """A row for each cell of the query's leaf that may hold a row closer than ``_bound``."""
        return self._meet(queries, 0, bounded=True).select(*self.names, *PLACE)

    def _meet(self, queries: DataFrame, keep: int, bounded: bool) -> DataFrame:
        names, width, numeric = self.names, self._width, self.numeric
        axis_names = [f"a{i}" for i in range(width)]
        # Two counts per leaf of the first level, which has a bounded number of them.
        plan = F.broadcast(
            self.cells.groupBy("_leaf").agg(F.ceil(F.count(F.lit(1)) / self.group_rows).alias("_subs"))
            .join(queries.groupBy("_leaf").agg(F.ceil(F.count(F.lit(1)) / self.group_queries).alias("_chunks")), "_leaf")
        )
        left = (
            self.cells.join(plan, "_leaf").withColumn("_sub", part_of(["_cell"], F.col("_subs")))
            .withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.col("_chunks").cast("int") - 1)))
            .drop("_subs", "_chunks")
        )
        bound = [F.col("_bound")] if bounded else []
        right = (
            queries.select(*names, "_leaf", *bound, *self._axes).join(plan, "_leaf")
            .withColumn("_chunk", part_of(names, F.col("_chunks")))
            .withColumn("_sub", F.explode(F.sequence(F.lit(0), F.col("_subs").cast("int") - 1)))
            .drop("_subs", "_chunks")
        )
        fields = [queries.schema[n] for n in names]
        schema = T.StructType([
            *fields, T.StructField("_leaf", T.IntegerType()), T.StructField("_cell", T.LongType()),
            T.StructField("_gap", T.DoubleType()), T.StructField("_thin", T.BooleanType()),
        ])
        arrow_schema = to_arrow_schema(schema)

        def meet(cells: pa.Table, asked: pa.Table) -> pa.Table:
            if not cells.num_rows or not asked.num_rows:
                return arrow_schema.empty_table()
            low = np.column_stack([cells[f"l{i}"].to_numpy().astype(float) for i in range(width)])
            high = np.column_stack([cells[f"h{i}"].to_numpy().astype(float) for i in range(width)])
            number, rows = cells["_cell"].to_numpy(), cells["_rows"].to_numpy()
            boxes = LeafBoxes(low, high, rows, numeric)
            points = np.column_stack([asked[a].to_numpy().astype(float) for a in axis_names])
            found = []
            for start, stop in batches(len(points), len(number)):
                gaps = boxes.gaps(points[start:stop], low, high)
                if bounded:
                    reach = asked["_bound"].to_numpy()[start:stop, None] + SLACK
                    q, c = np.nonzero(gaps <= reach)
                else:
                    thin = rows < keep
                    q = np.arange(stop - start)
                    c = np.argmin(gaps + np.where(thin & ~thin.all(), np.inf, 0.0), axis=1)
                found.append((q + start, c, gaps[q, c]))
            q, c, gap = (np.concatenate(part) for part in zip(*found))
            out = asked.select([*names, "_leaf"]).take(pa.array(q))
            out = out.append_column("_cell", pa.array(number[c])).append_column("_gap", pa.array(gap))
            return out.append_column("_thin", pa.array(rows[c] < keep)).cast(arrow_schema)

        group = ["_leaf", "_sub", "_chunk"]
        return left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(meet, schema)
