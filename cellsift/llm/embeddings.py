"""Near-duplicate vectors: an exact range join in a metric space.

Unit vectors with cosine >= c lie within ``r = sqrt(2 - 2c)`` of each other. In
each group (equal label and length) some vectors are pivots. A vector's home is
the cell of its nearest pivot. By the triangle inequality a vector within r of
x, at home in cell j, has its pivot at most ``d(x, own pivot) + 2r`` from x; in
Euclidean space also ``(d(x, pj)^2 - d(x, own)^2) / (2 d(pj, own)) <= r``. So x
visits the cells that pass both, and each cell joins on its own. Of two cells
only one receives the other's visitors, thus every pair meets exactly once.

Equal vectors are one row with a count. Links are counted in blocks of a cell
and leave it as counts and as a spanning forest, never as all pairs. Large cells
are split into pairs of blocks, so no task grows with a cell.
"""

from __future__ import annotations

from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsift.llm.components import components, join_labels
from cellsift.operators.keyed import join_keyed
from cellsift.sources.scratch import cut_lineage

COSINE = 0.98
#: Vectors of a cell, on average, and most pivots of a group.
CELL_ROWS = 2000
MAX_PIVOTS = 256
#: Vectors of a block of a cell, and of a task that looks for the nearest pivots.
BLOCK_ROWS = 4096
CHUNK_ROWS = 20_000

GROUP = ["label", "dim"]
ASSIGNED = "label string, dim int, cell int, home boolean, rep long, copies long, embedding array<double>"


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    """Unit vectors, one per row."""
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    flat = flat / np.abs(flat).max(axis=1, keepdims=True)
    return flat / np.sqrt((flat * flat).sum(axis=1, keepdims=True))


def _usable() -> F.Column:
    """Not null, all components finite, not zero throughout."""
    inf = float("inf")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))
    return F.coalesce(F.col("label").isNotNull() & finite & F.exists("embedding", lambda x: x != 0), F.lit(False))


def _assign(radius: float):
    def assign(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        """Home and visited cells of the vectors of one chunk of a group."""
        dim = key[1].as_py()
        if left.num_rows == 0:
            return pa.table({n: [] for n in ("label", "dim", "cell", "home", "rep", "copies", "embedding")})
        right = right.sort_by("p_rep")
        x = _matrix(left.column("embedding"), dim)
        if right.num_rows < 2:
            row, cell = np.arange(len(x)), np.zeros(len(x), dtype=np.int64)
            home = np.ones(len(x), dtype=bool)
        else:
            p = _matrix(right.column("p_embedding"), dim)
            d = np.sqrt(np.maximum(2 - 2 * (x @ p.T), 0))
            near = d.argmin(axis=1)
            own = d[np.arange(len(x)), near][:, None]
            between = np.sqrt(np.maximum(2 - 2 * (p @ p.T), 0))[near]
            visit = (d <= own + 2 * radius) & (d * d - own * own <= 2 * radius * between + 1e-9)
            number = np.arange(len(p))[None, :]
            lower = number < near[:, None]
            visit &= ((number + near[:, None]) % 2 == 0) == lower
            visit[np.arange(len(x)), near] = True
            row, cell = np.nonzero(visit)
            home = cell == near[row]
        taken = left.take(pa.array(row))
        return pa.table(
            {
                "label": taken.column("label"),
                "dim": taken.column("dim"),
                "cell": pa.array(cell, pa.int32()),
                "home": pa.array(home),
                "rep": taken.column("rep"),
                "copies": taken.column("copies"),
                "embedding": taken.column("embedding"),
            }
        )

    return assign


def _join(cosine: float):
    def join(key: tuple, rows: pa.Table) -> pa.Table:
        """Counts and forest of one pair of blocks: sides 0 and 1, or 0 with itself."""
        side = rows.column("side").to_numpy()
        rep, copies = rows.column("rep").to_numpy(), rows.column("copies").to_numpy()
        x = _matrix(rows.column("embedding"), key[1].as_py())
        alone = key[3].as_py() == "same"
        left = np.flatnonzero(side == 0)
        right = left if alone else np.flatnonzero(side == 1)
        links = np.zeros(len(rep), dtype=np.int64)
        parent = np.arange(len(rep))
        step = max(1, (4 << 20) // max(1, len(right)))
        for begin in range(0, len(left), step):
            some = left[begin : begin + step]
            i, j = np.nonzero(x[some] @ x[right].T >= cosine)
            i, j = some[i], right[j]
            if alone:
                i, j = i[i < j], j[i < j]
            links += np.bincount(i, copies[j], len(rep)).astype(np.int64)
            links += np.bincount(j, copies[i], len(rep)).astype(np.int64)
            parent = join_labels(parent, i, j)
        some = np.flatnonzero(links)
        # The root of a set is its least position.
        return pa.table({"a": rep[some], "b": rep[parent[some]], "n": links[some]})

    return join


def near_duplicates(
    vectors: DataFrame,
    kept: list[str],
    *,
    cosine: float = COSINE,
    cell_rows: int = CELL_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Links and component of each vector: ``(vec_id, n_links, component_id, kept)``.

    ``vectors`` needs ``vec_id``, ``embedding`` and ``label``; more columns are
    ignored. Vectors of equal label and length are compared in double precision.
    Vectors that are null, zero, of no length, or hold null or non-finite
    components, and those without a label, link with nothing and are their own
    component. A null ``vec_id`` is counted by others but is no component's id:
    a component of such rows only has a null id and keeps none of them. Rows that
    repeat a ``vec_id`` count as vectors of their own in ``n_links``, each with the
    links of its own vector; labels of any type are compared by their text.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    rows = rows.withColumn("usable", _usable())
    # 128 bits name a vector of a label; equal vectors are one from here on.
    name = [F.xxhash64("label", "embedding").alias("k1"), F.xxhash64(F.lit(7), "embedding", "label").alias("k2")]
    usable = rows.where("usable").select("vec_id", "label", "embedding", *name)
    reps = usable.groupBy("k1", "k2").agg(
        F.min("vec_id").alias("vec_id"),
        F.count("*").alias("copies"),
        F.first("label").alias("label"),
        F.first("embedding").alias("embedding"),
    )
    # A number of its own for each vector, fixed once it is written: an id may stand for several.
    reps = reps.withColumns({"rep": F.monotonically_increasing_id(), "dim": F.size("embedding")})
    reps = cut_lineage(reps, "vectors", kept)

    sizes = reps.groupBy(*GROUP).agg(F.count("*").alias("n"), F.min(F.struct(F.xxhash64("rep"), "rep")).alias("least"))
    sizes = sizes.select(
        *GROUP,
        F.col("least.rep").alias("least"),
        F.least(F.lit(float(MAX_PIVOTS)), F.ceil(F.col("n") / cell_rows)).alias("pivots"),
        F.col("n"),
        F.ceil(F.col("n") / CHUNK_ROWS).cast("int").alias("chunks"),
    )
    wide = reps.select("rep", *GROUP, "copies", "embedding").join(sizes, GROUP)
    # The lowest hashes are pivots: as many as wanted on average, one at least.
    share = (F.xxhash64("rep") / float(1 << 64) + 0.5) < F.col("pivots") / F.col("n")
    pivots = wide.where((F.col("rep") == F.col("least")) | (share & (F.col("pivots") > 1)))
    pivots = pivots.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    pivots = pivots.select(*(F.col(c).alias(f"p_{c}") for c in (*GROUP, "chunk", "rep", "embedding")))
    wide = wide.withColumn("chunk", F.pmod(F.xxhash64(F.lit(1), "rep"), "chunks").cast("int"))
    wide = wide.select(*GROUP, "chunk", "rep", "copies", "embedding")
    radius = sqrt(max(0.0, 2 - 2 * cosine)) + 1e-9
    keys = [*GROUP, "chunk"]
    cells = wide.groupBy(*keys).cogroup(pivots.groupBy(*(f"p_{c}" for c in keys))).applyInArrow(_assign(radius), ASSIGNED)
    cells = cut_lineage(cells, "cells", kept)

    counts = cells.groupBy(*GROUP, "cell").agg(
        F.ceil(F.count_if("home") / block_rows).cast("int").alias("homes"),
        F.ceil(F.count_if(~F.col("home")) / block_rows).cast("int").alias("visits"),
    )
    sized = cells.join(counts, [*GROUP, "cell"])
    blocks = F.when(F.col("home"), F.col("homes")).otherwise(F.col("visits"))
    sized = sized.withColumn("block", F.pmod(F.xxhash64(F.lit(2), "rep"), blocks).cast("int"))
    task = "struct<kind:string,i:int,j:int,side:int>"

    def all_of(n: str, f) -> F.Column:
        numbers = F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(numbers, lambda x: f(x).cast(task))

    mine = F.col("block")
    with_homes = all_of(
        "homes",
        lambda x: F.struct(
            F.when(x == mine, "same").otherwise("home"),
            F.least(x, mine),
            F.greatest(x, mine),
            F.when(x < mine, 1).otherwise(0),
        ),
    )
    with_visits = all_of("visits", lambda x: F.struct(F.lit("visit"), mine, x, F.lit(0)))
    visiting = all_of("homes", lambda x: F.struct(F.lit("visit"), x, mine, F.lit(1)))
    tasks = F.when(F.col("home"), F.concat(with_homes, with_visits)).otherwise(visiting)
    sized = sized.withColumn("task", F.explode(tasks)).select(*GROUP, "cell", "task.*", "rep", "copies", "embedding")
    join = _join(cosine)

    def ordered(key: tuple, rows: pa.Table) -> pa.Table:
        return join(key, rows.sort_by("rep"))

    found = sized.groupBy(*GROUP, "cell", "kind", "i", "j").applyInArrow(ordered, "a long, b long, n long")
    found = cut_lineage(found, "links", kept)
    roots = components(found.select("a", "b"), kept)
    links = found.groupBy("a").agg(F.sum("n").alias("n"))
    reps = reps.select("k1", "k2", "rep", "vec_id", "copies")
    reps = reps.join(links, reps["rep"] == links["a"], "left").join(roots, F.col("rep") == roots["id"], "left")
    reps = reps.select(
        "k1", "k2", "vec_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("root", "rep").alias("root")
    )
    reps = cut_lineage(reps, "linked", kept)
    # The least id of a component; it may hold any share of the vectors.
    named = reps.groupBy("root").agg(F.min("vec_id").alias("component_id"), F.count("*").alias("size"))
    named = cut_lineage(named, "components", kept)
    reps = join_keyed(reps, named, "root", "size").select("k1", "k2", "n", "component_id")
    out = usable.select("vec_id", "k1", "k2").join(reps, ["k1", "k2"])
    out = out.select("vec_id", F.col("n").alias("n_links"), "component_id")
    rest = rows.where("not usable").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    out = out.union(rest)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
