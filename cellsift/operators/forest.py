"""Isolation forest: trees grow on executors, scoring is one vectorised pass.

Every tree is grown from a small random sample of the clean rows, so training
touches a bounded number of rows whatever the table size. The grown nodes are
the whole model: at most trees x (2 x sample - 1) rows.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellsift.operators.features import FittedFeatures, NumericStats
from cellsift.operators.ranking import exact_quantiles
from cellsift.spec import QualitySpec

EULER_GAMMA = 0.5772156649015329
NODE_SCHEMA = (
    "tree int, node int, feature int, threshold double, category string, "
    "left int, right int, rows int, depth int"
)
# The pool that trees draw from holds this many times the rows they need.
POOL_FACTOR = 2
BLOCK_ROWS = 4096


def expected_path(n):
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    out[n == 2] = 1.0
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    return out


def _grow_tree(rows: pd.DataFrame, tree: int, z_names, c_names, seed: int) -> pd.DataFrame:
    """Split at random until rows are alone, alike or deep enough."""
    rng = np.random.default_rng([seed, tree])
    numbers = rows[z_names].to_numpy(dtype=float)
    texts = rows[c_names].to_numpy(dtype=object)
    limit = max(1, math.ceil(math.log2(max(2, len(rows)))))
    nodes: list[list] = []
    todo = [(np.arange(len(rows)), 0, None, None)]
    while todo:
        here, depth, parent, side = todo.pop()
        number = len(nodes)
        nodes.append([tree, number, -1, None, None, -1, -1, len(here), depth])
        if parent is not None:
            nodes[parent][side] = number
        if depth >= limit or len(here) < 2:
            continue
        block = numbers[here]
        low, high = block.min(axis=0), block.max(axis=0)
        choices: list[tuple] = [(i, None) for i in np.flatnonzero(high > low)]
        for j in range(len(c_names)):
            seen = sorted(set(texts[here, j]))
            if len(seen) > 1:
                # Every category is a feature of its own: equal or not.
                choices += [(len(z_names) + j, value) for value in seen]
        if not choices:
            continue
        feature, category = choices[rng.integers(len(choices))]
        if category is None:
            cut = rng.uniform(low[feature], high[feature])
            goes_left = block[:, feature] <= cut
            nodes[number][2:4] = [int(feature), float(cut)]
        else:
            goes_left = texts[here, feature - len(z_names)] != category
            nodes[number][2] = int(feature)
            nodes[number][4] = category
        todo.append((here[~goes_left], depth + 1, number, 6))
        todo.append((here[goes_left], depth + 1, number, 5))
    return pd.DataFrame(
        nodes,
        columns=["tree", "node", "feature", "threshold", "category", "left", "right", "rows", "depth"],
    )


class ScoringForest:
    """Nodes of all trees as flat arrays; a leaf points to itself."""

    def __init__(self, nodes: pd.DataFrame, z_count: int, c_count: int, sample_rows: int):
        nodes = nodes.sort_values(["tree", "node"], ignore_index=True)
        sizes = nodes.groupby("tree").size()
        offset = nodes["tree"].map(sizes.cumsum().shift(fill_value=0)).to_numpy()
        own = np.arange(len(nodes))
        leaf = nodes["feature"].to_numpy() < 0
        self.roots = np.flatnonzero(nodes["node"].to_numpy() == 0)
        left = np.where(leaf, own, nodes["left"].to_numpy() + offset)
        right = np.where(leaf, own, nodes["right"].to_numpy() + offset)
        self.child = np.column_stack([left, right]).ravel()
        self.feature = np.where(leaf, 0, nodes["feature"].to_numpy())
        self.depth = int(nodes["depth"].max()) if len(nodes) else 0
        self.path = nodes["depth"].to_numpy() + expected_path(nodes["rows"].to_numpy())
        self.scale = float(expected_path([sample_rows])[0]) or 1.0
        # A row goes right if its value is in (low, high]: above the cut of a
        # number, or at the code of a category.
        is_text = nodes["category"].notna().to_numpy()
        low = np.nan_to_num(nodes["threshold"].to_numpy(dtype=float))
        high = np.full(len(nodes), np.inf)
        self.codes = []
        for j in range(c_count):
            used = is_text & (self.feature == z_count + j)
            values = sorted(set(nodes.loc[used, "category"]))
            self.codes.append(values)
            code = pd.Categorical(nodes.loc[used, "category"], categories=values).codes
            low[used], high[used] = code - 0.5, code + 0.5
        self.low, self.high = low, high

    def score(self, numbers: list[pd.Series], texts: list[pd.Series]) -> np.ndarray:
        """Minus two to the minus relative mean path: lower is more abnormal."""
        columns = [n.to_numpy(dtype=float) for n in numbers]
        columns += [
            pd.Categorical(t, categories=values).codes.astype(float)
            for t, values in zip(texts, self.codes)
        ]
        points = np.column_stack(columns)
        total = np.zeros(len(points))
        for start in range(0, len(points), BLOCK_ROWS):
            block = points[start : start + BLOCK_ROWS]
            total[start : start + BLOCK_ROWS] = self._path_sum(block)
        return -np.exp2(-total / (max(1, len(self.roots)) * self.scale))

    def _path_sum(self, points: np.ndarray) -> np.ndarray:
        """Path lengths over all trees; blocks are small enough to stay in cache."""
        cells_flat = points.ravel()
        first = np.arange(len(points)) * points.shape[1]
        total = np.zeros(len(points))
        for root in self.roots:
            node = np.full(len(points), root)
            for _ in range(self.depth):
                value = cells_flat.take(first + self.feature.take(node))
                goes_right = (value > self.low.take(node)) & (value <= self.high.take(node))
                node = self.child.take(2 * node + goes_right)
            total += self.path.take(node)
        return total


@dataclass(frozen=True)
class IsolationForest:
    features: FittedFeatures
    nodes: pd.DataFrame
    sample_rows: int
    offset: float | None = None

    def raw_score(self, df: DataFrame) -> Column:
        """Score column for a table that still has its raw columns."""
        z, c = len(self.features.z_names), len(self.features.c_names)
        model = ScoringForest(self.nodes, z, c, self.sample_rows)

        @F.pandas_udf("double")
        def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for columns in batches:
                yield pd.Series(model.score(list(columns[:z]), list(columns[z:])))

        return score(*self.features.columns(df))

    def with_scores(self, df: DataFrame) -> DataFrame:
        """Add ``raw_score`` and, once the offset is known, decision and label."""
        scored = df.withColumn("raw_score", self.raw_score(df))
        return scored if self.offset is None else with_decision(scored, self.offset)

    def with_offset(self, offset: float) -> IsolationForest:
        return IsolationForest(self.features, self.nodes, self.sample_rows, offset)

    def save(self, spark: SparkSession, path: str) -> None:
        """Write model nodes and fitted statistics, to score in another job."""
        meta = {
            "numeric": {k: [s.median, s.mean, s.std] for k, s in self.features.numeric.items()},
            "categorical": self.features.categorical,
            "sample_rows": self.sample_rows,
            "offset": self.offset,
        }
        rows = self.nodes.astype(object).where(self.nodes.notna(), None).values.tolist()
        spark.createDataFrame(rows, NODE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> IsolationForest:
        meta = json.loads(spark.read.parquet(f"{path}/meta").first()["meta"])
        features = FittedFeatures(
            {k: NumericStats(*s) for k, s in meta["numeric"].items()}, meta["categorical"]
        )
        nodes = spark.read.parquet(f"{path}/nodes").toPandas()
        return IsolationForest(features, nodes, meta["sample_rows"], meta["offset"])


def with_decision(scored: DataFrame, offset: float) -> DataFrame:
    """Decision = raw score minus the cut; below zero is an anomaly."""
    decision = F.col("raw_score") - F.lit(offset)
    return scored.withColumns({"decision_score": decision, "is_anomaly": (decision < 0).cast("int")})


def score_offset(scores: DataFrame, contamination: float, column: str = "raw_score") -> float:
    """Score below which the given share of the fitted rows lies."""
    return exact_quantiles(scores, {column: [contamination]})[column][0]


def draw_samples(
    clean: DataFrame, features: FittedFeatures, id_column: str, trees: int, size: int, seed: int,
    total: int | None = None,
) -> tuple[DataFrame, int]:
    """(tree, features) rows: ``size`` rows for each tree, none twice in a tree."""
    rows = clean.select(F.col(id_column).cast("string").alias("_id"), *features.columns(clean))
    total = rows.count() if total is None else total
    size = min(size, total)
    need = POOL_FACTOR * trees * size
    names = features.names
    if total > need:
        # By the row alone, so that the model does not depend on how rows are laid out.
        place = F.xxhash64(F.lit(seed), F.lit("pool"), "_id", *names) / float(1 << 64) + 0.5
        rows = rows.filter(place < need / total)
    tasks = min(trees, clean.sparkSession.sparkContext.defaultParallelism)
    # Equal rows are told apart by a copy number, so that one of them does not
    # bring all the others along. The pool is small, but hashing it takes long,
    # hence the fixed number of tasks.
    copies = rows.repartition(tasks, "_id", *names).groupBy("_id", *names).count()
    pool = copies.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("count").cast("int")))).drop("count")
    # Every row offers itself to a few trees, so that each tree gets about
    # three times the rows it takes; it takes those with the smallest hashes.
    offers = math.ceil(trees * (3.0 * size + 64) / max(1, min(total, need)))
    if offers * 2 >= trees:
        asked = F.sequence(F.lit(0), F.lit(trees - 1))
    else:
        pick = lambda i: F.pmod(F.xxhash64("_row", i), F.lit(trees)).cast("int")
        asked = F.array_distinct(F.array(*[pick(F.lit(i)) for i in range(offers)]))
    offered = pool.withColumn("_row", F.xxhash64(F.lit(seed), "_id", "_copy", *names)).select(
        "*", F.explode(asked).alias("tree")
    )
    first = Window.partitionBy("tree").orderBy(F.xxhash64("_row", "tree", F.lit(seed)), "_row")
    ranked = offered.withColumn("_place", F.row_number().over(first)).filter(F.col("_place") <= size)
    return ranked.select("tree", "_place", *names), size


def fit_forest(
    clean: DataFrame, features: FittedFeatures, spec: QualitySpec, rows: int | None = None
) -> IsolationForest:
    """Grow all trees on executors; the nodes, a bounded table, come back."""
    z_names, c_names = features.z_names, features.c_names
    seed = spec.random_state
    samples, size = draw_samples(
        clean, features, spec.id_column, spec.n_estimators, spec.max_samples, seed, rows
    )

    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        ordered = rows.sort_values("_place", ignore_index=True)
        return _grow_tree(ordered, int(rows["tree"].iloc[0]), z_names, c_names, seed)

    # A fixed number of partitions: the rows are few, but growing takes long.
    tasks = min(spec.n_estimators, clean.sparkSession.sparkContext.defaultParallelism)
    nodes = samples.repartition(tasks, "tree").groupBy("tree").applyInPandas(grow, NODE_SCHEMA).toPandas()
    return IsolationForest(features, nodes, size)
