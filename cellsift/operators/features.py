"""Features for anomaly scores and neighbour distances, fitted once per table.

A feature is a z-score or a category. Categories are never expanded into
vectors: two rows with different known categories are 2 apart in squared
one-hot distance, a category unknown at fit time is 1 apart from any known one.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellsift.functions import cells
from cellsift.operators.ranking import most_frequent, quantiles_and
from cellsift.spec import QualitySpec


@dataclass(frozen=True)
class NumericStats:
    median: float
    mean: float
    std: float

    @property
    def scale(self) -> float:
        return self.std if self.std else 1.0


@dataclass(frozen=True)
class FittedFeatures:
    numeric: dict[str, NumericStats]
    categorical: dict[str, str]

    @property
    def z_names(self) -> list[str]:
        return [f"z__{c}" for c in self.numeric]

    @property
    def c_names(self) -> list[str]:
        return [f"c__{c}" for c in self.categorical]

    @property
    def names(self) -> list[str]:
        return self.z_names + self.c_names

    def without(self, columns: set[str]) -> FittedFeatures:
        return FittedFeatures(
            {c: s for c, s in self.numeric.items() if c not in columns},
            {c: m for c, m in self.categorical.items() if c not in columns},
        )

    def columns(self, df: DataFrame) -> list[Column]:
        """Feature columns of a table, gaps filled from the fitted table."""
        out = []
        for name, stats in self.numeric.items():
            x = cells.to_number(F.col(name), df.schema[name].dataType)
            filled = F.coalesce(x, F.lit(stats.median))
            out.append(((filled - F.lit(stats.mean)) / F.lit(stats.scale)).alias(f"z__{name}"))
        for name, mode in self.categorical.items():
            out.append(F.coalesce(F.col(name).cast("string"), F.lit(mode)).alias(f"c__{name}"))
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """The table with one extra column per feature."""
        return df.select("*", *self.columns(df))

    def stats_table(self, spark) -> DataFrame:
        """One row per feature: a small report of what was fitted."""
        rows = [(c, "numeric", s.median, s.mean, s.std, None) for c, s in self.numeric.items()]
        rows += [(c, "categorical", None, None, None, m) for c, m in self.categorical.items()]
        return spark.createDataFrame(
            rows, "column_name string, kind string, median double, mean double, std double, mode string"
        )


@dataclass(frozen=True)
class PreparedFeatures:
    """Feature columns that a table has already."""

    z_names: list[str]
    c_names: list[str]

    @property
    def names(self) -> list[str]:
        return self.z_names + self.c_names

    def columns(self, df: DataFrame) -> list[Column]:
        return [F.col(n) for n in self.names]


def fit_features(df: DataFrame, spec: QualitySpec) -> FittedFeatures:
    """Median, mean and population deviation per number, mode per category.

    Columns without any value are left out, as an imputer would drop them. The
    scan that sketches the medians also takes the moments of the values there
    are; those of the filled columns follow from them.
    """
    numeric = [c for c in spec.features_of("numeric") if c in df.columns]
    categorical = [c for c in spec.features_of("categorical") if c in df.columns]
    numbers = df.select(*[cells.to_number(F.col(c), df.schema[c].dataType).alias(c) for c in numeric])
    moments = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(numeric):
        moments += [F.count(c).alias(f"n{i}"), F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}")]
    medians, row = quantiles_and(numbers, {c: [0.5] for c in numeric}, moments)
    stats = {}
    for i, c in enumerate(numeric):
        median = medians[c][0]
        if median is None:
            continue
        n, some, mean, std = row["rows"], row[f"n{i}"], row[f"m{i}"], row[f"s{i}"]
        filled = (some * mean + (n - some) * median) / n
        spread = (some * (std * std + (mean - filled) ** 2) + (n - some) * (median - filled) ** 2) / n
        stats[c] = NumericStats(median, filled, std if some == n else sqrt(spread))
    modes = most_frequent(df, categorical)
    return FittedFeatures(stats, {c: modes[c] for c in categorical if modes[c] is not None})


def label_encode(df: DataFrame, column: str, name: str, fitted_on: DataFrame | None = None) -> DataFrame:
    """Code 0..n-1 of a text by its place among the sorted distinct values.

    Null is encoded as the text of a missing value. Values that were not in the
    fitted table make the job fail.
    """
    source = df if fitted_on is None else fitted_on
    text = F.coalesce(F.col(column).cast("string"), F.lit("nan"))
    classes = label_classes(source.select(text.alias("_class")))
    coded = df.withColumn("_text", text).join(
        classes.withColumnRenamed("_code", name), F.col("_text") == F.col("_class"), "left"
    )
    if fitted_on is not None:
        unseen = F.raise_error(F.concat(F.lit("unseen label: "), F.col("_text")))
        coded = coded.withColumn(name, F.coalesce(F.col(name), unseen.cast("long")))
    return coded.drop("_text", "_class")


def label_classes(values: DataFrame) -> DataFrame:
    """Distinct values with their 0-based rank, numbered by partition offsets."""
    from cellsift.operators.ranking import row_positions

    return row_positions(values.distinct(), "_code", ["_class"])
