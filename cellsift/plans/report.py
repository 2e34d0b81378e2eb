"""Summary, recommendation view and column profile."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellsift.functions import cells

RECOMMENDATION_COLUMNS = (
    "issue_id", "row_id", "column_name", "issue_type", "current_value", "suggested_value",
    "confidence", "severity", "reason", "can_auto_fix",
)


def recommendations(issues: DataFrame) -> DataFrame:
    return issues.select(*RECOMMENDATION_COLUMNS)


def issue_summary(issues: DataFrame) -> DataFrame:
    """(metric, value) table from one pass over the issues.

    The pass groups by type and severity, which leaves a dozen rows. These are
    packed into one row, and all metrics come from it. Without issues only the
    total of 0 remains.
    """
    cube = issues.groupBy("issue_type", "severity").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("confidence").alias("confidence"),
        F.count("confidence").alias("rated"),
        F.sum(F.col("can_auto_fix").cast("int")).alias("fixable"),
    )
    # A total without groups has a row even if there is no issue.
    whole = cube.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias("n"),
        F.round(F.try_divide(F.sum("confidence"), F.sum("rated")), 4).alias("confidence"),
        F.round(F.try_divide(F.sum("fixable"), F.sum("n")), 4).alias("fixable"),
        F.collect_list(F.struct("issue_type", "severity", F.col("n").cast("double").alias("n"))).alias("groups"),
    )

    def metric(block: int, name, value):
        return F.struct(F.lit(block).alias("block"), name.alias("metric"), value.alias("value"))

    grand = F.array(
        metric(0, F.lit("total_issues"), F.col("n")),
        metric(3, F.lit("average_confidence"), F.col("confidence")),
        metric(4, F.lit("fixable_rate"), F.col("fixable")),
    )
    by_type = F.transform("groups", lambda g: metric(1, F.concat(F.lit("issue_type_"), g["issue_type"]), g["n"]))
    by_severity = F.transform("groups", lambda g: metric(2, F.concat(F.lit("severity_"), g["severity"]), g["n"]))
    return (
        whole.select(F.inline(F.concat(grand, by_type, by_severity)))
        .groupBy("block", "metric").agg(F.sum("value").alias("value"))
        .filter("value IS NOT NULL AND metric IS NOT NULL")
        .orderBy("block", F.desc("value"), "metric")
        .select("metric", "value")
    )


def _numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.NumericType, T.BooleanType))


def _cell(f: T.StructField):
    c = F.col(f"`{f.name}`")
    return cells.nan_to_null(c) if isinstance(f.dataType, cells.FLOAT_TYPES) else c


def _measures(total, present, distinct, low, high) -> list:
    return [
        F.coalesce(total - present, F.lit(0)).cast("long").alias("missing_count"),
        F.coalesce(F.round(F.try_divide(total - present, total), 4), F.lit(0.0)).alias("missing_rate"),
        distinct.cast("long").alias("unique_count"),
        low.cast("double").alias("min"),
        high.cast("double").alias("max"),
    ]


def _measured_column(df: DataFrame, place: int, f: T.StructField, approx_unique: bool) -> DataFrame:
    """One row of figures; exact ones come from the groups of equal cells.

    The groups hold each value once with its number of rows, so gaps, distinct
    values and range need no second look at the rows.
    """
    null, name = F.lit(None), [F.lit(place).alias("_place"), F.lit(f.name).alias("column_name")]
    grouped = not (approx_unique or isinstance(f.dataType, T.MapType))
    if grouped:
        rows = df.groupBy(_cell(f).alias("v")).agg(F.count(F.lit(1)).alias("n"))
        total, present, distinct = F.sum("n"), F.coalesce(F.sum(F.expr("if(v IS NULL, 0L, n)")), F.lit(0)), F.count("v")
    else:
        rows = df.select(_cell(f).alias("v"))
        total, present = F.count(F.lit(1)), F.count("v")
        distinct = null if isinstance(f.dataType, T.MapType) else F.approx_count_distinct("v")
    low, high = (F.min("v"), F.max("v")) if _numeric(f.dataType) else (null, null)
    return rows.agg(*_measures(total, present, distinct, low, high)).select(*name, "*")


def column_profile(
    df: DataFrame, issues: DataFrame, approx_unique: bool = False, columns: Sequence[str] | None = None
) -> DataFrame:
    """One row per column: gaps, distinct values, range and issue counts.

    Every column is grouped by itself: the scan of a column reads that column
    alone, equal cells are combined before the shuffle, and rows are never
    multiplied by the number of columns. A table in a row format is read once
    per column; write it in a columnar one first. Maps have no distinct count.
    An empty table has gaps, rates and distinct counts of 0.
    """
    places = {f.name: (i, f) for i, f in enumerate(df.schema.fields) if columns is None or f.name in columns}
    measured = reduce(
        DataFrame.unionByName, [_measured_column(df, i, f, approx_unique) for i, f in places.values()]
    )
    counts = issues.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("issue_count"),
        F.count_if(F.col("issue_type") == "anomaly").alias("anomaly_count"),
        F.count_if(F.col("issue_type") == "invalid").alias("invalid_count"),
    )
    # Both sides have one row per column of the table.
    return (
        measured.join(F.broadcast(counts), "column_name", "left")
        .fillna(0, ["issue_count", "anomaly_count", "invalid_count"])
        .orderBy("_place")
        .drop("_place")
    )
