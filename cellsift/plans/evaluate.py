"""Compare detected issues with known faults."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ISSUE_KEYS = ("row_id", "column_name", "issue_type")


def confusion(truth: DataFrame, detected: DataFrame, keys: Sequence[str] = ISSUE_KEYS, by: str | None = None) -> DataFrame:
    """tp, fp and fn, overall or per value of a key.

    Both tables are stacked and counted per key, so duplicates collapse before
    the one shuffle and no join is needed.
    """
    sides = truth.select(*keys, F.lit(True).alias("_true"), F.lit(False).alias("_found")).unionByName(
        detected.select(*keys, F.lit(False).alias("_true"), F.lit(True).alias("_found"))
    )
    merged = sides.groupBy(*keys).agg(F.max("_true").alias("t"), F.max("_found").alias("d"))
    grouped = merged.groupBy(by) if by else merged.groupBy()
    return grouped.agg(
        F.count_if(F.col("t") & F.col("d")).alias("tp"),
        F.count_if(~F.col("t") & F.col("d")).alias("fp"),
        F.count_if(F.col("t") & ~F.col("d")).alias("fn"),
    )


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def with_rates(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 of tp, fp and fn; 0 where undefined."""
    rates = counts.withColumns(
        {
            "precision": _zero(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))),
            "recall": _zero(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))),
        }
    )
    p, r = F.col("precision"), F.col("recall")
    return rates.withColumn("f1_score", _zero(F.try_divide(2 * p * r, p + r))).withColumns(
        {c: F.round(F.col(c), 4) for c in ("precision", "recall")} | {"f1_score": F.round(F.col("f1_score"), 4)}
    )


# Metric names of the overall block.
OVERALL_NAMES = {"tp": "true_positive", "fp": "false_positive", "fn": "false_negative"}
_MEASURES = ("tp", "fp", "fn", "precision", "recall", "f1_score")


def evaluation_report(truth: DataFrame, detected: DataFrame) -> DataFrame:
    """(metric, value): the overall block, then one block per issue type."""
    by_type = confusion(truth, detected, by="issue_type")
    # A handful of rows, one per issue type: all blocks come from them.
    counts = by_type.rollup("issue_type").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tp", "fp", "fn")])
    rated = with_rates(counts)
    overall = F.col("issue_type").isNull()
    entries = F.array(
        *[
            F.struct(
                F.lit(i).alias("_place"),
                F.when(overall, F.lit(OVERALL_NAMES.get(m, m)))
                .otherwise(F.concat(F.col("issue_type"), F.lit(f"_{m}")))
                .alias("metric"),
                F.col(m).cast("double").alias("value"),
            )
            for i, m in enumerate(_MEASURES)
        ]
    )
    return (
        rated.select("issue_type", F.inline(entries))
        .orderBy(F.col("issue_type").asc_nulls_first(), "_place")
        .select("metric", "value")
    )
