"""The row-local part of detection on a stream.

Cleaning of cells, rule checks and scoring with a saved model look at one row
at a time, so the batch operators take a streaming DataFrame as it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from cellsift.operators.forest import IsolationForest
from cellsift.operators.normalize import blanks_to_null, coerce_types
from cellsift.operators.rules import rule_issues
from cellsift.spec import QualitySpec


def issue_stream(stream: DataFrame, spec: QualitySpec) -> DataFrame:
    """Rule findings of a stream of raw rows."""
    return rule_issues(coerce_types(blanks_to_null(stream), spec), spec)


def score_stream(stream: DataFrame, spec: QualitySpec, model: IsolationForest) -> DataFrame:
    """Rows of a stream with the scores of a model fitted in a batch job."""
    return model.with_scores(coerce_types(blanks_to_null(stream), spec))


def write_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything that has arrived to a Parquet folder, then stop."""
    return (
        stream.writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).outputMode("append")
        .trigger(availableNow=True).start()
    )
