"""Write accepted suggestions back into the table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellsift.functions import cells
from cellsift.operators.bloom import IdFilter, id_key
from cellsift.sources.scratch import cut_lineage, drop_written
from cellsift.spec import QualitySpec, SpecError

MODES = ("conservative", "auto", "approved")


def accepted_fixes(
    issues: DataFrame, spec: QualitySpec, mode: str = "conservative", approvals: DataFrame | None = None
) -> DataFrame:
    """Fixable issues that have a suggestion and that the mode lets through.

    ``approved`` takes a table (issue_id, approved) in place of a prompt.
    """
    if mode not in MODES:
        raise SpecError(f"Unknown mode: {mode}")
    fixes = issues.filter("can_auto_fix AND suggested_value IS NOT NULL")
    if mode == "conservative":
        return fixes.filter(F.col("confidence") >= spec.conservative_confidence_threshold)
    if mode == "approved":
        if approvals is None:
            raise SpecError("mode 'approved' needs an approvals table")
        return fixes.join(approvals.filter("approved").select("issue_id"), "issue_id", "left_semi")
    return fixes


def apply_fixes(
    df: DataFrame,
    issues: DataFrame,
    spec: QualitySpec,
    mode: str = "conservative",
    approvals: DataFrame | None = None,
    rederive=None,
    kept: list[str] | None = None,
) -> DataFrame:
    """The table with accepted fixes; the last fix of a cell in issue order wins.

    All rows that share an id are changed. Only rows that a filter of the repaired
    ids hits are joined with their fixes, all others pass as they are. Derived columns keep their value
    unless ``rederive``, a function of the table, computes them again.
    """
    fixes = accepted_fixes(issues, spec, mode, approvals).filter("row_id IS NOT NULL")
    order = F.struct("issue_seq", "reason", "suggested_value", "suggested_num")
    per_row = fixes.groupBy("row_id").agg(
        *[
            F.max(F.when(F.col("column_name") == c, order)).alias(f"_fix__{c}")
            for c in df.columns
        ]
    )
    # One row for each repaired id, written as the filter and the join both read it.
    per_row = cut_lineage(per_row.withColumn("_row", id_key(F.col("row_id"))).drop("row_id"), "fixes", kept)
    repaired = IdFilter(per_row.select("_row"))
    marked = repaired.marked(df, id_key(F.col(f"`{spec.id_column}`")), "_hit")
    untouched = marked.filter(~F.col("_hit")).drop("_hit")
    hit = marked.filter("_hit").drop("_hit")
    joined = hit.join(per_row, id_key(F.col(f"`{spec.id_column}`")) == F.col("_row"), "left")
    out = []
    for f in df.schema.fields:
        fix = F.col(f"_fix__{f.name}")
        if cells.is_text(f.dataType):
            new = fix["suggested_value"]
        else:
            number = F.coalesce(fix["suggested_num"], fix["suggested_value"].try_cast("double"))
            new = number.try_cast(f.dataType) if _takes_number(f) else F.lit(None).cast(f.dataType)
        out.append(F.coalesce(new, F.col(f"`{f.name}`")).alias(f.name))
    fixed = untouched.unionByName(joined.select(*out))
    return rederive(fixed) if rederive else fixed


def repair_in_place(
    spark: SparkSession,
    path: str,
    partitions: list[str],
    issues: DataFrame,
    spec: QualitySpec,
    mode: str = "conservative",
    approvals: DataFrame | None = None,
    rederive=None,
    schema: T.StructType | None = None,
) -> int:
    """Repair a table of Parquet files stored by ``partitions``; returns how many were rewritten.

    Only partitions with a row that has an accepted fix are read and replaced; the
    files of all others stay as they are. The repaired rows are first written to
    the scratch folder, so that a job that is lost while it replaces partitions
    can be run again from there. A fix of a partition column, or a
    ``rederive`` that changes one, would move rows and is refused before anything
    is replaced. ``schema`` spares the types of partition columns being guessed.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df, kept = reader.parquet(path), []
    fixes = cut_lineage(accepted_fixes(issues, spec, mode, approvals).filter("row_id IS NOT NULL"), "accepted", kept)
    moved = fixes.filter(F.col("column_name").isin(list(partitions)))
    if not moved.isEmpty():
        raise SpecError(f"Fixes of partition columns move rows: {partitions}")
    place = F.array(*[id_key(F.col(f"`{c}`")) for c in partitions])
    own = id_key(F.col(f"`{spec.id_column}`"))
    ids = cut_lineage(fixes.select(id_key(F.col("row_id")).alias("_row")).distinct(), "fixed_ids", kept)
    seen = IdFilter(ids).marked(df.select(own.alias("_row"), place.alias("_place")), F.col("_row"), "_hit")
    # Partitions only, which the driver lists anyway to plan the scan.
    touched = sorted(r[0] for r in seen.filter("_hit").join(ids, "_row", "left_semi").select("_place").distinct().collect())
    if touched:
        among = place.isin([F.array(*[F.lit(v) for v in values]) for values in touched])
        fixed = apply_fixes(df.filter(among), fixes, spec, mode, approvals, rederive, kept)
        fixed = cut_lineage(fixed, "repaired_partitions", kept)
        if sorted(r[0] for r in fixed.select(place.alias("_place")).distinct().collect()) != touched:
            raise SpecError(f"Repairs changed partition columns: {partitions}")
        # Small parts of a partition are put together, large ones are split.
        whole = fixed.hint("rebalance", *partitions)
        whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)
    drop_written(spark, kept)
    return len(touched)


def _takes_number(field) -> bool:
    return isinstance(field.dataType, (T.NumericType, T.BooleanType))
