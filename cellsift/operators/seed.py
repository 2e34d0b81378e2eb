"""Repeatable fault seeding and exact-size sampling.

Rows are taken in the order of a hash of seed and id, so the choice depends on
neither partitioning nor engine. The hash at each wanted rank is found by
counting; after that every row decides for itself and nothing is shuffled. The table
is written once beforehand, so that what it is made from is not computed for every step. Only
equal rows that a rank falls into are numbered, to take as many as are wanted.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellsift.functions import cells
from cellsift.operators.ranking import hash_cuts, hash_order, row_order, row_positions, up_to
from cellsift.sources.scratch import cut_lineage
from cellsift.spec import QualitySpec

# Columns that lose their value, invalid values, outlier factors.
MISSING_COLUMNS = ("domain", "location", "value", "transaction_count")
INVALID_VALUES = {"domain": "UNKNOWN_DOMAIN", "value": -999, "transaction_count": -10}
ANOMALY_FACTORS = {"value": 10, "transaction_count": 1000}

HEX_DIGITS = "0123456789abcdef"


@dataclass(frozen=True)
class FaultPlan:
    missing: Sequence[str] = MISSING_COLUMNS
    invalid: Mapping[str, object] = field(default_factory=lambda: dict(INVALID_VALUES))
    anomaly: Mapping[str, float] = field(default_factory=lambda: dict(ANOMALY_FACTORS))


def sample_exact(df: DataFrame, id_column: str, n: int, seed: int = 42) -> DataFrame:
    """min(n, rows) rows without replacement, the first in hash order.

    Rows that share an id are told apart by the whole row. Of equal rows as many
    are taken as are still wanted.
    """
    order = row_order(seed, F.col(id_column), df.columns)
    (cut,) = hash_cuts(df, order, lambda rows: [min(n, rows)])
    found = df.filter(order <= cut.bound) if cut.bound is not None else df.limit(0)
    if not cut.left:
        return found
    equal = df.filter(order == cut.prefix).limit(1)
    return found.union(equal.withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(cut.left)))).drop("_n"))


def part_sizes(n: int, parts: int = 3) -> list[int]:
    """Near-equal split of n, the remainder going to the first parts."""
    return [n // parts + (1 if i < n % parts else 0) for i in range(parts)]


def _byte_of(text: Column) -> Column:
    digit = lambda i: F.instr(F.lit(HEX_DIGITS), F.substring(text, i, 1)) - 1
    return digit(1) * 16 + digit(2)


def seed_faults(
    df: DataFrame,
    spec: QualitySpec,
    rate: float = 0.2,
    seed: int | None = None,
    plan: FaultPlan | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Dirty table and its labels: a third each of missing, invalid and anomalous cells.

    Derived columns keep the value they had before the fault.
    """
    seed = spec.random_state if seed is None else seed
    plan = plan or FaultPlan()
    df = cut_lineage(df, "unseeded")
    marked = _mark_faults(df, spec.id_column, rate, seed, plan)
    return _dirty_table(marked, df, plan), _labels(marked, spec.id_column, plan)


def _options(df: DataFrame, plan: FaultPlan) -> list[tuple[int, str, int, int, str, object]]:
    """Every fault a row can get: (number, issue type, place, of how many, column, change)."""
    out = []
    kinds = (
        ("missing", [(c, None) for c in plan.missing]),
        ("invalid", list(plan.invalid.items())),
        ("anomaly", list(plan.anomaly.items())),
    )
    for kind, choices in kinds:
        for place, (column, change) in enumerate(choices):
            out.append((len(out), kind, place, len(choices), column, change))
    return [o for o in out if o[4] in df.columns]


def _mark_faults(df: DataFrame, id_column: str, rate: float, seed: int, plan: FaultPlan) -> DataFrame:
    """Add ``_fault``: the number of the fault that a row gets, or null."""
    key = F.col(id_column)
    order, head = row_order(seed, key, df.columns), hash_order(seed, key)

    def ranks(rows: int) -> list[int]:
        a, b, c = part_sizes(math.floor(rows * rate))
        return [a, a + b, a + b + c]

    options = _options(df, plan)
    pick = _byte_of(hash_order(f"col:{seed}", key))
    cuts = list(zip(("missing", "invalid", "anomaly"), hash_cuts(df, order, ranks, head)))

    def number(copy: Column | None = None, crossing: str = "") -> Column:
        """The fault of a row; ``copy`` is its place among the equal rows of the group ``crossing``."""
        out = F.lit(None).cast("int")
        for kind, cut in reversed(cuts):
            mine = [o for o in options if o[1] == kind]
            if not mine:
                continue
            inside = F.lit(False) if cut.bound is None else up_to(cut.bound, order, head)
            if cut.left and cut.prefix == crossing:
                inside = inside | (copy < cut.left)
            by_place = {o[2]: o[0] for o in mine}
            of = mine[0][3]
            numbers = F.array(*[F.lit(by_place.get(i)).cast("int") for i in range(of)])
            chosen = F.element_at(numbers, (pick % of + 1).cast("int"))
            out = F.when(inside, chosen).otherwise(out)
        return out

    # Equal rows that a rank falls into are numbered, so that it takes as many as are left.
    crossing = sorted({cut.prefix for _, cut in cuts if cut.left})
    marked = (df.filter(~order.isin(crossing)) if crossing else df).withColumn("_fault", number())
    for prefix in crossing:
        equal = row_positions(df.filter(order == prefix), "_copy")
        marked = marked.union(equal.withColumn("_fault", number(F.col("_copy"), prefix)).drop("_copy"))
    # Cells that are no number cannot be scaled: no fault, no label.
    for o in options:
        if o[1] == "anomaly" and cells.is_text(df.schema[o[4]].dataType):
            unreadable = (F.col("_fault") == o[0]) & cells.to_number(F.col(o[4]), T.StringType()).isNull()
            marked = marked.withColumn("_fault", F.when(~F.coalesce(unreadable, F.lit(False)), F.col("_fault")))
    return marked


def _changed(df: DataFrame, kind: str, column: str, change) -> tuple[Column, Column]:
    """Cell after a fault, as text and as number."""
    if kind == "missing":
        return F.lit(None).cast("string"), F.lit(None).cast("double")
    if kind == "invalid":
        number = None if isinstance(change, str) else float(change)
        return F.lit(str(change)), F.lit(number).cast("double")
    scaled = cells.to_number(F.col(column), df.schema[column].dataType) * F.lit(float(change))
    return scaled.cast("string"), scaled


def _dirty_table(marked: DataFrame, df: DataFrame, plan: FaultPlan) -> DataFrame:
    options = _options(df, plan)
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        mine = [o for o in options if o[4] == f.name]
        new = None
        for number, kind, _, _, column, change in mine:
            text, value = _changed(df, kind, column, change)
            cell = (value if isinstance(f.dataType, T.NumericType) else text).try_cast(f.dataType)
            hit = F.col("_fault") == number
            new = F.when(hit, cell) if new is None else new.when(hit, cell)
        out.append((c if new is None else new.otherwise(c)).alias(f.name))
    return marked.select(*out)


def _labels(marked: DataFrame, id_column: str, plan: FaultPlan) -> DataFrame:
    """One label per seeded cell, with the value before and after."""
    entry = None
    for number, kind, _, _, column, change in _options(marked, plan):
        text, value = _changed(marked, kind, column, change)
        label = F.struct(
            F.lit(column).alias("column_name"),
            F.lit(kind).alias("issue_type"),
            F.col(column).cast("string").alias("original_value"),
            cells.to_number(F.col(column), marked.schema[column].dataType).alias("original_num"),
            text.alias("dirty_value"),
            value.alias("dirty_num"),
        )
        hit = F.col("_fault") == number
        entry = F.when(hit, label) if entry is None else entry.when(hit, label)
    return (
        marked.filter(F.col("_fault").isNotNull())
        .select(F.col(id_column).cast("string").alias("row_id"), entry.alias("_label"))
        .select("row_id", "_label.*")
    )
