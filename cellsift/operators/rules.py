"""Rule checks: one scan finds every missing, invalid and cross-field cell.

Each rule becomes a predicate and a struct of constants. Rows that break no
rule are filtered by the predicates alone; only the others build an array of
findings. There is no shuffle, and the same code runs on a stream.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellsift.functions import cells
from cellsift.operators.bloom import IdFilter, id_key
from cellsift.sources.scratch import cut_lineage
from cellsift.spec import QualitySpec

# Public columns of the issue table, in order.
ISSUE_COLUMNS = (
    "issue_id", "row_id", "column_name", "issue_type", "current_value", "suggested_value",
    "confidence", "severity", "severity_score", "reason", "source_method", "can_auto_fix",
    "created_at",
)
# Numbers beside the texts above, and the place of the issue within its row.
INTERNAL_COLUMNS = ("current_num", "suggested_num", "issue_seq")

# Names of the detection methods.
MISSING_METHOD = "rule_missing_detector"
INVALID_METHOD = "rule_invalid_detector"
CROSS_FIELD_METHOD = "cross_field_rule"
ANOMALY_METHOD = "isolation_forest+feature_contribution"

MISSING, INVALID, CROSS_FIELD, ANOMALY = 1, 2, 3, 4


def issue_seq(stage: int, rule: int, check: int = 0) -> int:
    """Sort key of the issues of one row: stage, then rule order, then check order."""
    return (stage * 10_000 + rule) * 10 + check


@dataclass(frozen=True)
class Check:
    """One way in which one column can be wrong."""

    column: str
    broken: Column
    seq: int
    issue_type: str
    severity: str
    severity_score: float
    reason: str
    method: str

    def finding(self, current_value: Column, current_num: Column) -> Column:
        return F.struct(
            F.lit(self.seq).cast("long").alias("issue_seq"),
            F.lit(self.column).alias("column_name"),
            F.lit(self.issue_type).alias("issue_type"),
            current_value.alias("current_value"),
            current_num.alias("current_num"),
            F.lit(float(self.severity_score)).alias("severity_score"),
            F.lit(self.severity).alias("severity"),
            F.lit(self.reason).alias("reason"),
            F.lit(self.method).alias("source_method"),
        )


def _missing_score(severity: str, scale: str) -> float:
    if scale == "uniform":
        return cells.SEVERITY_SCORES[severity]
    # Missing cells know two scores only.
    return 0.7 if severity == "high" else 0.4


def _never_null(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _missing_checks(df: DataFrame, spec: QualitySpec) -> list[Check]:
    types = {f.name: f.dataType for f in df.schema.fields}
    return [
        Check(
            column=name,
            broken=cells.is_missing(F.col(name), types[name]),
            seq=issue_seq(MISSING, place),
            issue_type="missing",
            severity=rule.severity_if_missing,
            severity_score=_missing_score(rule.severity_if_missing, spec.severity_scale),
            reason=f"Required column '{name}' is missing.",
            method=MISSING_METHOD,
        )
        for place, (name, rule) in enumerate(spec.rules.items())
        if rule.required and name in types
    ]


def _invalid_conditions(df: DataFrame, spec: QualitySpec, name: str):
    """Yield (condition, reason) for the value checks of one column."""
    rule, c, dtype = spec.rules[name], F.col(name), df.schema[name].dataType
    if rule.dtype == "numeric":
        number = cells.to_number(c, dtype)
        if cells.is_text(dtype):
            yield c.isNotNull() & number.isNull(), f"Column '{name}' must be numeric."
        elif isinstance(dtype, cells.FLOAT_TYPES):
            yield F.abs(c) == float("inf"), f"Column '{name}' must be numeric."
        if rule.min_value is not None:
            yield number < F.lit(float(rule.min_value)), f"Value is smaller than minimum allowed: {rule.min_value}."
        if rule.max_value is not None:
            yield number > F.lit(float(rule.max_value)), f"Value is larger than maximum allowed: {rule.max_value}."
    elif rule.dtype == "categorical" and rule.allowed_values:
        allowed = list(rule.allowed_values)
        wanted = [str(v) for v in allowed] if cells.is_text(dtype) else allowed
        yield ~c.isin(wanted), f"Value is not in allowed values: {allowed}."
    elif rule.dtype == "date" and cells.is_text(dtype):
        parsed = cells.to_date(c, dtype, rule.date_formats)
        yield c.isNotNull() & parsed.isNull(), f"Column '{name}' has invalid date format."


def _invalid_checks(df: DataFrame, spec: QualitySpec) -> list[Check]:
    out = []
    for place, (name, rule) in enumerate(spec.rules.items()):
        if name not in df.columns:
            continue
        for number, (condition, reason) in enumerate(_invalid_conditions(df, spec, name)):
            out.append(
                Check(
                    column=name,
                    broken=_never_null(condition),
                    seq=issue_seq(INVALID, place, number),
                    issue_type="invalid",
                    severity=rule.severity_if_invalid,
                    severity_score=cells.SEVERITY_SCORES[rule.severity_if_invalid],
                    reason=reason,
                    method=INVALID_METHOD,
                )
            )
    return out


def _cross_checks(df: DataFrame, spec: QualitySpec) -> list[Check]:
    present = set(df.columns)
    return [
        Check(
            column=rule.column,
            broken=_never_null(F.col(f"_cross{place}")),
            seq=issue_seq(CROSS_FIELD, place),
            issue_type="invalid",
            severity=rule.severity,
            severity_score=rule.severity_score,
            reason=rule.reason,
            method=CROSS_FIELD_METHOD,
        )
        for place, rule in enumerate(spec.cross_field)
        if set(rule.needs) <= present
    ]


def _with_cross_flags(df: DataFrame, spec: QualitySpec) -> DataFrame:
    """Evaluate cross-field predicates over numbers, keeping the raw cells."""
    types = {f.name: f.dataType for f in df.schema.fields}
    rules = [(i, r) for i, r in enumerate(spec.cross_field) if set(r.needs) <= set(types)]
    if not rules:
        return df
    shadowed = {
        c
        for _, r in rules
        for c in r.needs
        if isinstance(types[c], cells.FLOAT_TYPES)
        or (cells.is_text(types[c]) and c in spec.rules and spec.rules[c].dtype == "numeric")
    }
    numbers = df.select(
        *[
            cells.to_number(F.col(f"`{c}`"), types[c]).alias(c) if c in shadowed else F.col(f"`{c}`")
            for c in df.columns
        ],
        *[F.col(c).alias(f"_raw_{c}") for c in sorted(shadowed)],
    )
    return numbers.select(
        *[F.col(f"_raw_{c}").alias(c) if c in shadowed else F.col(f"`{c}`") for c in df.columns],
        *[F.expr(r.predicate).alias(f"_cross{i}") for i, r in rules],
    )


def _drop_derived(checks: list[Check], spec: QualitySpec) -> list[Check]:
    """Silence a derived column where one of its inputs is already reported."""
    out = []
    for check in checks:
        inputs = spec.derived.get(check.column, ())
        parents = [c.broken for c in checks if c.column in inputs]
        if parents:
            quiet = reduce(lambda a, b: a | b, parents)
            check = Check(**{**check.__dict__, "broken": check.broken & ~quiet})
        out.append(check)
    return out


def _checks(df: DataFrame, spec: QualitySpec, kinds) -> tuple[DataFrame, list[Check]]:
    flagged = _with_cross_flags(df, spec) if "cross_field" in kinds else df
    checks: list[Check] = []
    if "missing" in kinds:
        checks += _missing_checks(df, spec)
    if "invalid" in kinds:
        checks += _invalid_checks(df, spec)
    if "cross_field" in kinds:
        checks += _cross_checks(df, spec)
    if spec.skip_derived_findings:
        checks = _drop_derived(checks, spec)
    return flagged, checks


ALL_KINDS = ("missing", "invalid", "cross_field")


def with_findings(df: DataFrame, spec: QualitySpec, kinds=ALL_KINDS) -> DataFrame:
    """Add ``findings``, the array of broken rules of each row (null if none)."""
    flagged, checks = _checks(df, spec, kinds)
    types = {f.name: f.dataType for f in df.schema.fields}
    if not checks:
        nothing = Check("", F.lit(False), 0, "", "", 0.0, "", "")
        empty = F.array(nothing.finding(F.lit(None).cast("string"), F.lit(None).cast("double")))
        return df.withColumn("findings", F.when(F.lit(False), empty))
    candidates = []
    for check in checks:
        c = F.col(check.column)
        is_gap = check.issue_type == "missing"
        text = F.lit(None).cast("string") if is_gap else c.cast("string")
        number = F.lit(None).cast("double") if is_gap else cells.to_number(c, types[check.column])
        candidates.append(F.when(check.broken, check.finding(text, number)))
    any_broken = reduce(lambda a, b: a | b, [check.broken for check in checks])
    found = F.filter(F.array(*candidates), lambda x: x.isNotNull())
    return flagged.select(
        *[F.col(f"`{c}`") for c in df.columns], F.when(any_broken, found).alias("findings")
    )


def explode_findings(rows: DataFrame, spec: QualitySpec) -> DataFrame:
    """One issue per finding, without suggestions yet."""
    # The outer form keeps Spark from inferring a filter on the array and
    # copying all checks into it; rows without findings are dropped right after.
    flat = rows.select(F.col(spec.id_column).cast("string").alias("row_id"), F.inline_outer("findings"))
    return flat.filter(F.col("column_name").isNotNull())


def as_issues(findings: DataFrame) -> DataFrame:
    """Give exploded findings the issue schema.

    The id of an issue is a hash of its row id, cell, value and rule, so reruns
    repeat it. Rows that agree in all of these share it: a repair, which goes by
    row id and column, could not treat them differently either.
    """
    have = set(findings.columns)
    key = F.to_json(F.struct("row_id", "column_name", "current_value", "issue_type", "source_method", "reason"))
    return findings.select(
        F.md5(key).alias("issue_id"),
        "row_id",
        "column_name",
        "issue_type",
        "current_value",
        _or_default(have, "suggested_value", F.lit(None).cast("string")),
        _or_default(have, "confidence", F.lit(1.0)),
        "severity",
        "severity_score",
        "reason",
        "source_method",
        _or_default(have, "can_auto_fix", F.lit(True)),
        F.current_timestamp().alias("created_at"),
        "current_num",
        _or_default(have, "suggested_num", F.lit(None).cast("double")),
        "issue_seq",
    )


def _or_default(have: set[str], name: str, default: Column) -> Column:
    return (F.col(name) if name in have else default).alias(name)


def rule_issues(df: DataFrame, spec: QualitySpec, kinds=ALL_KINDS) -> DataFrame:
    """Issue table of the rule checks."""
    return as_issues(explode_findings(with_findings(df, spec, kinds), spec))


def _spoiled(rows: DataFrame, spec: QualitySpec, kept: list[str] | None) -> IdFilter:
    """Distinct ids of rows with a finding, written once, and a filter over them."""
    ids = rows.filter(F.col("findings").isNotNull()).select(id_key(F.col(f"`{spec.id_column}`")).alias("_spoiled")).distinct()
    return IdFilter(cut_lineage(ids, "spoiled", kept))


def clean_rows(df: DataFrame, spec: QualitySpec, kept: list[str] | None = None) -> DataFrame:
    """Rows whose id has no finding; every row if there is no such row.

    Rows that break a rule themselves need no look at others. Of the rest, rows
    that the filter clears are clean; only those it hits are shuffled for an
    exact look at their id. ``kept`` collects the path of the ids.
    """
    rows = with_findings(df, spec)
    fine = rows.filter(F.col("findings").isNull()).drop("findings")
    if spec.id_is_unique:
        return df if fine.isEmpty() else fine
    spoiled = _spoiled(rows, spec, kept)
    key = id_key(F.col(f"`{spec.id_column}`"))
    marked = spoiled.marked(fine, key, "_hit")
    surely = marked.filter(~F.col("_hit")).drop("_hit")
    asked = marked.filter("_hit").drop("_hit").withColumn("_key", key)
    clean = surely.unionByName(asked.join(spoiled.ids, asked["_key"] == F.col("_spoiled"), "left_anti").drop("_key"))
    # The first surely clean row settles it, and is found in the first partitions as a rule.
    return df if surely.isEmpty() and clean.isEmpty() else clean


def mark_clean(df: DataFrame, spec: QualitySpec, kept: list[str] | None = None) -> DataFrame:
    """Add ``findings`` and ``is_clean``.

    With unique ids a row decides for itself. Otherwise a finding in any row
    spoils every row that shares the id, null ids included; only rows that the
    filter of spoiled ids hits are joined with them.
    """
    rows = with_findings(df, spec)
    own = F.col("findings").isNull()
    if spec.id_is_unique:
        return rows.withColumn("is_clean", own)
    spoiled = _spoiled(rows, spec, kept)
    key = id_key(F.col(f"`{spec.id_column}`"))
    marked = spoiled.marked(rows, key, "_hit")
    settled = marked.filter(~F.col("_hit") | ~own).withColumn("is_clean", own).drop("_hit")
    asked = marked.filter(F.col("_hit") & own).drop("_hit").withColumn("_key", key)
    joined = asked.join(spoiled.ids, asked["_key"] == F.col("_spoiled"), "left")
    return settled.unionByName(joined.withColumn("is_clean", F.col("_spoiled").isNull()).drop("_key", "_spoiled"))


def in_issue_order(issues: DataFrame) -> DataFrame:
    """Missing, invalid, cross-field, anomaly; inside, rule order, then row id."""
    return issues.orderBy("issue_seq", "row_id")
