"""Rule specification: what each column of a table must look like.

A spec lives on the driver only. Operators read it while they build Column
expressions, so nothing here is shipped to executors.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, fields, replace
from typing import Any

import yaml

# Rule types and severities a spec may name.
DTYPES = ("id", "numeric", "categorical", "date")
SEVERITIES = ("low", "medium", "high", "critical")

NEIGHBOUR_MODES = ("reference", "exclude_self", "leave_one_feature_out")


class SpecError(ValueError):
    """The rule specification, or the table it is applied to, does not fit."""


@dataclass(frozen=True)
class ColumnRule:
    dtype: str
    required: bool = False
    min_value: float | None = None
    max_value: float | None = None
    allowed_values: tuple | None = None
    use_for_detection: bool = True
    use_for_recommendation: bool = True
    severity_if_missing: str = "medium"
    severity_if_invalid: str = "high"
    date_formats: tuple[str, ...] = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss")

    def __post_init__(self):
        if self.dtype not in DTYPES:
            raise SpecError(f"unknown dtype {self.dtype!r}, expected one of {DTYPES}")
        for severity in (self.severity_if_missing, self.severity_if_invalid):
            if severity not in SEVERITIES:
                raise SpecError(f"unknown severity {severity!r}, expected one of {SEVERITIES}")
        if self.allowed_values is not None:
            object.__setattr__(self, "allowed_values", tuple(self.allowed_values))
        object.__setattr__(self, "date_formats", tuple(self.date_formats))


@dataclass(frozen=True)
class CrossFieldRule:
    """A SQL predicate over several columns; rows where it holds are reported."""

    column: str
    predicate: str
    needs: tuple[str, ...]
    reason: str
    severity: str = "high"
    severity_score: float = 0.8


# The cross-field check every bank-style table gets.
ZERO_COUNT_WITH_VALUE = CrossFieldRule(
    column="transaction_count",
    predicate="transaction_count = 0 AND value > 0",
    needs=("value", "transaction_count"),
    reason="transaction_count is 0 while value is greater than 0.",
)


@dataclass(frozen=True)
class QualitySpec:
    """Rules plus model settings for one table.

    ``id_is_unique`` lets the clean set be a row-local filter instead of an
    anti-join. ``derived`` maps a derived column to the columns it is computed
    from; leave-one-feature-out neighbours need it.
    """

    table_name: str
    id_column: str
    rules: Mapping[str, ColumnRule]
    cross_field: tuple[CrossFieldRule, ...] = (ZERO_COUNT_WITH_VALUE,)
    derived: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    id_is_unique: bool = False

    contamination: float = 0.08
    n_estimators: int = 200
    max_samples: int = 256
    random_state: int = 42
    knn_neighbors: int = 5
    feature_z_threshold: float = 2.5
    conservative_confidence_threshold: float = 0.85

    neighbours: str = "reference"
    severity_scale: str = "legacy"
    skip_derived_findings: bool = False
    respect_use_for_recommendation: bool = False
    similarity: str = "levenshtein"

    def __post_init__(self):
        if self.neighbours not in NEIGHBOUR_MODES:
            raise SpecError(f"neighbours must be one of {NEIGHBOUR_MODES}")
        if self.severity_scale not in ("legacy", "uniform"):
            raise SpecError("severity_scale must be 'legacy' or 'uniform'")
        if self.similarity not in ("gestalt", "levenshtein"):
            raise SpecError("similarity must be 'gestalt' or 'levenshtein'")
        if not 0 < self.contamination <= 0.5:
            raise SpecError("contamination must be in (0, 0.5]")

    def with_options(self, **changes) -> QualitySpec:
        return replace(self, **changes)

    def with_rule(self, column: str, **changes) -> QualitySpec:
        rules = dict(self.rules)
        rules[column] = replace(rules[column], **changes)
        return replace(self, rules=rules)

    # Column lists -------------------------------------------------------
    @property
    def ruled_columns(self) -> list[str]:
        return list(self.rules)

    @property
    def required_columns(self) -> list[str]:
        return [c for c, r in self.rules.items() if r.required]

    @property
    def detection_columns(self) -> list[str]:
        return [c for c, r in self.rules.items() if r.use_for_detection and c != self.id_column]

    @property
    def recommendation_columns(self) -> list[str]:
        return [c for c, r in self.rules.items() if r.use_for_recommendation and c != self.id_column]

    def features_of(self, dtype: str) -> list[str]:
        return [c for c in self.detection_columns if self.rules[c].dtype == dtype]

    def related_columns(self, column: str) -> set[str]:
        """The column itself, the columns derived from it and those it is derived from."""
        related = {column, *self.derived.get(column, ())}
        related.update(c for c, inputs in self.derived.items() if column in inputs)
        return related

    def require_columns(self, present: Iterable[str]) -> None:
        present = set(present)
        absent = [c for c in self.rules if c not in present]
        if absent:
            raise SpecError(f"Missing required columns: {absent}")


def _known(cls, raw: Mapping[str, Any]) -> dict[str, Any]:
    names = {f.name for f in fields(cls)}
    unknown = sorted(k for k in raw if k not in names)
    if unknown:
        raise SpecError(f"unknown settings for {cls.__name__}: {unknown}")
    return dict(raw)


def spec_from_dict(raw: Mapping[str, Any]) -> QualitySpec:
    """Build a spec from the parsed form of a YAML rule file."""
    for key in ("table_name", "id_column"):
        if key not in raw:
            raise SpecError(f"rule file lacks {key!r}")
    rules = {}
    for column, body in (raw.get("columns") or {}).items():
        if "dtype" not in (body or {}):
            raise SpecError(f"column {column!r} lacks 'dtype'")
        rules[column] = ColumnRule(**_known(ColumnRule, body))
    extra: dict[str, Any] = {}
    if "cross_field" in raw:
        extra["cross_field"] = tuple(
            CrossFieldRule(**{**_known(CrossFieldRule, r), "needs": tuple(r["needs"])})
            for r in raw["cross_field"] or ()
        )
    if "derived" in raw:
        extra["derived"] = {c: tuple(inputs) for c, inputs in raw["derived"].items()}
    settings = _known(QualitySpec, raw.get("model") or {})
    return QualitySpec(
        table_name=raw["table_name"], id_column=raw["id_column"], rules=rules, **extra, **settings
    )


def load_spec(path: str | None = None) -> QualitySpec:
    """Read a YAML rule file; without a path, the built-in bank spec."""
    if path is None:
        return bank_spec()
    try:
        with open(path, encoding="utf-8") as handle:
            return spec_from_dict(yaml.safe_load(handle))
    except FileNotFoundError:
        raise FileNotFoundError(f"Config file not found: {path}") from None


def spec_from_rules_table(rows, table_name: str, id_column: str, **settings) -> QualitySpec:
    """Build a spec from a rules DataFrame with one row per column of the ruled table.

    The table is as long as the ruled table is wide, so it is collected.
    Columns that are absent or null keep the rule's default.
    """
    rules = {}
    for row in rows.collect():
        body = {k: v for k, v in row.asDict(recursive=True).items() if v is not None}
        name = body.pop("column_name")
        rules[name] = ColumnRule(**_known(ColumnRule, body))
    return QualitySpec(table_name=table_name, id_column=id_column, rules=rules, **settings)


def bank_spec() -> QualitySpec:
    """The built-in spec for aggregated bank transactions."""
    # Column names, limits, severities and allowed domains.
    domains = (
        "RESTAURANT", "INVESTMENTS", "RETAIL", "INTERNATIONAL", "PUBLIC", "MEDICAL", "EDUCATION",
    )
    quiet = dict(use_for_detection=False, use_for_recommendation=False)
    medium = dict(severity_if_missing="medium", severity_if_invalid="medium")
    high = dict(severity_if_missing="high", severity_if_invalid="high")
    return QualitySpec(
        table_name="bank_transactions",
        id_column="transaction_id",
        rules={
            "transaction_id": ColumnRule("id", required=True, **quiet),
            "date": ColumnRule("date", required=True, **quiet, **high),
            "domain": ColumnRule("categorical", required=True, allowed_values=domains, **medium),
            "location": ColumnRule("categorical", required=True, **medium),
            "value": ColumnRule("numeric", required=True, min_value=0, **high),
            "transaction_count": ColumnRule("numeric", required=True, min_value=0, **high),
            "avg_transaction_value": ColumnRule("numeric", min_value=0),
        },
        derived={"avg_transaction_value": ("value", "transaction_count")},
    )
