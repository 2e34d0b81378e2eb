"""Rule specification, checks and the clean set."""

import pytest

from cellsift import ColumnRule, CrossFieldRule, QualitySpec, SpecError, bank_spec, load_spec
from cellsift.operators import rules
from cellsift.plans import tables
from cellsift.spec import spec_from_dict, spec_from_rules_table

SCHEMA = (
    "transaction_id string, date string, domain string, location string, value double, "
    "transaction_count double, avg_transaction_value double"
)


def bank(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def found(df, spec, **kw):
    rows = rules.rule_issues(df, spec, **kw).orderBy("row_id", "issue_seq").collect()
    return [(r["row_id"], r["column_name"], r["issue_type"], r["severity"], r["severity_score"]) for r in rows]


def test_every_kind_of_finding(spark):
    df = bank(
        spark,
        ("1", "2022-01-01", "RETAIL", "x", 5.0, 1.0, 5.0),
        ("2", None, "retail", " ", -1.0, 0.0, None),
        ("3", "2022-01-01", "RETAIL", "x", 5.0, 0.0, float("nan")),
    )
    assert found(df, bank_spec()) == [
        ("2", "date", "missing", "high", 0.7),
        ("2", "location", "missing", "medium", 0.4),
        ("2", "domain", "invalid", "medium", 0.4),
        ("2", "value", "invalid", "high", 0.7),
        ("3", "transaction_count", "invalid", "high", 0.8),
    ]


def test_raw_text_reaches_type_checks(spark):
    spec = QualitySpec(
        "t", "id", {"id": ColumnRule("id"), "n": ColumnRule("numeric", min_value=0, max_value=9), "d": ColumnRule("date")}
    )
    df = spark.createDataFrame(
        [("a", "x", "2020-01-01"), ("b", "-3", "31/12/2020"), ("c", "12", None), ("d", None, "2020-02-30")],
        "id string, n string, d string",
    )
    reasons = {(r["row_id"], r["reason"]) for r in rules.rule_issues(df, spec).collect()}
    assert reasons == {
        ("a", "Column 'n' must be numeric."),
        ("b", "Value is smaller than minimum allowed: 0."),
        ("b", "Column 'd' has invalid date format."),
        ("c", "Value is larger than maximum allowed: 9."),
        ("d", "Column 'd' has invalid date format."),
    }


def test_legacy_and_uniform_missing_scores(spark):
    spec = QualitySpec("t", "id", {"id": ColumnRule("id"), "n": ColumnRule("numeric", required=True, severity_if_missing="critical")})
    df = spark.createDataFrame([("a", None)], "id string, n double")
    assert found(df, spec)[0][4] == 0.4
    assert found(df, spec.with_options(severity_scale="uniform"))[0][4] == 1.0


def test_derived_finding_can_be_silenced(spark):
    df = bank(spark, ("1", "2022-01-01", "RETAIL", "x", -4.0, 2.0, -2.0))
    assert [f[1] for f in found(df, bank_spec())] == ["value", "avg_transaction_value"]
    assert [f[1] for f in found(df, bank_spec().with_options(skip_derived_findings=True))] == ["value"]


def test_custom_cross_field_rule(spark):
    rule = CrossFieldRule(column="b", predicate="a > b", needs=("a", "b"), reason="a above b")
    spec = QualitySpec("t", "id", {"id": ColumnRule("id"), "a": ColumnRule("numeric"), "b": ColumnRule("numeric")}, cross_field=(rule,))
    df = spark.createDataFrame([("1", "5", "4"), ("2", "x", "1"), ("3", "1", None)], "id string, a string, b string")
    assert [(f[0], f[1]) for f in found(df, spec, kinds=("cross_field",))] == [("1", "b")]
    no_column = df.drop("b")
    assert rules.rule_issues(no_column, spec).filter("source_method = 'cross_field_rule'").isEmpty()


def test_clean_set_shares_ids_and_nulls(spark):
    spec = QualitySpec("t", "id", {"id": ColumnRule("id"), "n": ColumnRule("numeric", min_value=0)}, cross_field=())
    df = spark.createDataFrame(
        [("a", 1.0), ("a", -1.0), ("b", 2.0), (None, -5.0), (None, 3.0), ("c", None)], "id string, n double"
    )
    assert sorted(r["id"] for r in rules.clean_rows(df, spec).collect()) == ["b", "c"]
    by_row = rules.clean_rows(df, spec.with_options(id_is_unique=True)).collect()
    assert sorted((r["id"] or "", r["n"] or 0.0) for r in by_row) == [("", 3.0), ("a", 1.0), ("b", 2.0), ("c", 0.0)]


def test_clean_set_falls_back_to_all_rows(spark):
    spec = QualitySpec("t", "id", {"id": ColumnRule("id"), "n": ColumnRule("numeric", min_value=0)}, cross_field=())
    df = spark.createDataFrame([("a", -1.0), ("b", -2.0)], "id string, n double")
    assert rules.clean_rows(df, spec).count() == 2


def test_empty_table_gives_empty_issues(spark):
    empty = rules.rule_issues(bank(spark), bank_spec())
    assert empty.count() == 0
    assert empty.columns == [*rules.ISSUE_COLUMNS, *rules.INTERNAL_COLUMNS]


def test_issue_ids_are_repeatable(spark, sf):
    df, spec = tables.dirty_transactions(spark, sf), tables.transactions_spec()
    one = rules.rule_issues(df, spec).select("issue_id")
    two = rules.rule_issues(df.repartition(3), spec).select("issue_id")
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()
    assert one.count() == one.distinct().count()


def test_issue_ids_tell_values_of_a_shared_id_apart(spark, sf):
    """Only findings that agree in row id, cell, value and rule share an id."""
    lines = tables.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    issues = rules.rule_issues(lines, tables.lines_spec())
    told = issues.select("row_id", "column_name", "current_value", "issue_type", "source_method", "reason").distinct()
    by_cell = issues.select("row_id", "column_name").distinct().count()
    assert issues.select("issue_id").distinct().count() == told.count() > by_cell


def test_rules_need_no_shuffle(spark, sf):
    df = tables.dirty_transactions(spark, sf)
    plan = rules.rule_issues(df, tables.transactions_spec())._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_column_lists():
    spec = bank_spec()
    assert spec.required_columns == ["transaction_id", "date", "domain", "location", "value", "transaction_count"]
    assert spec.detection_columns == ["domain", "location", "value", "transaction_count", "avg_transaction_value"]
    assert spec.recommendation_columns == spec.detection_columns
    assert spec.related_columns("value") == {"value", "avg_transaction_value"}
    assert spec.related_columns("avg_transaction_value") == {"value", "transaction_count", "avg_transaction_value"}


def test_required_columns_include_optional_rules():
    with pytest.raises(SpecError, match="avg_transaction_value"):
        bank_spec().require_columns(["transaction_id", "date", "domain", "location", "value", "transaction_count"])


def test_yaml_rules(tmp_path):
    path = tmp_path / "rules.yaml"
    path.write_text(
        "table_name: t\nid_column: id\nmodel: {knn_neighbors: 3, contamination: 0.1}\n"
        "columns:\n  id: {dtype: id, required: true}\n  n: {dtype: numeric, min_value: 1, severity_if_invalid: low}\n"
        "cross_field:\n  - {column: n, predicate: 'n > 3', needs: [n], reason: r}\n"
    )
    spec = load_spec(str(path))
    assert (spec.knn_neighbors, spec.contamination, spec.n_estimators) == (3, 0.1, 200)
    assert spec.rules["n"].severity_if_invalid == "low" and spec.rules["n"].severity_if_missing == "medium"
    assert spec.cross_field[0].needs == ("n",)
    assert load_spec(None) == bank_spec()
    with pytest.raises(FileNotFoundError):
        load_spec(str(tmp_path / "none.yaml"))


def test_bad_specs_are_rejected():
    with pytest.raises(SpecError):
        spec_from_dict({"id_column": "id"})
    with pytest.raises(SpecError):
        spec_from_dict({"table_name": "t", "id_column": "id", "columns": {"a": {"required": True}}})
    with pytest.raises(SpecError):
        ColumnRule("text")
    with pytest.raises(SpecError):
        bank_spec().with_options(neighbours="all")


def test_rules_from_a_table(spark):
    rows = spark.createDataFrame(
        [("id", "id", True, None), ("n", "numeric", None, 2.0)],
        "column_name string, dtype string, required boolean, min_value double",
    )
    spec = spec_from_rules_table(rows, "t", "id", knn_neighbors=2)
    assert spec.rules["n"].min_value == 2.0 and not spec.rules["n"].required and spec.knn_neighbors == 2
