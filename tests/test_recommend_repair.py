"""Suggestions, attribution and repair."""

import difflib

import pytest
from pyspark.sql import functions as F

from cellsift import ColumnRule, QualitySpec, SpecError
from cellsift.operators import attribute, recommend, repair, rules

SPEC = QualitySpec(
    "t", "id",
    {
        "id": ColumnRule("id", required=True, use_for_detection=False),
        "n": ColumnRule("numeric", required=True, min_value=0, max_value=100),
        "g": ColumnRule("categorical", required=True, allowed_values=("RETAIL", "INVESTMENTS", "MEDICAL")),
    },
    cross_field=(),
)
NEAR = "neighbours array<struct<dist2:double,key:string,n:double,g:string>>"


def near(*values):
    return [(0.0, str(i), n, g) for i, (n, g) in enumerate(values)]


def judged(spark, rows):
    return spark.createDataFrame(rows, f"id string, n double, g string, {NEAR}")


def suspects(spark, spec, *rows):
    df = attribute.suspicious_columns(judged(spark, list(rows)), spec)
    return {r["id"]: r["suspects"] for r in df.collect()}


def test_suspicious_columns(spark):
    calm = near((1.0, "A"), (2.0, "A"), (3.0, "B"), (2.0, "A"), (2.0, "B"))
    flat = near((2.0, "A"), (2.0, "B"), (2.0, "B"))
    got = suspects(
        spark, SPEC,
        ("near", 3.0, "A", calm),
        ("far", 9.0, "B", calm),
        ("gap", None, None, calm),
        ("flat_same", 2.0, "B", flat),
        ("flat_other", 2.1, "A", flat),
        ("one", 50.0, "A", near((1.0, "A"), (None, None))),
        ("none", 50.0, "A", near((None, None))),
    )
    assert got == {
        "near": [], "far": ["n", "g"], "gap": ["n", "g"], "flat_same": [], "flat_other": ["n", "g"],
        "one": [], "none": [],
    }


def missing_rows(spark, rows):
    df = judged(spark, rows)
    found = rules.with_findings(df, SPEC, ("missing",))
    return found.withColumn("findings", F.transform("findings", lambda f: f.withField("confidence", F.lit(1.0))))


def test_statistics_are_those_of_the_finding(spark):
    """every row had the statistics of all its columns taken, whether it had a finding or not."""
    close = near((1.0, "A"), (2.0, "A"), (9.0, "B"))
    rows = missing_rows(spark, [("n", None, "A", close), ("g", 1.0, None, close), ("both", None, None, close), ("none", 1.0, "A", close)])
    found = recommend.recommend_from_neighbours(rows, SPEC)
    got = {(r["row_id"], r["column_name"]): (r["suggested_value"], r["suggested_num"], r["confidence"]) for r in found.collect()}
    number, text = ("2.0", 2.0, 0.5292), ("A", None, 0.6667)
    assert got == {("n", "n"): number, ("g", "g"): text, ("both", "n"): number, ("both", "g"): text}
    # The plan is written from the result down: rows are dealt to findings first.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert all(plan.rindex(part) < plan.index("Generate") for part in ("array_sort(", "aggregate(", "array_distinct("))


def test_neighbour_suggestions(spark):
    rows = missing_rows(
        spark,
        [
            ("a", None, None, near((1.0, "x"), (2.0, "y"), (4.0, "x"), (None, None))),
            ("zero", None, "x", near((-1.0, "x"), (1.0, "x"))),
            ("none", None, None, near((None, None))),
        ],
    )
    got = {
        (r["row_id"], r["column_name"]): (r["suggested_num"], r["suggested_value"], r["confidence"])
        for r in recommend.recommend_from_neighbours(rows, SPEC).collect()
    }
    # Median 2, spread / mean = 1.2472 / 2.3333.
    assert got[("a", "n")] == (2.0, "2.0", round(1 / (1 + 1.247219128924647 / 2.3333333333333335), 4))
    assert got[("a", "g")] == (None, "x", 0.6667)
    assert got[("zero", "n")] == (0.0, "0.0", 0.5)
    assert got[("none", "n")] == (None, None, 0.0) and got[("none", "g")] == (None, None, 0.0)


def invalid(spark, rows, spec=SPEC):
    df = spark.createDataFrame(rows, "id string, n string, g string")
    findings = rules.explode_findings(rules.with_findings(df, spec, ("invalid",)), spec)
    return {
        (r["row_id"], r["column_name"]): (r["suggested_value"], r["confidence"])
        for r in recommend.recommend_invalid(findings, spec).collect()
    }


def test_invalid_suggestions(spark):
    got = invalid(
        spark,
        [("low", "-5", "RETIAL"), ("high", "500", "UNKNOWN_DOMAIN"), ("text", "abc", "INVESTMENT"), ("fine", "1", "RETAIL")],
        SPEC.with_options(similarity="gestalt"),
    )
    ratio = lambda a, b: round(difflib.SequenceMatcher(None, a, b).ratio(), 4)
    assert got == {
        ("low", "n"): ("0", 1.0),
        ("low", "g"): ("RETAIL", ratio("RETIAL", "RETAIL")),
        ("high", "n"): ("100", 1.0),
        ("high", "g"): ("RETAIL", 0.5),
        ("text", "n"): (None, 0.0),
        ("text", "g"): ("INVESTMENTS", ratio("INVESTMENT", "INVESTMENTS")),
    }


def test_edit_distance_similarity(spark):
    got = invalid(spark, [("a", "1", "RETAI"), ("b", "1", "zz")], SPEC.with_options(similarity="levenshtein"))
    assert got == {("a", "g"): ("RETAIL", 0.8333), ("b", "g"): ("RETAIL", 0.5)}


def test_edit_distance_needs_no_shuffle(spark):
    spec = SPEC.with_options(similarity="levenshtein")
    df = spark.createDataFrame([("a", "1", "RETAI"), (None, "1", None)], "id string, n string, g string")
    findings = rules.explode_findings(rules.with_findings(df, spec), spec)
    plan = recommend.recommend_invalid(findings, spec)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_anomaly_severity(spark):
    df = spark.createDataFrame([(10.0, 4.0), (None, 4.0), (10.0, None), (4.0, 4.0)], "c double, s double")
    score = recommend.anomaly_severity(F.col("c"), F.col("s"), F.lit(True))
    assert [r[0] for r in df.select(score).collect()] == [1.2, None, 0.5, 0.0]


def fixes(spark, *rows):
    return spark.createDataFrame(
        list(rows),
        "issue_id string, row_id string, column_name string, issue_seq long, reason string, suggested_value string, "
        "suggested_num double, confidence double, can_auto_fix boolean",
    )


def table(spark):
    return spark.createDataFrame([("a", 1.0, "x"), ("a", 2.0, "y"), ("b", None, "z"), (None, 4.0, "w")], "id string, n double, g string")


def content(df):
    return sorted(((r["id"], r["n"], r["g"]) for r in df.collect()), key=str)


def test_repair_modes(spark):
    issues = fixes(
        spark,
        ("1", "a", "g", 1, "r", "NEW", None, 0.9, True),
        ("2", "b", "n", 1, "r", "7.5", 7.5, 0.5, True),
        ("3", "b", "g", 1, "r", None, None, 1.0, True),
        ("4", "b", "g", 2, "r", "no", None, 1.0, False),
        ("5", None, "g", 1, "r", "no", None, 1.0, True),
    )
    df = table(spark)
    assert content(repair.apply_fixes(df, issues, SPEC)) == sorted(
        [("a", 1.0, "NEW"), ("a", 2.0, "NEW"), ("b", None, "z"), (None, 4.0, "w")], key=str
    )
    assert ("b", 7.5, "z") in content(repair.apply_fixes(df, issues, SPEC, "auto"))
    yes = spark.createDataFrame([("2", True), ("1", False)], "issue_id string, approved boolean")
    assert content(repair.apply_fixes(df, issues, SPEC, "approved", yes)) == sorted(
        [("a", 1.0, "x"), ("a", 2.0, "y"), ("b", 7.5, "z"), (None, 4.0, "w")], key=str
    )
    with pytest.raises(SpecError):
        repair.apply_fixes(df, issues, SPEC, "maybe")
    with pytest.raises(SpecError):
        repair.apply_fixes(df, issues, SPEC, "approved")


def test_last_fix_wins_and_repeats_change_nothing(spark):
    issues = fixes(
        spark,
        ("1", "b", "n", 5, "r", "5", 5.0, 1.0, True),
        ("2", "b", "n", 9, "r", "9", 9.0, 1.0, True),
        ("3", "b", "n", 7, "r", "7", 7.0, 1.0, True),
    )
    once = repair.apply_fixes(table(spark), issues, SPEC, "auto")
    assert ("b", 9.0, "z") in content(once)
    assert content(repair.apply_fixes(once, issues, SPEC, "auto")) == content(once)


def test_no_issues_leave_the_table_alone(spark):
    df = table(spark)
    assert content(repair.apply_fixes(df, fixes(spark), SPEC, "auto")) == content(df)


def test_fixed_table_can_be_derived_again(spark):
    issues = fixes(spark, ("1", "b", "n", 1, "r", "3", 3.0, 1.0, True))
    fixed = repair.apply_fixes(table(spark), issues, SPEC, "auto", rederive=lambda d: d.withColumn("twice", F.col("n") * 2))
    assert {r["id"]: r["twice"] for r in fixed.filter("id = 'b'").collect()} == {"b": 6.0}
