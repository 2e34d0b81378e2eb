"""Forest, reports, evaluation, sources and the whole job."""

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cellsift import SpecError, bank_spec
from cellsift.operators import forest, rules
from cellsift.operators.features import fit_features
from cellsift.plans import evaluate, pipeline, report, tables, workloads
from cellsift.sources.files import FileSink, FileSource, convert, text_schema
from cellsift.sources.jdbc import JdbcTable
from cellsift.sources.scratch import checkpoint_folder


@pytest.fixture(scope="module")
def run(spark, sf):
    result = pipeline.run_detection(tables.dirty_transactions(spark, sf), tables.transactions_spec())
    yield result
    result.close()


def metrics(df):
    return {r["metric"]: r["value"] for r in df.collect()}


# Forest ------------------------------------------------------------------
@pytest.fixture(scope="module")
def fitted(spark, sf):
    spec = tables.transactions_spec().with_options(n_estimators=60)
    clean = tables.transactions(spark, sf).filter("transaction_count > 0")
    features = fit_features(clean, spec)
    return clean, features, spec, forest.fit_forest(clean, features, spec)


def test_forest_shape(fitted):
    _, _, spec, model = fitted
    nodes = model.nodes
    assert nodes["tree"].nunique() == spec.n_estimators
    assert (nodes[nodes["node"] == 0]["rows"] == model.sample_rows).all()
    assert nodes["depth"].max() <= 8
    inner = nodes[nodes["feature"] >= 0].set_index(["tree", "node"])
    sizes = nodes.set_index(["tree", "node"])["rows"]
    for (tree, _), r in inner.iterrows():
        assert sizes[(tree, r["left"])] + sizes[(tree, r["right"])] == r["rows"]
        assert min(sizes[(tree, r["left"])], sizes[(tree, r["right"])]) >= 1


def test_scores_follow_the_trees(fitted):
    """Array scoring equals a plain walk down every tree."""
    clean, features, _, model = fitted
    rows = features.transform(clean).limit(40).toPandas()
    got = forest.ScoringForest(model.nodes, len(features.z_names), len(features.c_names), model.sample_rows).score(
        [rows[z] for z in features.z_names], [rows[c] for c in features.c_names]
    )
    tables_by_tree = {t: g.set_index("node").to_dict("index") for t, g in model.nodes.groupby("tree")}
    for i, row in rows.iterrows():
        values = [*row[features.z_names], *row[features.c_names]]
        total = 0.0
        for nodes in tables_by_tree.values():
            node = nodes[0]
            while node["feature"] >= 0:
                value = values[int(node["feature"])]
                is_text = isinstance(node["category"], str)
                left = value != node["category"] if is_text else value <= node["threshold"]
                node = nodes[node["left"] if left else node["right"]]
            total += node["depth"] + float(forest.expected_path([node["rows"]])[0])
        want = -(2 ** (-total / len(tables_by_tree) / float(forest.expected_path([model.sample_rows])[0])))
        assert abs(got[i] - want) < 1e-9


def test_flagged_share_and_planted_outliers(spark, fitted):
    clean, _, spec, model = fitted
    offset = forest.score_offset(model.with_scores(clean), spec.contamination)
    model = model.with_offset(offset)
    share = model.with_scores(clean).agg(F.avg("is_anomaly")).first()[0]
    assert abs(share - spec.contamination) < 0.005
    planted = clean.limit(5).withColumns({"value": F.lit(9e6), "transaction_count": F.lit(9e3)})
    assert model.with_scores(planted).agg(F.min("is_anomaly")).first()[0] == 1
    assert (
        model.with_scores(planted).agg(F.max("raw_score")).first()[0]
        < model.with_scores(clean).agg(F.min("raw_score")).first()[0] + 0.05
    )


def test_forest_ignores_partitioning(fitted):
    clean, features, spec, model = fitted
    again = forest.fit_forest(clean.repartition(3), features, spec)
    keys = ["tree", "node"]
    pd.testing.assert_frame_equal(
        model.nodes.sort_values(keys, ignore_index=True), again.nodes.sort_values(keys, ignore_index=True)
    )


def test_samples_are_without_replacement_and_survive_copies(spark, fitted):
    clean, features, _, _ = fitted
    hot = clean.limit(1).select("*", F.explode(F.sequence(F.lit(1), F.lit(400)))).drop("col").unionByName(clean)
    samples, size = forest.draw_samples(hot, features, "transaction_id", 20, 64, 1)
    counts = samples.groupBy("tree").count().collect()
    assert len(counts) == 20 and {r["count"] for r in counts} == {64}


def test_model_round_trip(spark, fitted, tmp_path):
    clean, _, _, model = fitted
    model = model.with_offset(-0.5)
    model.save(spark, str(tmp_path / "model"))
    loaded = forest.IsolationForest.load(spark, str(tmp_path / "model"))
    a = model.with_scores(clean).select("transaction_id", "raw_score", "is_anomaly")
    b = loaded.with_scores(clean).select("transaction_id", "raw_score", "is_anomaly")
    assert a.exceptAll(b).isEmpty()


def test_expected_path_values():
    assert np.allclose(forest.expected_path([0, 1, 2, 256]), [0, 0, 1, 10.244770920], atol=1e-6)


# Whole job -----------------------------------------------------------------
def test_pipeline_recall_and_columns(spark, sf, run):
    scores = metrics(evaluate.evaluation_report(tables.seed_labels(spark, sf), run.issues))
    assert scores["missing_recall"] == 1.0 and scores["invalid_recall"] == 1.0
    assert scores["true_positive"] + scores["false_negative"] == tables.seed_labels(spark, sf).count()
    public = run.public_issues()
    assert tuple(public.columns) == rules.ISSUE_COLUMNS
    assert public.filter("confidence < 0 OR confidence > 1").isEmpty()
    assert run.issues.filter("issue_type = 'missing' AND suggested_value IS NULL").isEmpty()


def test_rule_issues_survive_the_pipeline(spark, sf, run):
    plain = rules.rule_issues(tables.dirty_transactions(spark, sf), tables.transactions_spec())
    kept = run.issues.filter("issue_type <> 'anomaly'")
    assert plain.select("issue_id").exceptAll(kept.select("issue_id")).isEmpty()
    assert kept.count() == plain.count()


def test_anomaly_records(run):
    rows = run.issues.filter("issue_type = 'anomaly'").collect()
    assert rows
    for r in rows:
        assert r["source_method"] == "isolation_forest+feature_contribution"
        if r["column_name"] in ("domain", "location"):
            assert (r["severity"], r["severity_score"]) == ("high", 0.5)
        elif r["current_num"] is None:
            assert (r["severity"], r["severity_score"]) == ("low", None)


def test_leave_one_out_finds_seeded_anomalies(spark, sf):
    spec = tables.transactions_spec().with_options(neighbours="leave_one_feature_out", n_estimators=60)
    found = pipeline.run_detection(tables.dirty_transactions(spark, sf), spec)
    scores = metrics(evaluate.evaluation_report(tables.seed_labels(spark, sf), found.issues))
    found.close()
    assert scores["anomaly_recall"] > 0.4


def test_fixing_everything_leaves_no_gap(spark, sf, run):
    fixed = run.fixed("auto")
    assert fixed.count() == run.table.count()
    again = rules.rule_issues(fixed, tables.transactions_spec(), ("missing",))
    assert again.isEmpty()


def test_missing_column_stops_the_job(spark, sf):
    with pytest.raises(SpecError):
        pipeline.run_detection(tables.dirty_transactions(spark, sf).drop("domain"), bank_spec())


def test_all_rows_flagged_still_runs(spark):
    spec = tables.transactions_spec().with_options(n_estimators=5, max_samples=16)
    rows = [(f"k{i}", "2020-01-01", "zzz", f"L{i % 3}", float(-i - 1), 1.0, float(-i - 1)) for i in range(30)]
    df = spark.createDataFrame(rows, "transaction_id string, date string, domain string, location string, value double, transaction_count double, avg_transaction_value double")
    result = pipeline.run_detection(df, spec)
    assert metrics(result.summary())["issue_type_invalid"] == 90
    stages = list(result._kept)
    assert stages and all(os.path.exists(p.removeprefix("file:")) for p in stages)
    result.close()
    assert not any(os.path.exists(p.removeprefix("file:")) for p in stages)


def test_raw_text_and_own_recommender(spark, sf):
    """Rules see the raw text; an own recommender fills what the built-in ones left open."""
    spec = tables.transactions_spec().with_options(n_estimators=10, id_is_unique=True)
    raw = tables.dirty_transactions(spark, sf).withColumns(
        {
            "date": F.col("date").cast("date").cast("string"),
            "value": F.when(F.col("transaction_id") == "T00000007", "n/k").otherwise(F.col("value").cast("string")),
        }
    )

    def zero_for_text(findings, _):
        unread = F.col("reason").endswith("must be numeric.")
        return findings.withColumns(
            {
                "suggested_value": F.when(unread, "0").otherwise(F.col("suggested_value")),
                "suggested_num": F.when(unread, 0.0).otherwise(F.col("suggested_num")),
            }
        )

    result = pipeline.run_detection(raw, spec, coerce="after", recommenders=[zero_for_text])
    rows = result.issues.filter("row_id = 'T00000007' AND column_name = 'value' AND issue_type = 'invalid'").collect()
    assert [(r["current_value"], r["suggested_value"]) for r in rows] == [("n/k", "0")]
    assert result.fixed("auto").filter("transaction_id = 'T00000007'").first()["value"] == "0"
    stages = [r["issue_seq"] for r in rules.in_issue_order(result.issues).collect()]
    assert stages == sorted(stages)
    result.close()


def test_run_is_written(spark, run, tmp_path):
    places = pipeline.write_run(run, FileSink(str(tmp_path), "csv"), fix_mode="conservative")
    assert set(places) == {"detected_issues", "recommendations", "final_report", "dataset_profile", "fixed_data"}
    back = FileSource(places["detected_issues"], "csv").read(spark)
    assert back.count() == run.issues.count() and tuple(back.columns) == rules.ISSUE_COLUMNS
    report_rows = FileSource(places["final_report"], "csv").read(spark).collect()
    assert report_rows[0]["metric"] == "total_issues"


# Reports ---------------------------------------------------------------------
def test_summary_of_nothing(spark, sf):
    empty = rules.rule_issues(tables.dirty_transactions(spark, sf).limit(0), tables.transactions_spec())
    assert [(r["metric"], r["value"]) for r in report.issue_summary(empty).collect()] == [("total_issues", 0.0)]
    assert report.recommendations(empty).columns == list(report.RECOMMENDATION_COLUMNS)


def test_summary_reads_the_table_once(spark, sf, tmp_path):
    path = str(tmp_path / "table")
    tables.dirty_transactions(spark, sf).write.parquet(path)
    issues = rules.rule_issues(spark.read.parquet(path), tables.transactions_spec())
    plan = report.issue_summary(issues)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == 1


def test_written_issues_are_in_order(run):
    kept = [(r["issue_seq"], r["row_id"]) for r in run.issues.select("issue_seq", "row_id").collect()]
    shown = [r["row_id"] for r in run.public_issues().collect()]
    assert shown == [row for _, row in sorted(kept)]


def test_summary_order(run):
    names = [r["metric"] for r in run.summary().collect()]
    assert names[0] == "total_issues" and names[-2:] == ["average_confidence", "fixable_rate"]
    values = metrics(run.summary())
    types = [values[n] for n in names if n.startswith("issue_type_")]
    assert types == sorted(types, reverse=True) and sum(types) == values["total_issues"]


def test_profile(spark):
    df = spark.createDataFrame(
        [("a", 1.0, True), ("b", float("nan"), None), ("b", None, False)], "s string, n double, b boolean"
    )
    issues = spark.createDataFrame([("n", "anomaly"), ("n", "invalid"), ("n", "missing")], "column_name string, issue_type string")
    rows = {r["column_name"]: r.asDict() for r in report.column_profile(df, issues).collect()}
    assert rows["n"] == dict(
        column_name="n", missing_count=2, missing_rate=0.6667, unique_count=1, min=1.0, max=1.0,
        issue_count=3, anomaly_count=1, invalid_count=1,
    )
    assert rows["s"]["unique_count"] == 2 and rows["s"]["min"] is None and rows["s"]["issue_count"] == 0
    assert (rows["b"]["min"], rows["b"]["max"]) == (0.0, 1.0)
    assert report.column_profile(df, issues, approx_unique=True).count() == 3
    assert report.column_profile(df.limit(0), issues).first()["missing_rate"] == 0.0


def test_profile_does_not_multiply_rows(spark):
    nan = float("nan")
    df = spark.createDataFrame(
        [(1.0, "a", {"k": 1}), (nan, "a", None), (0.0, None, None), (-0.0, "b", {"k": 2})],
        "x double, s string, m map<string,int>",
    )
    issues = spark.createDataFrame([], "column_name string, issue_type string")
    profile = report.column_profile(df, issues)
    assert "Expand" not in profile._jdf.queryExecution().executedPlan().toString()
    got = {r["column_name"]: (r["missing_count"], r["unique_count"], r["min"], r["max"]) for r in profile.collect()}
    assert got == {"x": (1, 2, 0.0, 1.0), "s": (1, 2, None, None), "m": (2, None, None, None)}
    assert [r["column_name"] for r in report.column_profile(df, issues, columns=["m", "x"]).collect()] == ["x", "m"]
    empty = report.column_profile(df.limit(0), issues).filter("column_name = 's'").first()
    assert (empty["missing_count"], empty["missing_rate"], empty["unique_count"]) == (0, 0.0, 0)


def test_evaluation_counts(spark):
    schema = "row_id string, column_name string, issue_type string"
    truth = spark.createDataFrame([("1", "a", "missing"), ("1", "a", "missing"), ("2", "a", "invalid")], schema)
    found = spark.createDataFrame([("1", "a", "missing"), ("3", "a", "anomaly"), ("3", "a", "anomaly")], schema)
    got = metrics(evaluate.evaluation_report(truth, found))
    assert (got["true_positive"], got["false_positive"], got["false_negative"]) == (1, 1, 1)
    assert (got["precision"], got["recall"], got["f1_score"]) == (0.5, 0.5, 0.5)
    assert (got["missing_f1_score"], got["anomaly_precision"], got["invalid_recall"]) == (1.0, 0.0, 0.0)
    assert len(got) == 6 + 18


# Sources -----------------------------------------------------------------------
def test_csv_keeps_blanks_and_drops_na(spark, tmp_path):
    df = spark.createDataFrame([(" a ", 'q"x,y'), ("NA", ""), (None, "None")], "x string, y string")
    path = FileSink(str(tmp_path), "csv").write(df, "t")
    rows = FileSource(path, "csv", schema=text_schema(["x", "y"])).read(spark).collect()
    assert {(r["x"], r["y"]) for r in rows} == {(" a ", 'q"x,y'), (None, None)}
    assert len(rows) == 3


def test_conversion_between_formats(spark, tmp_path, sf):
    source = FileSource(f"{sf}/nation.parquet", "parquet")
    schema = source.read(spark).schema
    path = convert(spark, source, FileSink(str(tmp_path), "json"), "nation")
    back = FileSource(path, "json", schema=schema).read(spark)
    assert back.exceptAll(source.read(spark)).isEmpty() and back.count() == 25


def test_jdbc_options():
    table = JdbcTable("jdbc:x", "orders", {"user": "u"}, partition_column="id", lower=0, upper=100, partitions=4)
    options = table.read_options()
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "4" and options["dbtable"] == "orders"
    assert "partitionColumn" not in JdbcTable("jdbc:x", "t").read_options()
    assert table.write_options("out")["dbtable"] == "out"
    with pytest.raises(ValueError):
        JdbcTable("jdbc:x", "t", partition_column="id").read_options()


def test_scratch_folder_comes_from_the_session(spark):
    folder = checkpoint_folder(spark)
    assert folder == spark.sparkContext.getCheckpointDir()


def test_every_check_has_a_query():
    from checks import oracles

    assert set(oracles.statements()) <= set(workloads.registered())


def test_run_on_given_scores(spark, sf):
    """A given score takes the forest's place; a repair then reaches missing and anomalous cells."""
    dirty = tables.dirty_transactions(spark, sf)
    spec = tables.transactions_spec().with_options(neighbours="exclude_self")
    run = pipeline.run_detection(dirty, spec, given_score="CASE WHEN value >= 20000 THEN -value END")
    assert run.model is None
    unscored = run.scores.filter("raw_score IS NULL")
    assert unscored.count() and unscored.filter("is_anomaly = 1").count() == 0
    assert {r[0] for r in run.issues.select("issue_type").distinct().collect()} == {"missing", "invalid", "anomaly"}
    fixed = run.fixed("auto")
    assert fixed.count() == dirty.count()
    assert fixed.filter("domain IS NULL OR location IS NULL OR value IS NULL OR transaction_count IS NULL").count() == 0
    run.close()
