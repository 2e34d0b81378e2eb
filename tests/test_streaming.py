"""Rule checks and scoring on a stream equal those on the batch."""

from cellsift.operators import forest, rules
from cellsift.operators.features import fit_features
from cellsift.plans import tables
from cellsift.streaming import findings


def test_stream_equals_batch(spark, sf, tmp_path):
    df, spec = tables.dirty_transactions(spark, sf), tables.transactions_spec()
    folder = str(tmp_path / "in")
    df.repartition(3).write.parquet(folder)
    stream = spark.readStream.schema(df.schema).parquet(folder)

    issues = findings.issue_stream(stream, spec)
    q = findings.write_available(issues, str(tmp_path / "issues"), str(tmp_path / "ck1"))
    assert q.awaitTermination(180)
    got = spark.read.parquet(str(tmp_path / "issues")).select("issue_id")
    want = rules.rule_issues(df, spec).select("issue_id")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()

    small = spec.with_options(n_estimators=10)
    clean = rules.clean_rows(df, spec)
    features = fit_features(clean, small)
    model = forest.fit_forest(clean, features, small).with_offset(-0.5)
    scored = findings.score_stream(stream, spec, model).select("transaction_id", "raw_score", "is_anomaly")
    q = findings.write_available(scored, str(tmp_path / "scores"), str(tmp_path / "ck2"))
    assert q.awaitTermination(180)
    batch = model.with_scores(df).select("transaction_id", "raw_score", "is_anomaly")
    assert spark.read.parquet(str(tmp_path / "scores")).exceptAll(batch).isEmpty()
