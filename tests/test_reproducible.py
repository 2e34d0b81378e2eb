"""Samples of exact size, models that ignore the layout, and infinite cells."""

import pytest
from pyspark.sql import functions as F

from cellsift.operators import forest, rules, seed
from cellsift.operators.features import fit_features
from cellsift.plans import tables
from cellsift.spec import SpecError, spec_from_dict


@pytest.mark.parametrize("n", [0, 1, 200, 901, 1000, 2000])
def test_sample_is_exact_on_shared_and_null_ids(spark, n):
    df = spark.range(1000).selectExpr("if(id < 900, 'x', if(id < 950, null, 'y')) as k", "id % 7 as v", "id % 450 as w")
    got = seed.sample_exact(df, "k", n)
    assert got.count() == min(n, 1000)
    # Never more copies of a row than there are.
    have = df.groupBy("k", "v", "w").count()
    more = got.groupBy("k", "v", "w").agg(F.count("*").alias("n"))
    cond = F.expr("a.k <=> b.k and a.v = b.v and a.w = b.w")
    assert more.alias("a").join(have.alias("b"), cond, "left").where("n > coalesce(count, 0)").isEmpty()


def test_sample_of_equal_rows(spark):
    df = spark.range(50).selectExpr("'same' as k")
    assert seed.sample_exact(df, "k", 17).count() == 17


def test_forest_ignores_partitions_beyond_its_pool(spark, sf):
    spec = tables.transactions_spec().with_options(n_estimators=4, max_samples=8)
    clean = rules.clean_rows(tables.transactions(spark, sf), tables.transactions_spec())
    features = fit_features(clean, spec)
    found = []
    for parts in (4, 8, 13):
        rows = clean.repartition(parts)
        model = forest.fit_forest(rows, features, spec)
        found.append(sorted(model.nodes.astype(str).agg("|".join, axis=1)))
    assert found[0] == found[1] == found[2]


def test_infinite_cells_are_reported_and_left_out(spark):
    spec = spec_from_dict({"table_name": "t", "id_column": "k", "columns": {"k": {"dtype": "id"}, "v": {"dtype": "numeric", "min_value": 0}}})
    text = spark.createDataFrame([("a", "inf"), ("b", "-Infinity"), ("c", "1"), ("d", "nan")], "k string, v string")
    number = spark.createDataFrame([("a", float("inf")), ("b", float("-inf")), ("c", 1.0)], "k string, v double")
    for df, want in ((text, {"a", "b", "d"}), (number, {"a", "b"})):
        issues = rules.rule_issues(df, spec).where("reason like '%must be numeric%'")
        assert {r.row_id for r in issues.collect()} == want
        stats = fit_features(df, spec.with_options()).numeric if hasattr(fit_features(df, spec), "numeric") else {}
        assert all(abs(s.mean) < 10 for s in stats.values())


def test_unknown_settings_are_refused():
    body = {"table_name": "t", "id_column": "k", "columns": {"v": {"dtype": "numeric", "minimum": 0}}}
    with pytest.raises(SpecError, match="minimum"):
        spec_from_dict(body)
