"""Keyed sets by a filter: what passes, what is shuffled, and that results stay exact."""

import pytest
from pyspark.sql import functions as F

from cellsift import ColumnRule, QualitySpec
from cellsift.operators import bloom, repair, rules

SPEC = QualitySpec(
    "t", "id", {"id": ColumnRule("id"), "n": ColumnRule("numeric", min_value=0)}, cross_field=(),
)


@pytest.mark.parametrize("most", [bloom.MOST_BLOCKS, 1])
def test_filter(spark, most):
    ids = spark.range(0, 60_000, 3).select(bloom.id_key(F.col("id")).alias("k"))
    found = bloom.IdFilter(ids, most)
    rows = spark.range(60_000).withColumn("_bits", F.lit("own"))
    hit = found.marked(rows, bloom.id_key(F.col("id")), "hit")
    assert hit.columns == ["id", "_bits", "hit"]
    assert hit.where("id % 3 = 0 and not hit").count() == 0
    chance = hit.where("id % 3 <> 0 and hit").count() / 40_000
    assert chance < 0.05 or most == 1


def test_no_ids(spark):
    none = bloom.IdFilter(spark.createDataFrame([], "k string"))
    assert none.marked(spark.range(5), bloom.id_key(F.col("id")), "hit").where("hit").count() == 0


def table(spark):
    rows = [(str(i % 4000), float(i % 7) if i % 997 else -1.0) for i in range(20_000)] + [(None, 1.0)] * 3
    return spark.createDataFrame(rows, "id string, n double").repartition(4)


def test_clean_rows(spark):
    df = table(spark)
    bad = {r.id for r in df.where("n < 0").collect()}
    want = sorted(((r.id, r.n) for r in df.collect() if r.id not in bad), key=repr)
    assert sorted(map(tuple, rules.clean_rows(df, SPEC).collect()), key=repr) == want
    marked = rules.mark_clean(df, SPEC)
    assert marked.count() == df.count()
    assert sorted(((r.id, r.n) for r in marked.where("is_clean").collect()), key=repr) == want


def test_spoiled_null_ids(spark):
    df = spark.createDataFrame([(None, -1.0), (None, 1.0), ("n", 1.0), ("v", 2.0)], "id string, n double")
    assert sorted(r.id for r in rules.clean_rows(df, SPEC).collect()) == ["n", "v"]
    # No clean row at all: every row.
    assert rules.clean_rows(df.where("id is null"), SPEC).count() == 2


def test_only_hits_are_shuffled(spark, tmp_path):
    """Rows that are surely clean have no exchange above their scan; only the hits meet the anti-join."""
    path = str(tmp_path / "t")
    table(spark).write.parquet(path)
    clean = rules.clean_rows(spark.read.parquet(path), SPEC)
    plan = clean._jdf.queryExecution().optimizedPlan()
    assert plan.nodeName() == "Union"
    surely, asked = (plan.children().apply(k).toString() for k in range(2))
    assert "LeftAnti" not in surely and asked.count("LeftAnti") == 1
    # The flag is tested below the anti-join.
    assert asked.index("LeftAnti") < asked.index("shiftright")
    # Rows with one of the 20 spoiled ids, and few others.
    df = spark.read.parquet(path)
    spoiled = rules._spoiled(rules.with_findings(df, SPEC), SPEC, None)
    hit = spoiled.marked(df, bloom.id_key(F.col("id")), "hit").where("hit").count()
    true = df.join(spoiled.ids, bloom.id_key(F.col("id")) == F.col("_spoiled")).count()
    assert true <= hit <= true + 0.05 * 20_000


def test_repairs_pass_other_rows(spark):
    df = table(spark)
    issues = rules.rule_issues(df, SPEC).withColumns({"suggested_value": F.lit("5"), "suggested_num": F.lit(5.0)})
    fixed = repair.apply_fixes(df, issues, SPEC, "auto")
    bad = {r.id for r in df.where("n < 0").collect()}
    want = sorted(((r.id, 5.0 if r.id in bad else r.n) for r in df.collect()), key=repr)
    assert sorted(map(tuple, fixed.collect()), key=repr) == want
