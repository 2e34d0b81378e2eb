"""Columns judged by neighbours found without them, all in one index."""

import numpy as np
from pyspark.sql import functions as F

from cellsift import ColumnRule, QualitySpec
from cellsift.operators import attribute
from cellsift.operators.features import FittedFeatures, NumericStats, fit_features
from cellsift.operators.neighbours import NeighbourIndex

SPEC = QualitySpec(
    table_name="t", id_column="id", cross_field=(), knn_neighbors=3,
    rules={
        "id": ColumnRule("id", use_for_detection=False), "a": ColumnRule("numeric"), "b": ColumnRule("numeric"),
        "g": ColumnRule("categorical"),
    },
)
SCHEMA = "id string, a double, b double, g string"


def table(spark, seed, n, prefix):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        a = float(np.round(rng.normal(), 1))
        rows.append((f"{prefix}{i:03d}", a, float(np.round(2 * a + rng.normal() / 9, 1)), "x" if a < 0 else "y"))
    return spark.createDataFrame(rows, SCHEMA), rows


def column_by_column(df, reference, features, spec):
    """A search of its own for every column."""
    out = {}
    for c in attribute.attributable_columns(df, spec):
        index = NeighbourIndex(reference, features.without(spec.related_columns(c)), "id", [c], spec.knn_neighbors)
        near = index.k_nearest(df, exclude_self="id", name="_near")
        wide = attribute.with_neighbour_values(near, spec, "_near", [c])
        for r in wide.withColumn("odd", attribute.is_suspicious(wide, spec, c)).collect():
            out.setdefault((r["id"], r["a"], r["b"], r["g"]), set()).update({c} if r["odd"] else set())
        index.close()
    return out


def test_one_index_equals_a_search_for_each_column(spark):
    reference, known = table(spark, 1, 120, "r")
    odd = known[:20] + [
        ("o1", 9.0, 0.0, "x"), ("o2", 0.5, -7.0, "y"), ("o3", -1.0, -2.0, "y"), ("o4", None, 1.0, "x"),
        ("o5", 1.0, 2.0, None), ("o6", 1.0, 2.0, "unseen"), ("o7", None, None, None),
        ("same", 9.0, 9.0, "x"), ("same", 0.0, 0.0, "y"), (None, 0.1, 5.0, ""),
    ]
    rows = spark.createDataFrame(odd, SCHEMA).withColumn("more", F.lit(1))
    features = fit_features(reference, SPEC)
    got = attribute.suspicious_columns_left_out(rows, reference, features, SPEC)
    assert got.columns == [*rows.columns, "suspects"] and got.count() == len(odd)
    found = {(r["id"], r["a"], r["b"], r["g"]): r["suspects"] for r in got.collect()}
    want = column_by_column(rows, reference, features, SPEC)
    assert {k: set(v) for k, v in found.items()} == want
    assert all(v == sorted(v) for v in found.values()) and any(found.values())


def test_fewer_rows_than_neighbours(spark):
    """Copies made for other columns never fill up the neighbours of a column."""
    reference, _ = table(spark, 2, 2, "r")
    rows = spark.createDataFrame([("q", 50.0, 50.0, "x"), ("p", None, 1.0, "y")], SCHEMA)
    features = FittedFeatures({c: NumericStats(0.0, 0.0, 1.0) for c in "ab"}, {"g": "x"})
    got = attribute.suspicious_columns_left_out(rows, reference, features, SPEC)
    want = column_by_column(rows, reference, features, SPEC)
    assert {r["id"]: set(r["suspects"]) for r in got.collect()} == {k[0]: v for k, v in want.items()}


def test_column_without_other_features(spark):
    reference, _ = table(spark, 3, 30, "r")
    rows = spark.createDataFrame([("q", 50.0, 1.0, "x"), ("p", None, 1.0, "y")], SCHEMA)
    features = FittedFeatures({"a": NumericStats(0.0, 0.0, 1.0)}, {})
    got = attribute.suspicious_columns_left_out(rows, reference, features, SPEC)
    suspects = {r["id"]: r["suspects"] for r in got.collect()}
    assert "a" not in suspects["q"] and "a" in suspects["p"]


def test_verdicts_name_each_statistic_once(spark):
    """The statistics of the neighbours are not written out again for every place that names them."""
    near = "array<struct<dist2:double,key:string,a:double,b:double,g:string>>"
    rows = [
        (0, 0, 9.0, 1.0, "x", [(0.0, "r", 1.0, None, None)] * 3), (0, 1, 9.0, 1.0, "x", [(0.0, "r", None, 1.0, None)] * 3),
        (0, 2, 9.0, 1.0, "x", [(0.0, "r", None, None, "y")] * 3), (1, 0, 1.0, 1.0, "x", [(0.0, "r", 1.0, None, None)] * 3),
        (1, 2, 1.0, 1.0, None, []), (2, 0, 1.0, 1.0, "x", None),
    ]
    table = spark.createDataFrame(rows, f"_row long, _view int, a double, b double, g string, _near {near}")
    table = table.repartition(1).withColumn("_near", F.filter(F.reverse("_near"), lambda n: n["dist2"] < 1))
    got = attribute.odd_views(table, SPEC, dict(enumerate("abg")))
    assert {r["_row"]: sorted(r["_odd"]) for r in got.collect()} == {0: [0, 2], 1: [2]}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_odd" in plan and plan.count("reverse(") == 1
