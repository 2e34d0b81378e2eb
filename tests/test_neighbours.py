"""Neighbour join against brute force, on fixtures with ties, hot points and unknowns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellsift import ColumnRule, QualitySpec, SpecError
from cellsift.operators import leaf_cells, neighbours
from cellsift.operators.features import FittedFeatures, NumericStats, fit_features
from cellsift.operators.neighbours import NeighbourIndex, cut_space
from cellsift.sources.scratch import cut_lineage

FEATURES = FittedFeatures({"a": NumericStats(0.0, 0.0, 1.0), "b": NumericStats(0.0, 0.0, 1.0)}, {"g": "x"})


def brute(reference, queries, k, exclude_self=False):
    out = {}
    for q in queries:
        near = []
        for r in reference:
            if exclude_self and r["id"] == q["id"]:
                continue
            d = sum(((q[c] or 0.0) - (r[c] or 0.0)) ** 2 for c in ("a", "b"))
            g = q["g"] or "x"
            known = g in {x["g"] or "x" for x in reference}
            d += 1.0 if not known else (0.0 if g == (r["g"] or "x") else 2.0)
            near.append((round(d, 9), r["id"]))
        out[q["id"]] = sorted(near)[:k]
    return out


def found(rows):
    return {r["id"]: [(n["dist2"], n["key"]) for n in r["neighbours"]] for r in rows.collect()}


def random_rows(seed, n, prefix, hot=0.0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        if rng.random() < hot:
            rows.append((f"{prefix}{i:05d}", 0.5, 0.5, "x"))
        else:
            a, b = np.round(rng.standard_t(2, 2), 1)
            rows.append((f"{prefix}{i:05d}", float(a), float(b), str(rng.choice(["x", "y", "z"]))))
    return rows


SCHEMA = "id string, a double, b double, g string"


@pytest.mark.parametrize("hot", [0.0, 0.4])
@pytest.mark.parametrize("exclude_self", [False, True])
def test_equals_brute_force(spark, hot, exclude_self):
    reference = random_rows(1, 600, "r", hot)
    queries = reference[:80] + random_rows(2, 60, "q") + [
        ("far", 900.0, -900.0, "x"), ("odd", 0.1, 0.1, "unseen"), ("gap", None, 0.2, None)
    ]
    ref, qry = spark.createDataFrame(reference, SCHEMA), spark.createDataFrame(queries, SCHEMA)
    index = NeighbourIndex(ref, FEATURES, "id", ["a", "g"], 5, leaf_rows=32)
    assert index._cuts.leaves > 4
    got = found(index.k_nearest(qry, exclude_self="id" if exclude_self else None))
    want = brute([r.asDict() for r in ref.collect()], [q.asDict() for q in qry.collect()], 5, exclude_self)
    assert got == want
    index.close()


def test_split_leaves_and_query_chunks(spark, monkeypatch):
    """Groups are cut small on both sides; the answer stays the same."""
    monkeypatch.setattr(neighbours, "MAX_GROUP_REFERENCE", 20)
    monkeypatch.setattr(neighbours, "MAX_GROUP_QUERIES", 7)
    monkeypatch.setattr(neighbours, "MAX_KNOWN_LITERALS", 1)
    reference, queries = random_rows(3, 300, "r"), random_rows(4, 90, "q")
    ref, qry = spark.createDataFrame(reference, SCHEMA), spark.createDataFrame(queries, SCHEMA)
    index = NeighbourIndex(ref, FEATURES, "id", [], 4, leaf_rows=100)
    want = brute([r.asDict() for r in ref.collect()], [q.asDict() for q in qry.collect()], 4)
    assert found(index.k_nearest(qry)) == want


def test_equal_numbers_are_not_cut():
    """Their computed variance is above 0."""
    for number in (0.1, 1e100):
        assert cut_space(np.full((7, 1), number), 1, 4).leaves == 1


@pytest.mark.parametrize("max_leaves", [1, 3])
def test_large_leaves_have_a_second_level(spark, monkeypatch, max_leaves):
    """Few leaves, small cells, two children of a cell in a level: the answer stays the same."""
    monkeypatch.setattr(leaf_cells, "FAN_OUT", 4)
    monkeypatch.setattr(neighbours, "MAX_GROUP_REFERENCE", 50)
    monkeypatch.setattr(neighbours, "MAX_GROUP_QUERIES", 20)
    reference = random_rows(11, 500, "r", 0.2)
    queries = reference[:40] + random_rows(12, 60, "q") + [("far", 900.0, -900.0, "x"), ("odd", 0.1, 0.1, "unseen")]
    ref, qry = spark.createDataFrame(reference, SCHEMA), spark.createDataFrame(queries, SCHEMA)
    index = NeighbourIndex(ref, FEATURES, "id", ["a", "g"], 5, leaf_rows=16, max_leaves=max_leaves, max_leaf_rows=30)
    sizes = index.rows.groupBy("_leaf", "_cell").count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] <= 30 and sizes[1] > 16 and index._boxes.leaves <= max_leaves
    want = brute([r.asDict() for r in ref.collect()], [q.asDict() for q in qry.collect()], 5)
    assert found(index.k_nearest(qry)) == want
    index.close()


def test_points_that_no_cut_separates_stay_one_cell(spark):
    """Equal coordinates end the cutting; the rows of the cell still meet in bounded groups."""
    ref = spark.createDataFrame([(f"r{i:02d}", 1.0, 1.0, "x") for i in range(40)], SCHEMA)
    index = NeighbourIndex(ref, FEATURES, "id", [], 5, leaf_rows=2, max_leaves=2, max_leaf_rows=3)
    assert index.rows.select("_leaf", "_cell").distinct().count() == 1 and index.rows.count() == 6
    got = found(index.k_nearest(spark.createDataFrame([("q", 2.0, 1.0, "x")], SCHEMA)))
    assert got == {"q": [(1.0, f"r{i:02d}") for i in range(5)]}
    index.close()


def test_partitioning_does_not_matter(spark):
    ref = spark.createDataFrame(random_rows(5, 400, "r", 0.3), SCHEMA)
    qry = spark.createDataFrame(random_rows(6, 50, "q"), SCHEMA)
    one = found(NeighbourIndex(ref.repartition(1), FEATURES, "id", [], 5, leaf_rows=40).k_nearest(qry))
    many = found(NeighbourIndex(ref.repartition(8), FEATURES, "id", [], 5, leaf_rows=70).k_nearest(qry.repartition(3)))
    assert one == many


def test_hot_point_is_thinned_before_the_shuffle(spark):
    ref = spark.createDataFrame(random_rows(7, 500, "r", 0.9), SCHEMA)
    index = NeighbourIndex(ref, FEATURES, "id", [], 5)
    hot = index.rows.filter("z__a = 0.5 AND z__b = 0.5 AND c__g = 'x'").count()
    assert hot == 6
    plan = index._first_per_point(ref.select(*FEATURES.columns(ref), F.col("id").alias("_key")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text and "Partial" in text


def test_fewer_rows_than_neighbours(spark):
    ref = spark.createDataFrame(random_rows(8, 3, "r"), SCHEMA)
    got = found(NeighbourIndex(ref, FEATURES, "id", [], 5).k_nearest(ref, exclude_self="id"))
    assert all(len(near) == 2 for near in got.values())


def test_shared_ids_lose_only_one_entry(spark):
    ref = spark.createDataFrame([("a", 0.0, 0.0, "x"), ("a", 0.0, 0.0, "x"), ("b", 1.0, 0.0, "x")], SCHEMA)
    got = NeighbourIndex(ref, FEATURES, "id", [], 2).k_nearest(ref.filter("id = 'a'"), exclude_self="id").collect()
    assert [[n["key"] for n in r["neighbours"]] for r in got] == [["a", "b"], ["a", "b"]]


def test_rows_of_one_id_are_split(spark):
    rows = [("same", a, b, g) for _, a, b, g in random_rows(7, 400, "r")]
    index = NeighbourIndex(spark.createDataFrame(rows, SCHEMA), FEATURES, "id", ["a"], 3, leaf_rows=1000)
    part = neighbours.part_of(["_key", *FEATURES.names], F.lit(8))
    sizes = [r["count"] for r in index.rows.groupBy(part).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 0.3 * sum(sizes)
    index.close()


def test_no_queries_give_no_rows(spark):
    ref = spark.createDataFrame(random_rows(11, 200, "r"), SCHEMA)
    index = NeighbourIndex(ref, FEATURES, "id", ["a"], 5, leaf_rows=40)
    written = cut_lineage(index.k_nearest(ref.filter("a > 1e9")))
    assert written.isEmpty() and "neighbours" in written.columns


def test_no_features_is_an_error(spark):
    ref = spark.createDataFrame(random_rows(9, 3, "r"), SCHEMA)
    with pytest.raises(SpecError):
        NeighbourIndex(ref, FittedFeatures({}, {}), "id", [], 5)


def test_cuts_separate_equal_halves():
    points = np.column_stack([np.arange(64.0), np.zeros(64)])
    cuts = cut_space(points, 2, 8)
    assert cuts.leaves == 8
    assert set(np.bincount(cuts.locate(points))) == {8}
    same = cut_space(np.zeros((10, 2)), 2, 4)
    assert same.leaves == 1


def test_feature_fitting(spark):
    spec = QualitySpec(
        "t", "id",
        {"id": ColumnRule("id"), "n": ColumnRule("numeric"), "flat": ColumnRule("numeric"), "none": ColumnRule("numeric"), "g": ColumnRule("categorical")},
    )
    df = spark.createDataFrame(
        [("1", 1.0, 7.0, None, "b"), ("2", 2.0, 7.0, None, "a"), ("3", None, 7.0, None, None), ("4", 6.0, 7.0, None, "a"), ("5", 9.0, 7.0, None, "b")],
        "id string, n double, flat double, none double, g string",
    )
    fitted = fit_features(df, spec)
    assert list(fitted.numeric) == ["n", "flat"] and fitted.categorical == {"g": "a"}
    # The gap counts as the median, and the deviation is that of a population.
    values = np.array([1.0, 2.0, 4.0, 6.0, 9.0])
    assert fitted.numeric["n"].median == 4.0
    assert abs(fitted.numeric["n"].mean - values.mean()) < 1e-12
    assert abs(fitted.numeric["n"].std - values.std()) < 1e-12
    row = fitted.transform(df).filter("id = '3'").first()
    assert row["c__g"] == "a" and row["z__flat"] == 0.0


def test_self_included_caps_the_z_score(spark):
    """With itself among k = 5 neighbours no value can be more than 2 deviations off."""
    ref = spark.createDataFrame(random_rows(10, 300, "r"), SCHEMA)
    near = NeighbourIndex(ref, FEATURES, "id", ["a"], 5).k_nearest(ref)
    worst = near.select(
        F.expr("neighbours.a").alias("v"), "a"
    ).collect()
    z = [abs(r["a"] - np.mean(r["v"])) / np.std(r["v"]) for r in worst if np.std(r["v"]) > 0]
    assert max(z) <= 2.0 + 1e-9
