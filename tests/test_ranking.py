"""Exact ranks, quantiles, sampling and seeding."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellsift.operators import ranking, seed
from cellsift.operators.features import label_encode
from cellsift.plans import tables
from cellsift.spec import bank_spec


def test_positions_follow_the_order(spark):
    df = spark.range(1000).repartition(7).withColumn("x", F.col("id") * 3 % 1009)
    rows = ranking.row_positions(df, "pos", ["x"]).collect()
    assert [r["pos"] for r in sorted(rows, key=lambda r: r["x"])] == list(range(1000))


def test_positions_without_order_are_dense(spark):
    df = spark.range(100).repartition(5).filter("id % 3 = 0")
    assert sorted(r["pos"] for r in ranking.row_positions(df, "pos").collect()) == list(range(34))


@pytest.mark.parametrize("n", [0, 1, 37, 500, 800])
def test_sample_has_the_exact_size_and_order(spark, n):
    df = spark.range(500).select(F.concat(F.lit("k"), "id").alias("id"))
    got = {r["id"] for r in seed.sample_exact(df, "id", n, seed=7).collect()}
    keys = sorted((f"k{i}" for i in range(500)), key=lambda k: hashlib.md5(f"7:{k}".encode()).hexdigest())
    assert got == set(keys[:n])


def test_threshold_narrows_shared_prefixes(spark):
    """Hashes that share long prefixes are told apart by the later passes."""
    hashes = ["abc" + "0" * 26 + f"{i:03x}" for i in range(50)] + ["f" * 32]
    df = spark.createDataFrame([(h,) for h in hashes], "h string")
    (bound,) = ranking.hash_thresholds(df, F.col("h"), lambda n: [17])
    assert df.filter(F.col("h") <= bound).count() == 17


@pytest.mark.parametrize("hot", ["k", None])
def test_hot_ids_are_narrowed_in_spark(spark, monkeypatch, hot):
    """A rank inside an id with many distinct rows brings a bounded number of groups to the driver."""
    df = spark.range(20_000).select(F.when(F.col("id") % 4 > 0, F.lit(hot)).otherwise(F.col("id").cast("string")).alias("k"), "id")
    sizes, collect = [], type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: sizes.append(len(rows := collect(self))) or rows)
    order = ranking.row_order(42, F.col("k"), df.columns)
    texts = sorted(r["h"] for r in collect(df.select(order.alias("h"))))
    key = hashlib.md5(f"42:{hot or ''}".encode()).hexdigest()
    first = next(i for i, h in enumerate(texts) if h.startswith(key))
    ranks = [first + 1, first + 5_000, first + 12_345]
    marks = ranking.hash_cuts(df, order, lambda n: ranks)
    assert [sum(h <= m.bound for h in texts) for m in marks] == ranks and not any(m.left for m in marks)
    assert max(sizes) <= len(ranks) * 16**3
    sizes.clear()
    ids = {r["id"] for r in collect(seed.sample_exact(df, "k", first + 5_000))}
    assert len(ids) == first + 5_000 and max(sizes) <= 16**3


def test_equal_hashes_stay_together(spark):
    df = spark.createDataFrame([("a" * 32,)] * 5 + [("b" * 32,)] * 5, "h string")
    bounds = ranking.hash_thresholds(df, F.col("h"), lambda n: [3, 5, 9, 10])
    sizes = [0 if b is None else df.filter(F.col("h") <= b).count() for b in bounds]
    assert sizes == [0, 5, 5, 10]


@pytest.mark.parametrize("kind", ["smooth", "hot", "tails"])
def test_large_quantiles_equal_numpy(spark, monkeypatch, kind):
    # Small brackets of a coarse sketch, so that every step of the search is taken.
    monkeypatch.setattr(ranking, "BRACKET_ROWS", 50)
    monkeypatch.setattr(ranking, "SKETCH_ACCURACY", 200)
    rng = np.random.default_rng(3)
    if kind == "smooth":
        x = rng.normal(size=5000)
    elif kind == "hot":
        x = np.where(rng.random(5000) < 0.4, 1.0, np.round(rng.normal(size=5000), 2))
    else:
        x = np.concatenate([np.zeros(2400), np.ones(2400), rng.random(200)])
    df = spark.createDataFrame([(float(v),) for v in x], "x double").repartition(4)
    wanted = [0.0, 0.08, 0.45, 0.5, 0.52, 1.0]
    got = ranking.exact_quantiles(df, {"x": wanted})["x"]
    assert np.allclose(got, np.quantile(x, wanted), atol=1e-12)


@pytest.mark.parametrize("rows", [1, 2, 7, 300, 5000, 60_000])
def test_quantiles_take_three_scans(spark, monkeypatch, rows):
    rng = np.random.default_rng(rows)
    x, y = rng.normal(size=rows), np.round(rng.exponential(size=rows), 1)
    kept = rng.random(rows) < 0.8
    data = [(float(a), float(b) if k else None, None) for a, b, k in zip(x, y, kept)]
    df = spark.createDataFrame(data, "x double, y double, z double").repartition(3).cache()
    scans = []
    for action in ("first", "collect"):
        real = getattr(type(df), action)
        monkeypatch.setattr(type(df), action, lambda self, *a, real=real: scans.append(1) or real(self, *a))
    wanted = [0.0, 0.08, 0.5, 0.999, 1.0]
    got = ranking.exact_quantiles(df, {"x": wanted, "y": wanted, "z": [0.5]})
    monkeypatch.undo()
    assert np.allclose(got["x"], np.quantile(x, wanted), atol=1e-12)
    assert got["z"] == [None]
    if kept.any():
        assert np.allclose(got["y"], np.quantile(y[kept], wanted), atol=1e-12)
    # ``first`` collects too: at most two calls for each of the first two scans.
    assert len(scans) <= 5 + 2
    df.unpersist()


def test_most_frequent_prefers_the_smaller(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("b", None), ("a", None), ("c", None)], "x string, y string")
    assert ranking.most_frequent(df, ["x", "y"]) == {"x": "a", "y": None}


def test_seeded_faults_add_up(spark, sf):
    clean = tables.transactions(spark, sf)
    dirty, labels = tables.seeded_transactions(spark, sf)
    n = clean.count()
    assert dirty.count() == n
    kinds = {r["issue_type"]: r["count"] for r in labels.groupBy("issue_type").count().collect()}
    assert kinds == dict(zip(("missing", "invalid", "anomaly"), seed.part_sizes(int(n * 0.2))))
    assert labels.select("row_id").distinct().count() == labels.count()
    # Each changed cell has a label and the other way round.
    both = clean.alias("c").join(dirty.alias("d"), "transaction_id")
    changed = 0
    for c in ("domain", "location", "value", "transaction_count"):
        changed += both.filter(~F.col(f"c.{c}").eqNullSafe(F.col(f"d.{c}"))).count()
    idle = labels.filter("original_num = dirty_num").count()
    assert changed == labels.count() - idle


def test_seeding_ignores_partitioning(spark, sf):
    clean, spec = tables.transactions(spark, sf), tables.transactions_spec()
    one, _ = seed.seed_faults(clean.repartition(1), spec)
    many, _ = seed.seed_faults(clean.repartition(9), spec)
    assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()


@pytest.mark.parametrize("rate", [0.2, 0.85, 1.0])
@pytest.mark.parametrize("hot", ["k", "k3", None])
def test_seeding_counts_equal_rows(spark, rate, hot):
    """Equal rows that a rank falls into get exactly the faults that are left of each kind."""
    rows = [(hot, "a", "x", 5.0, 2)] * 900 + [(f"r{i}", "a", "x", 5.0, 2) for i in range(100)]
    df = spark.createDataFrame(rows, "transaction_id string, domain string, location string, value double, transaction_count int")
    dirty, labels = seed.seed_faults(df.repartition(6), tables.transactions_spec(), rate=rate)
    kinds = {r["issue_type"]: r["count"] for r in labels.groupBy("issue_type").count().collect()}
    n = int(1000 * rate)
    assert kinds == dict(zip(("missing", "invalid", "anomaly"), seed.part_sizes(n)))
    assert dirty.count() == 1000 and dirty.exceptAll(df).count() == n
    assert dirty.filter(F.col("transaction_id").eqNullSafe(hot)).count() == 900


def test_part_sizes():
    assert seed.part_sizes(2000) == [667, 667, 666]
    assert seed.part_sizes(2) == [1, 1, 0]


def test_scaling_skips_cells_that_are_no_numbers(spark):
    df = spark.createDataFrame([(f"k{i}", "x" if i % 2 else "2") for i in range(60)], "transaction_id string, value string")
    plan = seed.FaultPlan(missing=(), invalid={}, anomaly={"value": 10})
    dirty, labels = seed.seed_faults(df, tables.transactions_spec(), rate=1.0, plan=plan)
    hit = {r["row_id"] for r in labels.collect()}
    values = {r["transaction_id"]: r["value"] for r in dirty.collect()}
    assert hit and all(float(values[k]) == 20.0 for k in hit)
    assert all(values[f"k{i}"] == "x" for i in range(1, 60, 2))


def test_label_codes(spark):
    df = spark.createDataFrame([("1", "b"), ("2", "a"), ("3", "c"), ("4", "a")], "id string, g string")
    codes = {r["id"]: r["code"] for r in label_encode(df, "g", "code").collect()}
    assert codes == {"1": 1, "2": 0, "3": 2, "4": 0}
    fitted = df.filter("g <> 'c'")
    with pytest.raises(Exception, match="unseen label"):
        label_encode(df, "g", "code", fitted_on=fitted).collect()


def test_seeding_computes_its_table_once(spark):
    """Ranks, dirty table and labels start from written rows."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def amount(i):
        seen.add(1)
        return float(i)

    df = spark.range(300).select(F.concat(F.lit("T"), "id").alias("transaction_id"), amount("id").alias("value"))
    dirty, labels = seed.seed_faults(df, bank_spec(), rate=0.2, plan=seed.FaultPlan(("value",), {"value": -1}, {"value": 10}))
    assert (dirty.count(), labels.count()) == (300, 60)
    assert seen.value == 300
