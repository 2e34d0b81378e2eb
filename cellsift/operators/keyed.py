"""Joins in which one key may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with this share of the rows or more is heavy; there are 1 / share of them at most.
HEAVY_SHARE = 1 / 256


def join_keyed(rows: DataFrame, keyed: DataFrame, key: str, weight: str, how: str = "inner") -> DataFrame:
    """``rows`` joined on ``key`` with ``keyed``, which has each key once and its rows in ``weight``.

    Rows of heavy keys meet a broadcast table of 256 rows at most and are not
    shuffled; the others shuffle. ``how`` is ``inner`` or ``left``. Both tables
    are read twice, so they should be written ones, or cheap.
    """
    total = keyed.agg(F.sum(weight)).first()[0]
    if not total:
        return rows.join(keyed, key, how)
    heavy = F.col(weight) >= max(1.0, total * HEAVY_SHARE)
    some = F.broadcast(keyed.where(heavy))
    others = rows.join(F.broadcast(keyed.where(heavy).select(key)), key, "left_anti")
    return rows.join(some, key).unionByName(others.join(keyed.where(~heavy), key, how))


def dealt(many: DataFrame, few: DataFrame, key: str, by: str) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join on ``key`` with a column ``_deal`` to join on as well.

    Keys with many rows in ``many`` are dealt out by the hash of ``by``; the rows
    of ``few`` with such a key are repeated for each deal. At most 256 keys are
    dealt out, so what is broadcast for it has 256 rows at most.
    """
    counts = many.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = many.count()
    deals = F.ceil(F.col("_n") / max(1.0, total * HEAVY_SHARE)).cast("int")
    heavy = F.broadcast(counts.where(F.col("_n") > max(1.0, total * HEAVY_SHARE)).select(key, deals.alias("_deals")))
    own = F.when(F.col("_deals").isNull(), 0).otherwise(F.pmod(F.xxhash64(by), "_deals")).cast("int")
    one = many.join(heavy, key, "left").withColumn("_deal", own).drop("_deals")
    every = F.sequence(F.lit(0), F.coalesce("_deals", F.lit(1)) - 1)
    two = few.join(heavy, key, "left").withColumn("_deal", F.explode(every)).drop("_deals")
    return one, two
