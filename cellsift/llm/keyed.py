"""Joins with a table of unique keys, where one key may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with this share of the rows or more is heavy; there are 1 / share of them at most.
HEAVY_SHARE = 1 / 256


def join_keyed(rows: DataFrame, keyed: DataFrame, key: str, weight: str, how: str = "inner") -> DataFrame:
    """``rows`` joined on ``key`` with ``keyed``, which has each key once and its rows in ``weight``.

    The rows of heavy keys meet a broadcast table of 256 rows at most and are
    not shuffled; the others shuffle. ``how`` is ``inner`` or ``left``. Both
    tables should be written ones, or cheap, as each is read twice.
    """
    total = keyed.agg(F.sum(weight)).first()[0]
    if not total:
        return rows.join(keyed, key, how)
    heavy = F.col(weight) >= max(1.0, total * HEAVY_SHARE)
    some = F.broadcast(keyed.where(heavy))
    others = rows.join(F.broadcast(keyed.where(heavy).select(key)), key, "left_anti")
    return rows.join(some, key).unionByName(others.join(keyed.where(~heavy), key, how))
