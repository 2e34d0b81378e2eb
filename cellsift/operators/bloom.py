"""A Bloom filter over ids, as a small table that rows meet without a shuffle.

The filter is built by an aggregate: an id picks a block of bits and two bits in
it. Rows look their block up in the broadcast table, so only rows that may have
one of the ids have to be shuffled for an exact join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 32_768
# Bits for each id, and blocks at most: 4 KB each, 64 MB together. Beyond that
# more rows are hit by chance; a join decides about them all the same.
ID_BITS = 16
MOST_BLOCKS = 16_384


def id_key(column: Column) -> Column:
    """Text that is never null and differs for null and for every value."""
    return F.coalesce(F.concat(F.lit("v"), column.cast("string")), F.lit("n"))


def _bit(key: str, seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(BLOCK_BITS))


def _block(key: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(7), key), F.lit(blocks))


class IdFilter:
    """Filter over the ids in ``ids``, a written table with one text column."""

    def __init__(self, ids: DataFrame, most_blocks: int = MOST_BLOCKS):
        key = ids.columns[0]
        self.ids, self.count, self.blocks = ids, ids.count(), 1
        while self.blocks * BLOCK_BITS < self.count * ID_BITS and self.blocks < most_blocks:
            self.blocks *= 2
        bits = ids.select(_block(key, self.blocks).alias("__block"), F.explode(F.array(_bit(key, 1), _bit(key, 2))).alias("b"))
        self.table = bits.groupBy("__block").agg(F.bitmap_construct_agg("b").alias("__bits"))

    def marked(self, rows: DataFrame, key: Column, name: str) -> DataFrame:
        """``rows`` with a flag: false means that the row's id is surely none of these."""
        if not self.count:
            return rows.withColumn(name, F.lit(False))
        keyed = rows.withColumn("__key", key).withColumn("__block", _block("__key", self.blocks))
        # At most ``MOST_BLOCKS`` rows of 4 KB.
        met = keyed.join(F.broadcast(self.table), "__block", "left")

        def is_set(seed: int) -> Column:
            place = _bit("__key", seed)
            byte = F.conv(F.hex(F.substring("__bits", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            return F.call_function("shiftright", byte, (place % 8).cast("int")).bitwiseAND(1) == 1

        hit = F.coalesce(is_set(1) & is_set(2), F.lit(False))
        return met.select(*[F.col(f"`{c}`") for c in rows.columns], hit.alias(name))
