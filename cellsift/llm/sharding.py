"""Shards of bounded size by extendible hashing.

The directory is indexed by leading bits of a hash. A bucket over the byte limit
splits on its next bit, others stay, so shards differ in depth. The buckets of
all depths are sums of one histogram; only what still does not fit at its finest
bits is counted again on further bits.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsift.sources.scratch import cut_lineage

SHARD_BYTES = 1 << 20
HASH_BITS = 60
#: Bits by which the histogram is finer than the shards wanted, and bits of each later count.
FINER = 4
FURTHER = 8


def hashed(docs: DataFrame, *more: F.Column) -> DataFrame:
    """``doc_id``, ``n_bytes`` of the text in UTF-8, ``h``: 60 bits of id and text, and columns ``more``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text))
    place = F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")
    return docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), place.alias("h"), *more)


def _prefix(bits) -> F.Column:
    return F.expr(f"shiftright(h, {HASH_BITS} - ({bits}))")


def directory(rows: DataFrame, limit: int, kept: list[str]) -> DataFrame:
    """``fine, bits`` to ``depth, bucket, shard_bytes, shard_docs``: the shard of each histogram cell.

    A bucket is a shard if it fits, or if all its rows have one hash.
    """
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    base, bits = 0, min(HASH_BITS, max(0, ceil(log2(max(1.0, total / limit)))) + FINER)
    parts: list[DataFrame] = []
    while True:
        cells = rows.groupBy(_prefix(bits).alias("fine")).agg(
            F.sum("n_bytes").alias("b"), F.count("*").alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi")
        )
        cells = cut_lineage(cells, "histogram", kept)
        levels = cells.withColumn("depth", F.explode(F.sequence(F.lit(base), F.lit(bits))))
        levels = levels.withColumn("bucket", F.expr(f"shiftright(fine, {bits} - depth)"))
        sums = levels.groupBy("depth", "bucket").agg(
            F.sum("b").alias("b"), F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")
        )
        sums = sums.where((F.col("b") <= limit) | (F.col("lo") == F.col("hi")))
        sums = sums.select("depth", "bucket", F.col("b").alias("shard_bytes"), F.col("n").alias("shard_docs"))
        found = levels.select("fine", "depth", "bucket").join(sums, ["depth", "bucket"])
        found = found.groupBy("fine").agg(F.min(F.struct("depth", "bucket", "shard_bytes", "shard_docs")).alias("s"))
        found = cut_lineage(found.select("fine", F.lit(bits).alias("bits"), "s.*"), "directory", kept)
        parts.append(found)
        if bits == HASH_BITS:
            break
        rows = rows.withColumn("fine", _prefix(bits)).join(found.select("fine"), "fine", "left_anti").drop("fine")
        rows = cut_lineage(rows, "oversized", kept)
        if rows.isEmpty():
            break
        base, bits = bits + 1, min(HASH_BITS, bits + FURTHER)
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def shards(docs: DataFrame, kept: list[str], limit: int = SHARD_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, shard, depth, part, shard_bytes, shard_docs``.

    ``shard`` is the hash prefix in binary, ``depth`` its bits; bytes and
    documents are those of the whole bucket. Every shard is within ``limit``,
    unless it is a single document larger than that. Rows that repeat id and text
    share their hash: where together they exceed the limit, ``part`` (else 0)
    divides them into shards that fit. Null texts have 0 bytes; null ids are like
    others; other columns are ignored.
    """
    return _assigned(cut_lineage(hashed(docs), "hashed", kept), ["doc_id"], kept, limit)


def _assigned(rows: DataFrame, carried: list[str], kept: list[str], limit: int) -> DataFrame:
    """The shard of each row of a written table with ``n_bytes``, ``h`` and the columns ``carried``."""
    found = directory(rows.select("n_bytes", "h"), limit, kept)
    sizes = [r["bits"] for r in found.select("bits").distinct().collect()]
    out = None
    for bits in sorted(sizes):
        some = found.where(F.col("bits") == bits).drop("bits")
        part = rows.withColumn("fine", _prefix(bits)).join(some, "fine").drop("fine")
        out = part if out is None else out.union(part)
    if out is None:
        return rows.select(
            *carried, "n_bytes", F.lit("").alias("shard"), F.lit(0).alias("depth"), F.lit(0).cast("long").alias("part"),
            F.lit(0).cast("long").alias("shard_bytes"), F.lit(0).cast("long").alias("shard_docs"),
        )
    shard = F.when(F.col("depth") == 0, "").otherwise(F.lpad(F.bin("bucket"), F.col("depth"), F.lit("0")))
    out = out.select(*carried, "n_bytes", shard.alias("shard"), "depth", "shard_bytes", "shard_docs")
    over = (F.col("shard_bytes") > limit) & (F.col("shard_docs") > 1)
    # Repeated rows are alike, so any of them may go to any part: by partition and place in it.
    place = cut_lineage(out.where(over).withColumn("at", F.monotonically_increasing_id()), "repeats", kept)
    fits = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest(F.col("n_bytes"), F.lit(1))))
    inner = F.expr("at & ((1L << 33) - 1)")
    part = (F.expr("shiftright(at, 33)") * (1 << 32) + F.floor(inner / fits)).cast("long")
    columns = [*carried, "n_bytes", "shard", "depth", "part", "shard_bytes", "shard_docs"]
    return out.where(~over).withColumn("part", F.lit(0).cast("long")).select(*columns).union(
        place.withColumn("part", part).select(*columns)
    )


def _free_name(wanted: str, columns: list[str]) -> str:
    taken = {c.lower() for c in columns}
    return next(n for n in (wanted, *(f"{wanted}_{i}" for i in range(1, len(taken) + 2))) if n not in taken)


def write_shards(docs: DataFrame, path: str, kept: list[str], limit: int = SHARD_BYTES) -> tuple[str, str]:
    """Write all rows and columns of ``docs`` as Parquet, one folder per shard and part below ``path``.

    Shards are named ``s`` and the hash prefix, so that a reader takes the names
    for text. Rows that repeat beyond ``limit`` are dealt to parts that fit. Each
    shard and part is one file, written by one task. Returns the names of the two
    folder columns: ``shard`` and ``part``, with a number behind where ``docs``
    has such a column. An empty table gives a folder without shards.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = cut_lineage(hashed(docs, whole), "hashed", kept)
    shard, part = _free_name("shard", docs.columns), _free_name("part", docs.columns)
    out = _assigned(rows, ["_row"], kept, limit)
    out = out.select("_row.*", F.concat(F.lit("s"), "shard").alias(shard), F.col("part").alias(part))
    out.repartition(shard, part).write.partitionBy(shard, part).parquet(path)
    return shard, part
