"""Samples in blocks, and the long rows that op10 writes between its steps."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from cellsift.llm import minhash, words
from cellsift.sources.scratch import cut_lineage


def test_samples_are_those_of_each_text_alone_and_take_little_memory():
    """The check tool stopped op10 at 3000 MB of an executor; a slice's samples took 40 bytes a shingle beside it."""
    rng = np.random.default_rng(3)
    value = rng.integers(0, 1 << 52, 5 * minhash.SAMPLE_BLOCK + 17).astype(np.uint64)
    weight = rng.integers(1, 9, len(value)) * rng.uniform(0.2, 2, len(value))
    # Texts of one shingle, one that spans blocks, and one that begins with a block.
    size = minhash.SAMPLE_BLOCK
    first = np.array([0, 1, 2, size - 1, size, size + 9, 3 * size + 5, 5 * size])
    sampler = minhash.Sampler(10)
    sampler(value[:5], weight[:5], first[:2])
    tracemalloc.start()
    found = sampler(value, weight, first)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24 * len(value)
    r, inverse, log_c, beta = sampler.tables
    log_weight = np.log(weight).astype(np.float32)
    for j, factor in enumerate(sampler.factors):
        h = value * factor
        i, b, c = ((h >> np.uint64(k) & np.uint64(0xFFFF)).astype(int) for k in (48, 32, 16))
        a = log_c[c] - (np.floor(log_weight * inverse[i] + beta[b]) - beta[b] + np.float32(1)) * r[i]
        assert np.array_equal(found[:, j], np.minimum.reduceat(a, first))
    assert sampler(value[:1], weight[:1], first[:1]).shape == (1, 10)


def test_slices_of_texts_are_written_in_small_row_groups(spark):
    texts = spark.range(0, 5000, 1, 1).select(
        F.col("id").alias("doc_id"), F.unhex(F.md5(F.col("id").cast("string"))).alias("same"),
        F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(99)), lambda i: F.md5(F.concat_ws("-", i, "id")))).alias("text"),
    )
    kept = []
    packed = texts.mapInArrow(minhash._pack, "doc_id array<long>, same array<binary>, text array<string>")
    packed = cut_lineage(packed, "slices", kept, **minhash.LONG_ROWS)
    assert packed.select(F.sum(F.size("text"))).first()[0] == 5000
    sizes = []
    for path in packed.inputFiles():
        file = pq.ParquetFile(path.removeprefix("file://"))
        sizes += [file.metadata.row_group(k).total_byte_size for k in range(file.num_row_groups)]
    # One more slice at most than the limit.
    assert sum(sizes) > 12 << 20 and max(sizes) <= (4 << 20) + 2 * words.SLICE_BYTES


def test_few_texts_at_once_for_the_jobs_inside_only(spark):
    before = spark.conf.get(minhash.ARROW_ROWS)
    with minhash._few_at_once(spark):
        rows = spark.range(0, 5000, 1, 1)
        sizes = rows.mapInArrow(lambda it: (pa.record_batch({"id": [b.num_rows]}) for b in it), "id long")
        assert max(r[0] for r in sizes.collect()) <= minhash.TEXTS_AT_ONCE
    assert spark.conf.get(minhash.ARROW_ROWS) == before
