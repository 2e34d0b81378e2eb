"""Near-duplicate texts by improved consistent weighted sampling.

A text is its five-word shingles, weighted by TF-IDF. Improved consistent
weighted sampling (Ioffe, 2010) gives two texts the same sample with a
probability equal to their weighted Jaccard similarity. Samples are banded,
texts that share a band are candidates, and candidates are verified by the
similarity itself, computed from all shingles.

Weights: ``count * ln(1 + N / df) ** power``, with the exact document frequency
of every shingle, counted over all documents. Shingles in ``share`` (1 %) of the
documents or more are known by name to every task; they number at most the mean
shingles per document / ``share``. A fixed counting sketch finds which they may
be, a second pass counts those exactly. All others are counted in a shuffle: each
slice of texts sends its distinct shingles to buckets by their hash, and gets the
frequency of each back, in order, without their names. ``power`` is
small: a group of near copies makes its own shingles frequent, and a full IDF
would let its edits outweigh them.

Candidates are not expanded into all pairs. Each band bucket is first compared
with its least member; what this joins needs no further look, because it is one
class already. Then members of one bucket that still lie in different classes
are compared with each other, inside tasks over blocks of such members that give
back links only, so no link between classes is missed and no pairs are listed.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellsift.llm.components import components, join_labels
from cellsift.llm.words import count_texts, mix, slices
from cellsift.operators.keyed import join_keyed
from cellsift.sources.scratch import cut_lineage, drop_written

SIMILARITY = 0.8
BANDS = 20
ROWS = 5
IDF_SHARE = 0.01
IDF_POWER = 0.25

SKETCH_BITS = 17
SKETCH_BLOCK = 1 << 10
#: Frequent shingles held by each task; the share is raised beyond it.
MAX_FREQUENT = 1 << 20

#: Slices of texts for each bucket of shingles, and bits of a bucket's number, least and most.
BUCKET_SLICES = 4
BUCKET_BITS = (4, 12)
#: Bits of a shingle's hash that ``count_within`` keeps.
VALUE_BITS = 52

#: Shingles that are sampled at once; what a hash takes for them stays in cache.
SAMPLE_BLOCK = 1 << 15

#: Tables whose rows are long have small row groups, as a reader holds the rows of one as columns.
LONG_ROWS = {"parquet.block.size": str(4 << 20), "parquet.page.size.row.check.min": "1"}
#: Whole texts go to Python so many at a time.
TEXTS_AT_ONCE = 1024
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: Members of a block of texts whose classes are compared with each other.
FAMILY_BLOCK = 2048

_MASK = np.uint64(0xFFFF)


@contextmanager
def _few_at_once(spark: SparkSession) -> Iterator[None]:
    """Jobs that run inside send ``TEXTS_AT_ONCE`` rows to Python at a time, or fewer where that was set."""
    before = spark.conf.get(ARROW_ROWS)
    if not 0 < int(before) < TEXTS_AT_ONCE:
        spark.conf.set(ARROW_ROWS, str(TEXTS_AT_ONCE))
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def _texts(batch: pa.RecordBatch, name: str) -> Iterator[tuple[int, int, tuple]]:
    """Distinct shingles with counts, per slice of a batch."""
    column = batch.column(batch.schema.get_field_index(name))
    for begin, end in slices(column):
        yield begin, end, count_texts(column.slice(begin, end - begin))


def _buckets(value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = np.uint64((1 << SKETCH_BITS) - 1)
    return (value & low).astype(np.int64), ((value >> np.uint64(24)) & low).astype(np.int64)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    size = 1 << SKETCH_BITS
    table = np.zeros(2 * size, dtype=np.int64)
    for batch in batches:
        for _, _, (_, value, _) in _texts(batch, "text"):
            one, two = _buckets(value)
            table[:size] += np.bincount(one, minlength=size)
            table[size:] += np.bincount(two, minlength=size)
    if table.any():
        blocks = table.reshape(-1, SKETCH_BLOCK)
        yield _sketch_rows(range(len(blocks)), blocks)


def _sketch_rows(numbers, blocks) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(numbers), pa.int32()), pa.array([b.tobytes() for b in blocks], pa.binary())],
        names=["block", "counts"],
    )


def _add_blocks(table: pa.Table) -> pa.Table:
    total = np.zeros(SKETCH_BLOCK, dtype=np.int64)
    for counts in table.column("counts").to_pylist():
        total += np.frombuffer(counts, dtype=np.int64)
    return pa.Table.from_batches([_sketch_rows([table.column("block")[0].as_py()], [total])])


def frequent_shingles(docs: DataFrame, share: float) -> tuple[int, np.ndarray, np.ndarray, float]:
    """Rows of ``docs(text)``, and shingles in at least ``share`` of them with exact counts.

    A share of s leaves 1 / s times the mean number of distinct shingles of a text
    at most. It is raised as far as that keeps within ``MAX_FREQUENT``, which
    depends on the length of texts and not on their number; the share comes last.
    """
    kind = "block int, counts binary"
    total = docs.count()
    sketch = docs.mapInArrow(_sketch, kind)
    # Two steps: a task adds a bounded number of partial sketches.
    sketch = sketch.withColumn("part", F.spark_partition_id() % 512)
    sketch = sketch.groupBy("block", "part").applyInArrow(_add_blocks, kind)
    blocks = sketch.groupBy("block").applyInArrow(_add_blocks, kind).collect()
    if not blocks:
        return total, np.zeros(0, dtype=np.uint64), np.zeros(0), share
    counts = np.zeros((2 << SKETCH_BITS) // SKETCH_BLOCK * SKETCH_BLOCK, dtype=np.int64).reshape(-1, SKETCH_BLOCK)
    for row in blocks:
        counts[row["block"]] = np.frombuffer(row["counts"], dtype=np.int64)
    counts = counts.reshape(2, -1)
    # Each text counts each of its shingles once, so a row of the sketch adds up to their number.
    share = max(share, counts[0].sum() / total / MAX_FREQUENT)
    heavy = counts >= share * total

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, (_, value, _) in _texts(batch, "text"):
                one, two = _buckets(value)
                value, n = np.unique(value[heavy[0][one] & heavy[1][two]], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(value.astype(np.int64)), pa.array(n)], names=["s", "n"])

    found = docs.mapInArrow(count, "s long, n long").groupBy("s").agg(F.sum("n").alias("n"))
    found = found.where(F.col("n") >= share * total)
    rows = sorted(found.collect())
    return total, np.array([r[0] for r in rows], dtype=np.uint64), np.array([r[1] for r in rows], dtype=float), share


class Weights:
    """TF-IDF weight of shingles, from the frequent ones alone."""

    def __init__(self, total: int, value: np.ndarray, count: np.ndarray, share: float, power: float):
        self.value, self.total, self.power = value, total, power
        # All weights are relative to that of a shingle in just this share of the documents.
        self.unit = np.log1p(1 / share)
        self.factor = (np.log1p(total / np.maximum(count, share * total)) / self.unit) ** power if total else count

    def _find(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place among the frequent shingles, and whether it is one."""
        if not len(self.value):
            return np.zeros(len(value), dtype=np.int64), np.zeros(len(value), dtype=bool)
        at = np.minimum(np.searchsorted(self.value, value), len(self.value) - 1)
        return at, self.value[at] == value

    def known(self, value: np.ndarray) -> np.ndarray:
        return self._find(value)[1]

    def __call__(self, value: np.ndarray, count: np.ndarray, documents: np.ndarray) -> np.ndarray:
        """``documents`` has the frequencies of the distinct values that are not known, in order."""
        at, known = self._find(value)
        factor = np.empty(len(value))
        factor[known] = self.factor[at[known]]
        some = value[~known]
        rare = (np.log1p(self.total / documents) / self.unit) ** self.power
        factor[~known] = rare[np.searchsorted(np.unique(some), some)]
        return count * factor


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each slice of texts: their ids, digests and texts as lists."""
    for batch in batches:
        for begin, end in slices(batch.column(2)):
            part = batch.slice(begin, end - begin)
            ends = pa.array([0, end - begin], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(ends, c) for c in part.columns], names=["doc_id", "same", "text"]
            )


def rare_frequencies(texts: DataFrame, slices_: int, weights: Weights) -> DataFrame:
    """``(slice, bucket, n)``: documents of each rare shingle of a slice, in order of bucket and hash.

    ``texts`` has ``slice`` and the list ``text``, one row per slice. A bucket holds
    the shingles of about ``BUCKET_SLICES`` slices, of which there are ``slices_``.
    """
    bits = min(max((slices_ // BUCKET_SLICES).bit_length(), BUCKET_BITS[0]), BUCKET_BITS[1])
    shift = np.uint64(VALUE_BITS - bits)
    kind = "<u4" if weights.total < 1 << 32 else "<u8"

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                value = count_texts(batch.column(1)[i].values)[1]
                value, n = np.unique(value[~weights.known(value)], return_counts=True)
                bucket, first = np.unique(value >> shift, return_index=True)
                ends = np.append(first[1:], len(value))
                # The upper bits are the bucket, six bytes hold the rest; a slice has 4 096 texts at most.
                six = np.ascontiguousarray(value).view(np.uint8).reshape(-1, 8)[:, :6]
                n = n.astype("<u2")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(bucket), batch.column(0)[i].as_py()), pa.int64()), pa.array(bucket.astype(np.int32)),
                        pa.array([six[a:b].tobytes() for a, b in zip(first, ends)], pa.binary()),
                        pa.array([n[a:b].tobytes() for a, b in zip(first, ends)], pa.binary()),
                    ],
                    names=["slice", "bucket", "s", "n"],
                )

    def add(rows: pa.Table) -> pa.Table:
        n = [np.frombuffer(x, dtype="<u2") for x in rows.column("n").to_pylist()]
        ends = np.cumsum([len(x) for x in n])
        value = np.zeros((ends[-1], 8), dtype=np.uint8)
        value[:, :6] = np.frombuffer(b"".join(rows.column("s").to_pylist()), dtype=np.uint8).reshape(-1, 6)
        _, place = np.unique(value.view(np.uint64).ravel(), return_inverse=True)
        found = np.bincount(place, weights=np.concatenate(n))[place].astype(kind)
        parts = [x.tobytes() for x in np.split(found, ends[:-1])]
        return rows.select(["slice", "bucket"]).append_column("n", pa.array(parts, pa.binary()))

    pieces = texts.select("slice", "text").mapInArrow(spread, "slice long, bucket int, s binary, n binary")
    pieces = pieces.repartition(_tasks(texts, 1 << bits), "bucket")
    return pieces.groupBy("bucket").applyInArrow(add, "slice long, bucket int, n binary")


def _tasks(df: DataFrame, groups: int) -> int:
    """Work grows with texts, not with the bytes that are left of them, so the number of tasks is set."""
    spark = df.sparkSession
    return max(1, min(groups, max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)))


def _weighed(texts: pa.Array, frequencies: pa.Table, weights: Weights) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, shingle and weight, with the frequencies that belong to the slice."""
    doc, value, count = count_texts(texts)
    kind = "<u4" if weights.total < 1 << 32 else "<u8"
    parts = frequencies.sort_by("bucket").column("n").to_pylist()
    return doc, value, weights(value, count, np.frombuffer(b"".join(parts), dtype=kind))


def _random_tables() -> tuple[np.ndarray, ...]:
    """65 536 draws each: r and its inverse, ln c (Gamma(2, 1)) and beta (uniform)."""
    u = (mix(np.arange(1, 5 * 65536 + 1, dtype=np.uint64)) >> np.uint64(11)).astype(np.float64)
    u = ((u + 0.5) / float(1 << 53)).reshape(5, -1)
    r = -np.log(u[0] * u[1])
    return tuple(x.astype(np.float32) for x in (r, 1 / r, np.log(-np.log(u[2] * u[3])), u[4]))


class Sampler:
    """Consistent weighted samples: least ``ln a`` over the shingles, for each hash."""

    def __init__(self, hashes: int):
        self.factors = mix(np.arange(1, hashes + 1, dtype=np.uint64) << np.uint64(20)) | np.uint64(1)
        self.tables = _random_tables()

    def __call__(self, value: np.ndarray, weight: np.ndarray, first: np.ndarray) -> np.ndarray:
        """One row per text, one column per hash; ``first`` is where each text begins.

        ``a`` follows from the shingle and its quantised weight alone, so equal
        least values mean equal samples.
        """
        r, inverse, log_c, beta = self.tables
        log_weight = np.log(weight).astype(np.float32)
        out = np.full((len(self.factors), len(first)), np.inf, dtype=np.float32)
        size = min(SAMPLE_BLOCK, len(value))
        hashes, place = np.empty(size, dtype=np.uint64), np.empty(size, dtype=np.uint64)
        some, more = np.empty(size, dtype=np.float32), np.empty(size, dtype=np.float32)
        for begin in range(0, len(value), SAMPLE_BLOCK):
            part, log_w = value[begin : begin + SAMPLE_BLOCK], log_weight[begin : begin + SAMPLE_BLOCK]
            n = len(part)
            # Texts with shingles in this block; the first may have begun before it.
            lo, hi = np.searchsorted(first, begin, side="right") - 1, np.searchsorted(first, begin + n)
            cuts = np.maximum(first[lo:hi] - begin, 0)
            h, i, t, x = hashes[:n], place[:n], some[:n], more[:n]
            at = i.view(np.intp)
            for j, factor in enumerate(self.factors):
                np.multiply(part, factor, out=h)
                np.right_shift(h, np.uint64(32), out=i)
                np.bitwise_and(i, _MASK, out=i)
                beta.take(at, out=x, mode="clip")
                np.right_shift(h, np.uint64(48), out=i)
                inverse.take(at, out=t, mode="clip")
                t *= log_w
                t += x
                np.floor(t, out=t)
                t -= x
                t += 1
                r.take(at, out=x, mode="clip")
                t *= x
                np.right_shift(h, np.uint64(16), out=i)
                np.bitwise_and(i, _MASK, out=i)
                log_c.take(at, out=x, mode="clip")
                x -= t
                np.minimum(out[j, lo:hi], np.minimum.reduceat(x, cuts), out=out[j, lo:hi])
        return np.ascontiguousarray(out.T)


@lru_cache(maxsize=1)
def _sampler(hashes: int) -> Sampler:
    return Sampler(hashes)


def band_keys(sample: np.ndarray, rows: int) -> np.ndarray:
    bits = sample.view(np.uint32).astype(np.uint64)
    bands = bits.shape[1] // rows
    key = np.zeros((len(bits), bands), dtype=np.uint64) + np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(rows):
        key = mix(key + bits[:, k : bands * rows : rows])
    return key.view(np.int64)


def _lists(doc: np.ndarray, docs: int, *values: pa.Array) -> list[pa.Array]:
    """A list per text of values that are in text order."""
    ends = np.searchsorted(doc, np.arange(docs + 1)).astype(np.int32)
    return [pa.ListArray.from_arrays(pa.array(ends), v) for v in values]


def _similarity(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose weighted Jaccard similarity reaches the limit given with each."""
    for batch in batches:
        column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        good = []
        for i in range(batch.num_rows):
            s, t, u, v = (column[c][i].values.to_numpy() for c in ("s1", "w1", "s2", "w2"))
            _, x, y = np.intersect1d(s, u, assume_unique=True, return_indices=True)
            both = np.minimum(t[x], v[y]).sum()
            good.append(both >= column["least"][i].as_py() * (t.sum() + v.sum() - both) * (1 - 1e-12))
        good = pa.array(good, pa.bool_())
        yield pa.RecordBatch.from_arrays([column["a"].filter(good), column["b"].filter(good)], names=["a", "b"])


def _meeting(similarity: float):
    def meeting(rows: pa.Table) -> pa.Table:
        """Links between classes among the members of one block, or of two.

        Pairs that share a band and differ in class are verified here, one member
        against all its partners at a time; classes already joined are passed over.
        """
        rows = rows.sort_by("rep")
        n = rows.num_rows
        root = np.unique(rows.column("root").to_numpy(), return_inverse=True)[1]
        bands = rows.column("bands").combine_chunks().flatten().to_numpy().reshape(n, -1)
        lists = rows.column("s").combine_chunks()
        vocabulary, at = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        weight = rows.column("w").combine_chunks().flatten().to_numpy()
        ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
        total = np.add.reduceat(weight, ends[:-1])
        right = rows.column("right").to_numpy(zero_copy_only=False)
        one_block = rows.column("i")[0] == rows.column("j")[0]
        parent = np.arange(root.max() + 1)
        dense = np.zeros(len(vocabulary))
        out = []
        columns = np.ascontiguousarray(bands.T)
        for k in np.flatnonzero(~right):
            partner = (parent[root] != parent[root[k]]) & (np.arange(n) > k if one_block else right)
            partner = np.flatnonzero(partner)
            if not len(partner):
                continue
            shared = np.zeros(len(partner), dtype=bool)
            for column in columns:
                shared |= column[partner] == column[k]
            partner = partner[shared]
            dense[at[ends[k] : ends[k + 1]]] = weight[ends[k] : ends[k + 1]]
            for begin in range(0, len(partner), 256):
                some = partner[begin : begin + 256]
                length = ends[some + 1] - ends[some]
                first = np.concatenate([[0], np.cumsum(length)])
                place = np.repeat(ends[some] - first[:-1], length) + np.arange(first[-1])
                both = np.add.reduceat(np.minimum(dense[at[place]], weight[place]), first[:-1])
                good = some[both >= similarity * (total[k] + total[some] - both) * (1 - 1e-12)]
                if len(good):
                    parent = join_labels(parent, np.full(len(good), root[k]), root[good])
                    out += [(k, g) for g in good]
            dense[at[ends[k] : ends[k + 1]]] = 0
        rep = rows.column("rep").to_numpy()
        pairs = np.array(out, dtype=np.int64).reshape(-1, 2)
        return pa.table({"a": rep[pairs[:, 0]], "b": rep[pairs[:, 1]]})

    return meeting


def _verified(pairs: DataFrame, bags: DataFrame, similarity: float) -> DataFrame:
    one = bags.select(F.col("rep").alias("a"), F.col("s").alias("s1"), F.col("w").alias("w1"))
    two = bags.select(F.col("rep").alias("b"), F.col("s").alias("s2"), F.col("w").alias("w2"))
    rows = pairs.join(two, "b").join(one, "a").select("a", "b", "s1", "w1", "s2", "w2", F.lit(similarity).alias("least"))
    return rows.mapInArrow(_similarity, "a long, b long")


def classes(
    docs: DataFrame,
    kept: list[str],
    *,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
    share: float = IDF_SHARE,
    power: float = IDF_POWER,
) -> DataFrame:
    """Near-duplicate class of each row of ``docs``: ``(doc_id, class_id)``.

    ``docs`` needs ``doc_id`` (integer) and ``text``; more columns are ignored.
    ``class_id`` is the least ``doc_id`` of the rows joined by links, itself
    included. Texts that are equal share a class. Texts of one to four words are
    one shingle. Null, empty and blank texts are alone. Rows without a
    ``doc_id`` take no part and have no class. Rows that repeat a ``doc_id`` are
    one document if their texts are equal; otherwise their classes are joined.
    ``kept`` collects written tables, to be dropped when the result is done with.
    """
    found = _text_classes(docs, kept, True, similarity, bands, rows, share, power)
    return found.groupBy("doc_id").agg(F.min("class_id").alias("class_id"))


def _text_classes(
    docs: DataFrame, kept: list[str], by_id: bool, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS,
    share: float = IDF_SHARE, power: float = IDF_POWER,
) -> DataFrame:
    """``(doc_id, same, class_id)`` of each id and text; ``by_id`` joins the classes of an id's texts."""
    work: list[str] = []
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.where("doc_id is not null")
    with _few_at_once(docs.sparkSession):
        total, value, count, share = frequent_shingles(docs.select("text"), share)
    weights = Weights(total, value, count, share, power)

    # Equal texts have the same 128-bit hash, computed beside the text.
    packed = docs.select("doc_id", F.unhex(F.md5("text")).alias("same"), "text").mapInArrow(
        _pack, "doc_id array<long>, same array<binary>, text array<string>"
    )
    # A number of its own for each slice, fixed once it is written.
    with _few_at_once(docs.sparkSession):
        packed = cut_lineage(packed.withColumn("slice", F.monotonically_increasing_id()), "slices", work, **LONG_ROWS)
    number = packed.count()
    tasks = _tasks(docs, number)
    found = cut_lineage(rare_frequencies(packed, number, weights), "frequencies", work)
    found = found.repartition(tasks, "slice").groupBy("slice")

    def sign(part: pa.Table, frequencies: pa.Table) -> pa.Table:
        ids, same, texts = (part.column(c).chunk(0)[0].values for c in ("doc_id", "same", "text"))
        n = len(ids)
        doc, value, weight = _weighed(texts, frequencies, weights)
        has, first = np.unique(doc, return_index=True)
        keys = np.zeros((n, bands), dtype=np.int64)
        if len(has):
            keys[has] = band_keys(_sampler(bands * rows)(value, weight, first), rows)
        blank = np.ones(n, dtype=bool)
        blank[has] = False
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * bands, bands, dtype=np.int32)), pa.array(keys.ravel()))
        place = pa.array(np.full(n, part.column("slice")[0].as_py()), pa.int64())
        return pa.table(
            [ids, same, pa.array(blank), lists, place, pa.array(np.arange(n, dtype=np.int32))],
            names=["doc_id", "same", "blank", "bands", "slice", "at"],
        )

    signed = packed.repartition(tasks, "slice").groupBy("slice").cogroup(found).applyInArrow(
        sign, "doc_id long, same binary, blank boolean, bands array<long>, slice long, at int"
    )
    signed = cut_lineage(signed, "signatures", work)
    reps = signed.where("not blank").groupBy("same").agg(
        F.min(F.struct("doc_id", "slice", "at")).alias("m"), F.first("bands").alias("bands"), F.count("*").alias("copies")
    ).select("same", "m.slice", "m.at", "bands", "copies")
    # A number of its own for each text, fixed once it is written.
    reps = cut_lineage(reps.withColumn("rep", F.monotonically_increasing_id()), "reps", work)
    member = signed.select("doc_id", "same").distinct()
    member = join_keyed(member, reps.select("same", "rep", "copies"), "same", "copies", "left").drop("copies")
    member = cut_lineage(member, "members", kept)
    # A doc_id with several texts is in several classes of equal texts, which it joins.
    ids = member.where("rep is not null")
    split = ids.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a <> z")
    split = split.join(ids, "doc_id").select("a", F.col("rep").alias("b")).where("a <> b" if by_id else "false")

    band = reps.select("rep", F.explode("bands").alias("key"))
    least = band.groupBy("key").agg(F.min("rep").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
    # Only buckets of several texts go on; these are few beside all buckets.
    band = cut_lineage(band.join(least, "key"), "buckets", work)
    stars = band.where("a <> rep").select("a", F.col("rep").alias("b")).distinct()
    stars = cut_lineage(stars, "stars", work)

    def bag(part: pa.Table, frequencies: pa.Table) -> pa.Table:
        if not part.num_rows:
            return pa.table({"rep": pa.array([], pa.int64()), "s": pa.array([], pa.list_(pa.int64())), "w": pa.array([], pa.list_(pa.float64()))})
        texts, asked = (part.column(c).chunk(0)[0].values for c in ("text", "asked"))
        at, rep = (asked.field(i).to_numpy() for i in range(2))
        order = np.argsort(at)
        doc, value, weight = _weighed(texts, frequencies, weights)
        wanted = np.isin(doc, at)
        doc = np.searchsorted(at[order], doc[wanted])
        lists = _lists(doc, len(at), pa.array(value[wanted].astype(np.int64)), pa.array(weight[wanted]))
        return pa.table([pa.array(rep[order]), *lists], names=["rep", "s", "w"])

    wanted = reps.join(band.select("rep").distinct(), "rep", "left_semi").groupBy("slice").agg(
        F.collect_list(F.struct("at", "rep")).alias("asked")
    )
    asked = packed.select("slice", "text").join(wanted, "slice").repartition(tasks, "slice")
    met = asked.groupBy("slice").cogroup(found).applyInArrow(bag, "rep long, s array<long>, w array<double>")
    bags = cut_lineage(met, "bags", work, **LONG_ROWS)

    linked = cut_lineage(_verified(stars, bags, similarity).union(split), "links", work)
    first = components(linked, work)
    # Members of one bucket that are in different classes by now.
    now = band.join(first, band["rep"] == first["id"], "left")
    now = now.select("key", "rep", F.coalesce("root", "rep").alias("root"))
    several = now.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    now = cut_lineage(now.join(several.select("key", "lo"), "key"), "open", work)
    # Classes that meet in buckets are a family; its members are compared in blocks.
    family = components(now.where("root <> lo").selectExpr("root as a", "lo as b").distinct(), work)
    family = family.select(F.col("id").alias("root"), F.col("root").alias("family"))
    people = now.select("rep", "root").distinct().join(family, "root", "left")
    people = people.select("rep", "root", F.coalesce("family", "root").alias("family"))
    size = people.groupBy("family").agg(F.ceil(F.count("*") / FAMILY_BLOCK).cast("int").alias("blocks"))
    people = people.join(size, "family").join(reps.select("rep", "bands"), "rep").join(bags, "rep")
    mine = F.pmod(F.xxhash64("rep"), "blocks").cast("int")
    people = people.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    people = people.select(
        "family", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
        (F.col("mine") > F.col("other")).alias("right"), "rep", "root", "bands", "s", "w",
    )
    meet = people.groupBy("family", "i", "j").applyInArrow(_meeting(similarity), "a long, b long")
    # Written first: a task that verifies and contracts would hold two Python workers.
    more = cut_lineage(meet, "more", work)
    own = first.select(F.col("id").alias("a"), F.col("root").alias("b"))
    roots = components(own.union(more), kept)
    drop_written(docs.sparkSession, work)
    out = member.join(roots, member["rep"] == roots["id"], "left")
    out = out.select("doc_id", "same", F.coalesce("root", "rep").alias("root"))
    # The least id of a class; a class may hold any share of the rows.
    named = out.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("size"))
    named = cut_lineage(named, "classes", kept)
    out = join_keyed(out, named, "root", "size", "left")
    return out.select("doc_id", "same", F.coalesce("class_id", "doc_id").alias("class_id"), "root")


def keep_one(docs: DataFrame, kept: list[str], **options) -> DataFrame:
    """Rows of ``docs`` without near duplicates: of each class of texts one of the least ``doc_id`` stays.

    Columns are unchanged. Classes are of texts, not of ids: where rows share a
    ``doc_id``, each text that is no near copy of another stays. Rows without a
    ``doc_id`` and rows without words all stay, but of rows that repeat id and
    text one does.
    """
    found = _text_classes(docs, kept, False, **options)
    least = found.where("root is not null").groupBy("root").agg(F.min(F.struct("doc_id", "same")).alias("m"))
    alone = found.where("root is null").select("doc_id", "same")
    stay = least.select("m.*").unionByName(alone).select(F.col("doc_id").alias("keep_id"), F.col("same").alias("keep_text"))
    stay = cut_lineage(stay, "kept-texts", kept)
    # A null text is told from an empty one by its digest, too.
    same = F.unhex(F.md5(F.col("text").cast("string")))
    met = docs.join(stay, (F.col("doc_id").cast("long") == F.col("keep_id")) & same.eqNullSafe(F.col("keep_text")))
    met = met.dropDuplicates(["keep_id", "keep_text"]).select(*[docs[c] for c in docs.columns])
    return met.unionByName(docs.where("doc_id is null"))
