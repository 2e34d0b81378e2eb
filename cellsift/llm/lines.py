"""Lines that many documents share, found with two Bloom filters.

One filter holds the hashes of lines seen once, the other of lines seen again.
Each task fills a pair of its own in one pass; pairs merge into the pair of the
whole table: what two tasks saw once each was seen twice. Only lines that hit the
second filter are suspects, and only these shuffle: their digests are counted
exactly, the least document of each is chosen, and the positions that must go are
sent back to the rows they are from. Rows without a suspect never leave their task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellsift.llm.keyed import join_keyed
from cellsift.llm.words import _SPACE, mix, slices, span_hashes, text_buffer
from cellsift.sources.scratch import cut_lineage

#: Shorter lines are never dropped.
KEY_CHARS = 10
#: Bits of each filter for a line of the table, and bits of a filter at most (128 MB).
#: Beyond that bound more lines are suspects by chance; the result is exact all the same.
LINE_BITS = 16
MOST_BITS = 1 << 30
#: Filters are merged and sent in segments of so many bits.
SEGMENT_BITS = 1 << 16

#: Texts worked on at once, in bytes; a longer one is worked on alone.
SLICE_BYTES = 512 << 10

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Lines(NamedTuple):
    """Lines of the texts of a slice: the stripped span of each in ``data``, and each text's first line."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    keyed: np.ndarray


def find_lines(column: pa.Array) -> Lines:
    raw, offsets = text_buffer(column)
    breaks = np.flatnonzero(raw == 10)
    first = np.concatenate([[0], np.cumsum(np.diff(np.searchsorted(breaks, offsets)) + 1)])
    start, end = np.empty(first[-1], dtype=np.int64), np.empty(first[-1], dtype=np.int64)
    inner = np.ones(first[-1], dtype=bool)
    inner[first[:-1]] = False
    start[first[:-1]], start[inner] = offsets[:-1], breaks + 1
    inner[:] = True
    inner[first[1:] - 1] = False
    end[first[1:] - 1], end[inner] = offsets[1:], breaks
    data = _LOWER[raw]
    solid = np.flatnonzero(~_SPACE[data])
    a, b = np.searchsorted(solid, start), np.searchsorted(solid, end)
    some = a < b
    end[~some] = start[~some]
    start[some], end[some] = solid[a[some]], solid[b[some] - 1] + 1
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return Lines(data, start, end, first, points[end] - points[start] >= KEY_CHARS)


def _hashes(lines: Lines) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the lines that have a key."""
    at = np.flatnonzero(lines.keyed)
    return at, span_hashes(lines.data, lines.start[at], lines.end[at])


def _places(value: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each hash."""
    mask = np.uint64(bits - 1)
    return (value & mask).astype(np.int64), (mix(value ^ np.uint64(0x9E3779B97F4A7C15)) & mask).astype(np.int64)


def _holds(filter_: np.ndarray, places: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    one, two = ((filter_[p >> 3] >> (p & 7).astype(np.uint8)) & 1 for p in places)
    return (one & two).astype(bool)


def _add(filter_: np.ndarray, places: tuple[np.ndarray, np.ndarray]) -> None:
    for p in places:
        np.bitwise_or.at(filter_, p >> 3, (1 << (p & 7)).astype(np.uint8))


def _packed(segment: np.ndarray) -> bytes:
    """A segment as the places of its bits if these are few, else as it is."""
    if np.count_nonzero(segment) * 16 < len(segment):
        return np.flatnonzero(np.unpackbits(segment, bitorder="little")).astype("<u2").tobytes()
    return b"=" + segment.tobytes()


def _unpacked(code: bytes) -> np.ndarray:
    if len(code) % 2:
        return np.frombuffer(code, dtype=np.uint8)[1:].copy()
    bits = np.zeros(SEGMENT_BITS, dtype=np.uint8)
    bits[np.frombuffer(code, dtype="<u2")] = 1
    return np.packbits(bits, bitorder="little")


def _fill(bits: int):
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Both filters of the lines of one task, segment by segment."""
        once, twice = (np.zeros(bits >> 3, dtype=np.uint8) for _ in range(2))
        for batch in batches:
            column = batch.column(0)
            for begin, end in slices(column, SLICE_BYTES):
                lines = find_lines(column.slice(begin, end - begin))
                at, value = _hashes(lines)
                # A line that a text repeats counts once.
                text = np.searchsorted(lines.first, at, side="right")
                order = np.lexsort((text, value))
                text, value = text[order], value[order]
                fresh = np.ones(len(value), dtype=bool)
                fresh[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
                value, count = np.unique(value[fresh], return_counts=True)
                places = _places(value, bits)
                again = (count > 1) | _holds(once, places)
                _add(twice, tuple(p[again] for p in places))
                _add(once, places)
        step = SEGMENT_BITS >> 3
        for k in range(len(once) // step):
            one, two = once[k * step : (k + 1) * step], twice[k * step : (k + 1) * step]
            if one.any():
                yield pa.RecordBatch.from_pydict({"segment": [k], "once": [_packed(one)], "twice": [_packed(two)]})

    return fill


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The second filter of all tasks, for the segments dealt to one."""
    state: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for k, one, two in zip(*(c.to_pylist() for c in batch.columns)):
            one, two = _unpacked(one), _unpacked(two)
            if k not in state:
                state[k] = [one, two]
                continue
            mine = state[k]
            mine[1] |= two | (mine[0] & one)
            mine[0] |= one
    for k, (_, two) in state.items():
        if two.any():
            yield pa.RecordBatch.from_pydict({"segment": [k], "twice": [_packed(two)]})


class Repeats:
    """The second filter; it is sent packed and unpacked once by each Python worker."""

    def __init__(self, spark, bits: int, segments: list[tuple[int, bytes]]):
        self.bits = bits
        self.sent = spark.sparkContext.broadcast(segments)

    def holds(self, value: np.ndarray) -> np.ndarray:
        return _holds(_dense(self.bits, self.sent), _places(value, self.bits))


@lru_cache(maxsize=1)
def _dense(bits: int, sent) -> np.ndarray:
    out = np.zeros(bits >> 3, dtype=np.uint8)
    for k, code in sent.value:
        out[k * (SEGMENT_BITS >> 3) : (k + 1) * (SEGMENT_BITS >> 3)] = _unpacked(code)
    return out


def repeats(docs: DataFrame, line_bits: int = LINE_BITS, most_bits: int = MOST_BITS) -> Repeats:
    """The filter that holds every line of at least two texts, and few others."""
    texts = docs.select(F.col("text").cast("string").alias("text"))
    count = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    lines = texts.agg(F.sum(F.coalesce(count, F.lit(1)))).first()[0] or 0
    bits = SEGMENT_BITS
    while bits < min(most_bits, lines * line_bits):
        bits *= 2
    parts = texts.mapInArrow(_fill(bits), "segment long, once binary, twice binary")
    merged = parts.repartition("segment").mapInArrow(_merge, "segment long, twice binary")
    # At most ``most_bits`` bits in all.
    found = [(r["segment"], bytes(r["twice"])) for r in merged.collect()]
    return Repeats(docs.sparkSession, bits, found)


def _suspects(filter_: Repeats, keys: bool):
    """UDF of id and text: number of lines, and the row's digest and marks if it has a suspect."""

    @F.arrow_udf("struct<n_lines:long,row:binary,marks:array<struct<key:binary,at:int>>>")
    def probe(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for ids, column in columns:
            parts = []
            for begin, end in slices(column, SLICE_BYTES):
                text = column.slice(begin, end - begin)
                lines = find_lines(text)
                at, value = _hashes(lines)
                at = at[filter_.holds(value)]
                doc = np.searchsorted(lines.first, at, side="right") - 1
                bound = np.searchsorted(doc, np.arange(len(text) + 1))
                rows: list[bytes | None] = [None] * len(text)
                for i in np.unique(doc).tolist():
                    whole = f"{ids[begin + i].as_py() or ''}:{text[i].as_py()}"
                    rows[i] = hashlib.sha256(whole.encode()).digest()
                if not keys:
                    at, bound = at[:0], np.zeros_like(bound)
                spans = zip(lines.start[at].tolist(), lines.end[at].tolist())
                digests = [hashlib.sha256(lines.data[a:b]).digest() for a, b in spans]
                place = (at - lines.first[:-1][doc[: len(at)]]).astype(np.int32)
                marks = pa.StructArray.from_arrays([pa.array(digests, pa.binary()), pa.array(place)], ["key", "at"])
                marks = pa.ListArray.from_arrays(pa.array(bound.astype(np.int32)), marks)
                fields = [pa.array(np.diff(lines.first)), pa.array(rows, pa.binary()), marks]
                parts.append(pa.StructArray.from_arrays(fields, ["n_lines", "row", "marks"]))
            yield pa.concat_arrays(parts)

    return probe(F.col("doc_id").cast("string"), F.col("text").cast("string"))


@F.arrow_udf(T.StringType())
def _without(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Each text without the lines at the given places."""
    for texts, drops in columns:
        out = []
        for text, drop in zip(texts.to_pylist(), drops.to_pylist()):
            if drop:
                gone = set(drop)
                text = "\n".join(line for k, line in enumerate((text or "").split("\n")) if k not in gone)
            out.append(text or "")
        yield pa.array(out, pa.string())


def drop_repeated(docs: DataFrame, kept: list[str], name: str = "_lines", **sizes: int) -> DataFrame:
    """``docs`` with a struct column ``name``: ``text`` without repeated lines, ``n_lines`` before, ``n_dropped``.

    A line's key is the line without white space at its ends, with A-Z in lower
    case. A key of 10 code points or more that is found under two ids or more
    stays only under the least of them, there in all its lines. ``docs`` needs
    ``doc_id`` and ``text``; a column called ``name`` is replaced, others stay.

    Rows that share an id are one document. Rows without an id are one document
    too, which comes after all others. A null text is an empty one; an empty text
    has one empty line. Repeated rows get equal results, and an empty table has an
    empty result. ``sizes`` are those of ``repeats``. ``kept`` collects the paths
    of written tables.
    """
    filter_ = repeats(docs, **sizes)
    marked = docs.select("doc_id", _suspects(filter_, True).alias("p")).where("p.row is not null")
    marked = marked.select("doc_id", "p.row", F.explode("p.marks").alias("m")).select("doc_id", "row", "m.*")
    marked = cut_lineage(marked, "suspects", kept)
    firsts = marked.groupBy("key").agg(
        F.min("doc_id").alias("least"), F.max("doc_id").alias("most"),
        F.count_if(F.col("doc_id").isNull()).alias("nameless"), F.count("*").alias("n"),
    )
    firsts = firsts.where("least < most or (least is not null and nameless > 0)")
    firsts = cut_lineage(firsts.select("key", "least", "n"), "repeated", kept)
    gone = join_keyed(marked, firsts, "key", "n").where("doc_id is null or doc_id <> least")
    # A row has as many places as lines; rows alike in id and text have the same.
    drops = gone.groupBy("row").agg(F.collect_set("at").alias("drop"), F.count("*").alias("n"))
    drops = cut_lineage(drops.select("row", "drop", (F.col("n") / F.size("drop")).alias("copies")), "drops", kept)

    columns = [c for c in docs.columns if c != name]
    rows = docs.withColumn(name, _suspects(filter_, False))
    packed = rows.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"),
        F.col(f"`{name}`.n_lines").alias("n_lines"), F.col(f"`{name}`.row").alias("row"),
    )
    text = F.coalesce(F.col("doc.text").cast("string"), F.lit(""))
    alone = packed.where("row is null").select(
        "doc.*", F.struct(text.alias("text"), "n_lines", F.lit(0).cast("long").alias("n_dropped")).alias(name)
    )
    cut = join_keyed(packed.where("row is not null"), drops, "row", "copies", "left")
    cut = cut.select(
        "doc.*",
        F.struct(
            _without(text, F.col("drop")).alias("text"),
            "n_lines",
            F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"),
        ).alias(name),
    )
    return alone.union(cut)
