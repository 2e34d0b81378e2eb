"""Spelling variants: words one edit apart, by dynamic programming over sorted lists.

Two words one edit apart share their first half or their last half, so words meet
in lists by half; a list that is too long is split in the same way, by halves of
what is not shared yet, and each pair belongs to one list only. A list is sorted.
The words that ask go through it together: a row of the edit matrix, three cells
around the diagonal, is made once for each prefix that the common prefixes of
neighbours delimit, serves all words that share the prefix, and where no cell is
within one edit the whole range of these words is skipped.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellsift.llm.keyed import join_keyed
from cellsift.llm.lines import _LOWER
from cellsift.llm.words import slices, text_buffer
from cellsift.sources.scratch import cut_lineage

WORD_CHARS = 6
LEAST_COUNT = 5
#: A form occurs at least so many times as often as its variant.
FORM_RATIO = 5
#: A run whose hash this divides loses one code point.
SLIP = 199
#: Words of a list; longer lists are split further.
LIST_ROWS = 4096
#: Rows of a step's matrix, and rows that a task works on at once.
STEP_ROWS = 1 << 21
CHUNK_ROWS = 1 << 15
#: Longer runs are hashed one by one.
SHORT_RUN = 64

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
#: UTF-8 writes U+00C0 to U+00FF as this byte and one more.
_LATIN = 0xC3


def _crc_steps() -> np.ndarray:
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = np.where(steps & 1, (steps >> 1) ^ np.uint32(0xEDB88320), steps >> 1)
    return steps


_CRC = _crc_steps()


def _run_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, begun: np.ndarray) -> np.ndarray:
    """CRC-32 of each span, continued from ``begun``."""
    size = end - start
    order = np.argsort(-size, kind="stable")
    first, size = start[order], size[order]
    state = begun[order].astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    long = int(np.searchsorted(-size, -SHORT_RUN, side="left"))
    for k in range(min(SHORT_RUN, int(size[0])) if len(size) else 0):
        some = slice(long, int(np.searchsorted(-size, -k, side="left")))
        state[some] = (state[some] >> np.uint32(8)) ^ _CRC[(state[some] ^ data[first[some] + k]) & np.uint32(255)]
    out = np.empty(len(size), dtype=np.uint32)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    for i in order[:long].tolist():
        out[i] = zlib.crc32(data[start[i] : end[i]], int(begun[i]))
    return out


def count_words(ids: pa.Array, column: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Distinct words of the texts of a slice and how often each occurs, after slips."""
    raw, offsets = text_buffer(column)
    data = _LOWER[raw]
    lead = data == _LATIN
    inside = _LETTER[data] | lead
    inside[1:] |= lead[:-1]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    open_ = np.concatenate([[False], inside, [False]])
    start = np.flatnonzero(inside & (~open_[:-2] | edge[:-1]))
    end = np.flatnonzero(inside & (~open_[2:] | edge[1:])) + 1
    points = np.flatnonzero((data & 0xC0) != 0x80)
    a = np.searchsorted(points, start)
    length = np.searchsorted(points, end) - a
    some = length >= WORD_CHARS
    start, end, a, length = start[some], end[some], a[some], length[some]
    doc = np.searchsorted(offsets, start, side="right") - 1
    begun = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids.to_pylist()], dtype=np.uint32)
    value = _run_hashes(data, start, end, begun[doc])
    slip = np.flatnonzero(value % SLIP == 0)
    gone = points[a[slip] + value[slip] % length[slip]]
    wide = data[gone] == _LATIN
    size = end - start
    size[slip] -= 1 + wide
    length[slip] -= 1
    keep = np.zeros(len(data) + 1, dtype=np.int8)
    some = length >= WORD_CHARS
    np.add.at(keep, start[some], 1)
    np.add.at(keep, end[some], -1)
    keep = np.cumsum(keep[:-1], dtype=np.int8).astype(bool)
    keep[gone] = False
    keep[gone[wide] + 1] = False
    bounds = np.concatenate([[0], np.cumsum(size[some])]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.tobytes()), pa.py_buffer(data[keep].tobytes()))
    counted = pc.value_counts(words)
    return counted.field(0), counted.field(1)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, column = batch.columns
        for begin, end in slices(column):
            word, n = count_words(ids.slice(begin, end - begin), column.slice(begin, end - begin))
            yield pa.RecordBatch.from_arrays([word, n], names=["word", "n"])


def vocabulary(docs: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """``(word, n)`` of words of 6 code points or more with ``least`` occurrences or more."""
    texts = docs.select(F.col("doc_id").cast("string").alias("id"), F.col("text").cast("string").alias("text"))
    found = texts.mapInArrow(_counts, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _placed(rows: DataFrame) -> DataFrame:
    """List ``key`` and unshared ``window`` of words that share ``a`` points at the front and ``b`` at the back."""
    size = F.length("word")
    shared = F.concat(F.expr("left(word, a)"), F.lit("/"), F.expr("right(word, b)"))
    return rows.withColumns(
        {
            "key": F.concat_ws("/", F.col("m").cast("string"), F.col("a").cast("string"), F.col("b").cast("string"), shared),
            "window": F.substring("word", F.col("a") + 1, size - F.col("a") - F.col("b")),
        }
    )


def _halves() -> Column:
    """The two lists that a list is split into: half of the window shared at the front, or at the back."""
    left = F.col("m") - F.col("a") - F.col("b")
    front, back = F.ceil(left / 2).cast("int"), F.floor(left / 2).cast("int")
    return F.array(
        F.struct((F.col("a") + front).alias("a"), F.col("b").alias("b")),
        F.struct(F.col("a").alias("a"), (F.col("b") + back).alias("b")),
    )


def lists(words: DataFrame, kept: list[str], list_rows: int = LIST_ROWS) -> DataFrame:
    """``word, n, m, a, b, key, window``: each word in the lists where pairs of shorter length ``m`` meet.

    A list has ``list_rows`` words at most, or words that differ in two places next
    to each other only, which are 96 * 96 at most, as words are distinct.
    """
    size = F.length("word")
    classes = F.when(size > WORD_CHARS, F.array(size, size - 1)).otherwise(F.array(size))
    none = F.lit(0)
    rows = words.select("word", "n", F.explode(classes).alias("m")).withColumns({"a": none, "b": none})
    split = rows.select("word", "n", "m", F.explode(_halves()).alias("h")).select("word", "n", "m", "h.*")
    rows = cut_lineage(_placed(split), "lists", kept)
    while True:
        over = rows.where("m - a - b > 1").groupBy("key").agg(F.count("*").alias("over")).where(F.col("over") > list_rows)
        over = cut_lineage(over, "over", kept)
        if over.isEmpty():
            return rows
        marked = join_keyed(rows, over, "key", "over", "left")
        same = F.array(F.struct("a", "b"))
        split = marked.withColumn("h", F.explode(F.when(F.col("over").isNull(), same).otherwise(_halves())))
        rows = cut_lineage(_placed(split.select("word", "n", "m", "h.*")), "lists", kept)


class _Lists:
    """Sorted lists, one after another, as arrays: windows as Latin-1 bytes, and prefixes shared with the row before."""

    def __init__(self, table: pa.Table):
        key = table.column("key").combine_chunks().dictionary_encode().indices.to_numpy()
        self.words = table.column("word").combine_chunks()
        self.n = table.column("n").to_numpy()
        self.longer = table.column("longer").to_numpy()
        self.back = table.column("back").to_numpy()
        windows = [w.encode("latin-1") for w in table.column("window").to_pylist()]
        self.size = np.array([len(w) for w in windows], dtype=np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.size)])[:-1]
        self.code = np.frombuffer(b"".join(windows) + b"\0\0", dtype=np.uint8)
        new = np.concatenate([[True], key[1:] != key[:-1]])
        self.first = np.flatnonzero(new)
        self.list = np.cumsum(new) - 1
        self.last = np.append(self.first[1:], len(key))
        self.shared = self._prefixes(new)

    def _prefixes(self, new: np.ndarray) -> np.ndarray:
        """Bytes that a row shares with the row before; -1 at the head of a list."""
        out = np.where(new, -1, 0)
        some, t = np.flatnonzero(~new), 0
        while len(some):
            both = (self.size[some] > t) & (self.size[some - 1] > t)
            some = some[both]
            some = some[self.code[self.at[some] + t] == self.code[self.at[some - 1] + t]]
            t += 1
            out[some] = t
        return out

    def near(self, ask: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows one edit apart from the asking rows, which are none of the longer words."""
        lo, hi = self.first[self.list[ask]], self.last[self.list[ask]]
        far = np.int8(3)
        # Cells left of, on and right of the diagonal.
        left, on = np.full(len(ask), far), np.zeros(len(ask), dtype=np.int8)
        right = np.where(self.size[ask] > 0, np.int8(1), far)
        equal = np.ones(len(ask), dtype=bool)
        for t in range(int(self.size.max(initial=0)) + 1):
            # The first word of a range ends here: it is the prefix itself.
            done = self.size[lo] == t
            gap = self.size[ask] - t
            cell = np.where(gap == 0, on, np.where(gap == 1, right, np.where(gap == -1, left, far)))
            # What follows a whole window belongs to the list of a longer front.
            found = done & (cell == 1) & ~((gap == -1) & equal & self.back[ask])
            yield ask[found], lo[found]
            lo = lo + done
            some = lo < hi
            ask, lo, hi, left, on, right, equal = (x[some] for x in (ask, lo, hi, left, on, right, equal))
            if not len(ask):
                return
            # Ranges part where a row shares no more than this prefix with the row before.
            heads = np.flatnonzero(self.shared <= t)
            begin = np.searchsorted(heads, lo, side="right")
            parts = 1 + np.searchsorted(heads, hi, side="left") - begin
            up = np.repeat(np.arange(len(ask)), parts)
            place = np.arange(len(up)) - np.repeat(np.cumsum(parts) - parts, parts)
            here = np.append(heads, len(self.shared))
            start = np.where(place == 0, lo[up], here[np.minimum(begin[up] + place - 1, len(heads))])
            stop = np.where(place == parts[up] - 1, hi[up], here[np.minimum(begin[up] + place, len(heads))])
            ask, left, on, right, equal = (x[up] for x in (ask, left, on, right, equal))
            char, size, at = self.code[self.at[start] + t], self.size[ask], self.at[ask]

            def differs(k: int) -> np.ndarray:
                inside = (size > k) & (k >= 0)
                return np.where(inside, self.code[np.where(inside, at + k, 0)] != char, True)

            same = differs(t)
            new_left = np.where(size >= t, np.minimum(left + differs(t - 1), on + 1), far)
            new_on = np.where(size >= t + 1, np.minimum(np.minimum(on + same, right + 1), new_left + 1), far)
            new_right = np.where(size >= t + 2, np.minimum(right + differs(t + 1), new_on + 1), far)
            equal = equal & (~same | (size <= t))
            alive = np.minimum(np.minimum(new_left, new_on), new_right) <= 1
            ask, lo, hi, equal = ask[alive], start[alive], stop[alive], equal[alive]
            left, on, right = (x[alive].astype(np.int8) for x in (new_left, new_on, new_right))
            if not len(ask):
                return

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows and rows near them, each pair once in each direction."""
        rows = self.last[self.list] - self.first[self.list]
        ask = np.flatnonzero(~self.longer & (rows > 1))
        steps = np.cumsum(rows[ask]) // STEP_ROWS
        one, two = [], []
        for k in np.unique(steps):
            for a, b in self.near(ask[steps == k]):
                one += [a, b[self.longer[b]]]
                two += [b, a[self.longer[b]]]
        none = np.zeros(0, dtype=np.int64)
        return np.concatenate([*one, none]), np.concatenate([*two, none])


def _judge(table: pa.Table) -> pa.RecordBatch:
    """Near words of each word in these lists: their number and the most frequent, first in order of several."""
    whole = _Lists(table)
    row, other = whole.pairs()
    rank = np.empty(len(whole.words), dtype=np.int64)
    rank[pc.sort_indices(whole.words).to_numpy()] = np.arange(len(rank))
    order = np.lexsort((rank[other], -whole.n[other], row))
    row, other = row[order], other[order]
    some, first, count = np.unique(row, return_index=True, return_counts=True)
    best = other[first]
    columns = [whole.words.take(pa.array(some)), pa.array(count), pa.array(whole.n[best]), whole.words.take(pa.array(best))]
    return pa.RecordBatch.from_arrays(columns, names=["word", "n_near", "best_n", "best"])


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole lists at a time; rows come sorted by list and window."""
    held: pa.Table | None = None
    for batch in batches:
        held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        if held.num_rows < CHUNK_ROWS:
            continue
        last = held.column("key")[-1]
        upto = pc.index(held.column("key"), last).as_py()
        if upto:
            yield _judge(held.slice(0, upto))
            held = held.slice(upto).combine_chunks()
    if held is not None and held.num_rows:
        yield _judge(held)


def variants(docs: DataFrame, kept: list[str], list_rows: int = LIST_ROWS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of each word of the vocabulary.

    A word's form is its most frequent near word (the first in code-point order of
    several) if that occurs five times as often or more; the root is the last form
    that forms lead to, the word itself if it has none. A null text has no words
    and a null ``doc_id`` is hashed as an empty one; repeated rows count again. An
    empty table has no words; other columns are ignored; texts and words may be of
    any length.
    """
    words = cut_lineage(vocabulary(docs), "words", kept)
    placed = lists(words, kept, list_rows).select(
        "key", "window", "word", "n", (F.length("word") > F.col("m")).alias("longer"), (F.col("b") > 0).alias("back")
    )
    dealt = placed.repartition("key").sortWithinPartitions("key", "window")
    found = dealt.mapInArrow(_judged, "word string, n_near long, best_n long, best string")
    none = F.lit(None).cast("long")
    every = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), none.alias("best_n"), F.lit(None).cast("string").alias("best"))
    every = every.unionByName(found.withColumn("n", none))
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), "best")))
    every = every.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("near"))
    strong = -F.col("near.less") >= FORM_RATIO * F.col("n")
    every = every.select(
        "word", "n", "n_near", F.when(strong, F.col("near.best")).alias("form"), F.when(strong, -F.col("near.less")).alias("form_n")
    )
    every = cut_lineage(every, "near", kept)

    # Counts grow fivefold from form to form, so a few doublings reach the roots.
    roots = every.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        roots = cut_lineage(roots, "roots", kept)
        if roots.where("moved").isEmpty():
            break
        roots = roots.drop("moved")
    out = every.join(roots.drop("moved"), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
