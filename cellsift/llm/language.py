"""Language identification by rank-order n-gram profiles.

A profile is the list of a language's most frequent letter n-grams (one to three
letters, with word ends), in order of frequency (Cavnar and Trenkle, 1994). A
text has such a list too; its language is the profile with the least sum of
out-of-place distances. Profiles are counted by Spark over all training texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellsift.llm.words import slices

PROFILE = 400
UNKNOWN = "und"

#: A word end in an n-gram; below all letters.
_END = 1


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """The code point of each letter, the word end for any other character."""
    table = np.full(0x110000, _END, dtype=np.uint64)
    for point in range(0x110000):
        if chr(point).isalpha():
            table[point] = point
    return table


def grams(text: str) -> np.ndarray:
    """All n-grams of a text, each a number of up to three 21-bit code points."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    c = _letters()[points]
    letter = c != _END
    # Runs of other characters count as one word end.
    c = c[np.concatenate([[True], letter[1:] | letter[:-1]])]
    letter = c != _END
    two = (c[:-1] << np.uint64(21)) | c[1:]
    three = (two[:-1] << np.uint64(21)) | c[2:]
    # A word end may stand first or last, not between two words.
    return np.concatenate([c[letter], two[letter[1:] | letter[:-1]], three[letter[1:-1]]])


def counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values = np.sort(values)
    if not len(values):
        return values, np.zeros(0, dtype=np.int64)
    at = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return values[at], np.diff(np.concatenate([at, [len(values)]]))


class Counter:
    """Counts of n-grams by language; merges as it grows."""

    def __init__(self) -> None:
        self.waiting: dict[str, list[np.ndarray]] = {}
        self.size: dict[str, int] = {}
        self.total: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def add(self, lang: str, values: np.ndarray) -> None:
        self.waiting.setdefault(lang, []).append(values)
        self.size[lang] = self.size.get(lang, 0) + len(values)
        if self.size[lang] > 2_000_000:
            self.merge(lang)

    def merge(self, lang: str) -> None:
        value, count = counted(np.concatenate(self.waiting.pop(lang, [np.zeros(0, np.uint64)])))
        old, n = self.total.get(lang, (value[:0], count[:0]))
        both, at = np.unique(np.concatenate([old, value]), return_inverse=True)
        self.total[lang] = both, np.bincount(at, np.concatenate([n, count]), len(both)).astype(np.int64)
        self.size[lang] = 0

    def batches(self) -> Iterator[pa.RecordBatch]:
        for lang in list(self.waiting):
            self.merge(lang)
        for lang, (value, count) in self.total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(value)), pa.array(value.astype(np.int64)), pa.array(count)],
                names=["lang", "gram", "n"],
            )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counter = Counter()
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counter.add(lang, grams(text))
    yield from counter.batches()


class Profiles(NamedTuple):
    """Languages, and the rank of each profile n-gram in each (``size`` if it is absent)."""

    langs: list[str]
    grams: np.ndarray
    ranks: np.ndarray
    size: int

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and a score: 1 less the distance as a share of the greatest one."""
        value, count = counted(grams(text)) if text else (np.zeros(0, np.uint64), None)
        if not len(value) or not self.langs:
            return UNKNOWN, 0.0
        if len(value) > self.size:
            # All n-grams as frequent as the last that has a place compete for it.
            least = np.partition(count, len(count) - self.size)[len(count) - self.size]
            value, count = value[count >= least], count[count >= least]
        value = value[np.lexsort((value, -count))][: self.size]
        at = np.minimum(np.searchsorted(self.grams, value), len(self.grams) - 1)
        known = self.grams[at] == value
        place = np.arange(len(value))[known, None]
        rank = self.ranks[at[known]]
        # An n-gram that a profile lacks is as far out of place as can be.
        apart = np.where(rank == self.size, self.size, np.abs(rank - place)).sum(axis=0) + self.size * (~known).sum()
        best = int(apart.argmin())
        return self.langs[best], float(1 - apart[best] / (self.size * len(value)))


def learn(docs: DataFrame, size: int = PROFILE) -> Profiles:
    """Profiles from the ``text`` of ``docs``, by ``lang``; rows with nulls are left out."""
    rows = docs.where("lang is not null and text is not null")
    rows = rows.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = rows.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    # A plain limit on the number lets every task drop all but its first ``size`` before the shuffle.
    ranked = counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= size)
    top = ranked.withColumn("rank", F.col("place") - 1)
    # As many rows as languages x ``size``.
    found = top.select("lang", "gram", "rank").collect()
    langs = sorted({r["lang"] for r in found})
    values = np.unique(np.array([r["gram"] for r in found], dtype=np.uint64))
    ranks = np.full((len(values), len(langs)), size, dtype=np.int32)
    for r in found:
        ranks[np.searchsorted(values, np.uint64(r["gram"])), langs.index(r["lang"])] = r["rank"]
    return Profiles(langs, values, ranks, size)


def predict(docs: DataFrame, profiles: Profiles, name: str = "_lang") -> DataFrame:
    """``docs`` with a struct column ``name`` of ``lang_pred`` and ``score`` (0 to 1).

    Only ``text`` is read. A text that is null or has no letter is ``und`` with a
    score of 0. Distances that tie go to the language first in order of name.
    """

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def judge(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            found = [profiles.predict(t) for b, e in slices(column) for t in column.slice(b, e - b).to_pylist()]
            yield pa.StructArray.from_arrays(
                [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["lang_pred", "score"],
            )

    return docs.withColumn(name, judge(F.col("text").cast("string")))


def held_out() -> F.Column:
    """Whether a document takes no part in training: CRC-32 of its id leaves 2 by 4."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, size: int = PROFILE) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for each row, learned from the rows not held out.

    A null ``doc_id`` is neither held out nor learned from.
    """
    profiles = learn(docs.where(~held_out() & F.col("doc_id").isNotNull()).select("lang", "text"), size)
    out = predict(docs.select("doc_id", "text"), profiles)
    return out.select("doc_id", held_out().alias("held_out"), F.col("_lang.lang_pred"), F.col("_lang.score"))
