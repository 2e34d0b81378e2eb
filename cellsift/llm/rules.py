"""Quality rules: decision lists learned from labelled text statistics.

Sequential covering (as in IREP, Fuernkranz and Widmer, 1994): a rule for the
rejected class grows threshold by threshold on two thirds of the labelled rows
by information gain, is pruned on the rest, and leaves the rows it covers out
of the next rule's sight. The list becomes one ordered Spark expression.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellsift.llm.words import _SPACE, Words, find_words, mix, slices, text_buffer, windows, told_apart

#: Labelled documents to learn from, at most about this many; a documented bound.
LABELLED_ROWS = 20_000
MIN_PRECISION = 0.9
MAX_RULES = 12
MAX_TERMS = 4

_SYMBOL = np.zeros(256, dtype=np.int64)
_SYMBOL[list(b"#*$%&|<>")] = 1
_BLANK = " \t\n\r\v\f"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: What thresholds are set on: columns of ``measured`` or their ratios.
RATIOS = {
    "n_words": ("n_words", None),
    "word_length": ("word_chars", "n_words"),
    "symbol_share": ("n_symbols", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_words"),
    "repeat_share": ("n_repeat_words", "n_words"),
}


def repeated_words(words: Words, size: int = 3) -> np.ndarray:
    """Per text: words within windows of ``size`` words found twice or more in it."""
    begin, value = windows(words, size)
    if not len(begin):
        return np.zeros(words.docs, dtype=np.int64)
    value = mix(value + words.doc[begin].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(value)
    value = value[order]
    same = value[1:] == value[:-1]
    twice = np.zeros(len(value), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    begin = begin[order[twice]]
    inside = np.zeros(len(words.doc), dtype=bool)
    for k in range(size):
        inside[begin + k] = True
    return np.bincount(words.doc[inside], minlength=words.docs)


def _per_text(units: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(units)])
    return total[offsets[1:]] - total[offsets[:-1]]


def duplicate_lines(text: str | None) -> int:
    if not text:
        return 0
    lines = [line for line in text.split("\n") if line.strip(_BLANK)]
    return len(lines) - len(set(lines))


def text_statistics(column: pa.Array) -> dict[str, np.ndarray]:
    """The base statistics of the texts of one slice."""
    words = find_words(column)
    words = words._replace(hash=told_apart(words.data, words.start, words.end, words.hash))
    data, offsets = text_buffer(column)
    return {
        "n_words": np.bincount(words.doc, minlength=words.docs),
        "word_chars": _per_text(~_SPACE[data] & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": _per_text(_SYMBOL[data], offsets),
        "n_dup_lines": np.array([duplicate_lines(t) for t in column.to_pylist()], dtype=np.int64),
        "n_repeat_words": repeated_words(words),
    }


@F.arrow_udf(T.StructType([T.StructField(n, T.LongType()) for n in BASE]))
def _statistics(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for column in columns:
        parts = []
        for begin, end in slices(column):
            found = text_statistics(column.slice(begin, end - begin))
            parts.append(pa.StructArray.from_arrays([pa.array(found[n].astype(np.int64)) for n in BASE], list(BASE)))
        yield pa.concat_arrays(parts)


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs``, the base statistics of ``text``, and ``base_failed``.

    A null text has no words. ``base_failed``: fewer than 50 words, or more than
    half of the words in repeated 3-word windows.
    """
    # Names that a document's own columns cannot clash with.
    out = docs.select(*keep, _statistics(F.col("text").cast("string")).alias("_stats"))
    out = out.select(*keep, *(F.col(f"_stats.{n}").alias(n) for n in BASE))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.withColumn("base_failed", failed)


class Term(NamedTuple):
    name: str
    above: bool
    limit: float

    def column(self) -> F.Column:
        top, under = RATIOS[self.name]
        value = F.col(top) if under is None else F.col(top) / F.greatest(F.col(under), F.lit(1))
        return value > self.limit if self.above else value <= self.limit

    def holds(self, rows: dict[str, np.ndarray]) -> np.ndarray:
        return rows[self.name] > self.limit if self.above else rows[self.name] <= self.limit


class Rule(NamedTuple):
    terms: tuple[Term, ...]
    precision: float

    def covers(self, rows: dict[str, np.ndarray]) -> np.ndarray:
        return np.logical_and.reduce([t.holds(rows) for t in self.terms])

    def column(self) -> F.Column:
        return reduce(lambda a, b: a & b, [t.column() for t in self.terms])


def ratios(stats: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {
        name: stats[top].astype(float) / (np.maximum(stats[under], 1) if under else 1)
        for name, (top, under) in RATIOS.items()
    }


def _best_term(rows: dict[str, np.ndarray], bad: np.ndarray) -> tuple[float, Term | None]:
    """The threshold with the greatest information gain for the rejected class."""
    p0, n0 = bad.sum(), len(bad)
    best, term = 0.0, None
    for name, value in rows.items():
        order = np.argsort(value, kind="stable")
        v, b = value[order], np.cumsum(bad[order])
        cut = np.flatnonzero(v[1:] > v[:-1])
        if not len(cut):
            continue
        below, n_below = b[cut], cut + 1
        for above, p, n in ((False, below, n_below), (True, p0 - below, n0 - n_below)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / n) - np.log2(p0 / n0)), 0)
            k = int(gain.argmax())
            if gain[k] > best + 1e-9:
                best, term = float(gain[k]), Term(name, above, float((v[cut[k]] + v[cut[k] + 1]) / 2))
    return best, term


def _at(rows: dict[str, np.ndarray], mask: np.ndarray) -> dict[str, np.ndarray]:
    return {name: value[mask] for name, value in rows.items()}


def learn(rows: dict[str, np.ndarray], bad: np.ndarray) -> list[Rule]:
    """Ordered rules that reject; empty if nothing can be told from the rows."""
    part = np.arange(len(bad)) % 3 == 2
    rules: list[Rule] = []
    while len(rules) < MAX_RULES:
        grow, prune = ~part, part
        if bad[grow].sum() < 5:
            break
        terms: list[Term] = []
        mask = grow.copy()
        while len(terms) < MAX_TERMS and bad[mask].mean() < 1:
            _, term = _best_term(_at(rows, mask), bad[mask])
            if term is None:
                break
            terms.append(term)
            mask &= term.holds(rows)

        def worth(some: list[Term]) -> tuple[float, float]:
            got = Rule(tuple(some), 0).covers(rows) & prune
            p, n = bad[got].sum(), got.sum()
            return ((2 * p - n) / n if n else -1.0), ((p + 1) / (n + 2))

        while len(terms) > 1 and worth(terms[:-1])[0] >= worth(terms)[0]:
            terms.pop()
        if not terms or worth(terms)[1] < MIN_PRECISION:
            break
        rules.append(Rule(tuple(terms), float(worth(terms)[1])))
        left = ~rules[-1].covers(rows)
        rows, bad, part = _at(rows, left), bad[left], part[left]
    return rules


def verdict(rules: list[Rule]) -> F.Column:
    """The number of the first rule that rejects a row, from 1; 0 if none does."""
    out = F.lit(0)
    for number, rule in reversed(list(enumerate(rules, 1))):
        out = F.when(rule.column(), F.lit(number)).otherwise(out)
    return out


def labelled(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """``docs`` with ``quality``, about ``rows`` of them chosen by a hash of ``doc_id``.

    Documents labelled both ways, or not 0 or 1, are left out.
    """
    one = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id")
    one = one.agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
    one = one.where("quality = most").select(F.col("doc_id").cast("long").alias("_id"), "quality")
    total = one.count()
    if total > rows:
        one = one.where(F.xxhash64("_id") / float(1 << 64) + 0.5 < rows / total)
    clash = [c for c in docs.columns if c.lower() in ("quality", "_id")]
    # At most about ``rows`` ids and labels, so no text is shuffled for the sample.
    return docs.drop(*clash).join(F.broadcast(one), F.col("doc_id").cast("long") == F.col("_id"))


def learn_rules(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> list[Rule]:
    """Rules from a bounded sample of labelled documents (``rows``)."""
    sample = labelled(docs.select("doc_id", "text"), labels, rows)
    sample = measured(sample, ["_id", "quality"]).drop("base_failed").toPandas().sort_values(["_id", *BASE])
    stats = {name: sample[name].to_numpy() for name in BASE}
    return learn(ratios(stats), sample["quality"].to_numpy() == 0)


def apply_rules(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """``doc_id``, statistics, ``base_failed``, ``kept`` and ``rule`` for each row of ``docs``.

    ``rule`` is the first learned rule that rejects the row, 0 if none does.
    Null and empty texts have no words, thus fail the base. Rows that repeat are
    judged one by one; other columns of ``docs`` are ignored.
    """
    out = measured(docs.select("doc_id", "text"), ["doc_id"])
    out = out.withColumn("rule", verdict(rules).cast("int"))
    return out.select("doc_id", *BASE, "base_failed", (~F.col("base_failed") & (F.col("rule") == 0)).alias("kept"), "rule")
