"""Quality classifier: co-training of a text view and a metadata view.

Two logistic classifiers look at different columns: one at the text, one at what
is known about the page without reading it. Both start from labelled documents;
in each round each labels the unlabelled documents it is surest about for the
other (Blum and Mitchell, 1998). Held-out labelled documents calibrate both
(Platt scaling), and the combined view weighs the calibrated log odds on the
same rows. Labelled documents to fit on are a bounded sample; in every round all
unlabelled documents are scored in Spark, and the surest of each label are lent.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellsift.llm.rules import labelled, text_statistics
from cellsift.llm.words import _SPACE, slices, text_buffer
from cellsift.sources.scratch import cut_lineage, drop_written

#: Most labelled documents to fit on, on average; a documented bound.
LABELLED_ROWS = 20_000
ROUNDS = 5
#: Groups of partitions among which the surest documents are found before the last choice.
GROUPS = 64
#: A calibrated probability from which a view's label is lent to the other view.
CONFIDENT = 0.97
#: Documents below this combined probability of good quality are rejected.
THRESHOLD = 0.5

SOURCE_BUCKETS = 64
LANG_BUCKETS = 16

_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def text_features(column: pa.Array) -> np.ndarray:
    """One row per text of a slice."""
    stats = text_statistics(column)
    data, offsets = text_buffer(column)

    def count(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return total[offsets[1:]] - total[offsets[:-1]]

    words = np.maximum(stats["n_words"], 1)
    inside = np.maximum(count(~_SPACE[data]), 1)
    lines = count(data == 10) + 1
    shares = [
        stats["n_symbols"] / words,
        stats["n_dup_lines"] / lines,
        stats["n_repeat_words"] / words,
        count(data == 33) / words,
        count(_UPPER[data]) / inside,
        count(_DIGIT[data]) / inside,
        1 - count(_LETTER[data]) / inside,
    ]
    sizes = [np.log1p(stats["n_words"]), stats["word_chars"] / words, np.log1p(words / lines)]
    # Square roots let a little of something rare count for more than its share.
    return np.column_stack([*shares, *(np.sqrt(np.maximum(s, 0)) for s in shares), *sizes, (stats["n_words"] == 0)])


def _bucket(values: list, buckets: int) -> np.ndarray:
    out = np.zeros((len(values), buckets))
    for i, value in enumerate(values):
        if value is not None:
            out[i, zlib.crc32(value.encode()) % buckets] = 1
    return out


def meta_features(source: pa.Array, lang: pa.Array, n_chars: pa.Array) -> np.ndarray:
    size = np.array([-1 if v is None else max(v, 0) for v in n_chars.to_pylist()], dtype=float)
    known = size >= 0
    log = np.log1p(np.maximum(size, 0))
    return np.column_stack(
        [log, log * log, ~known, _bucket(source.to_pylist(), SOURCE_BUCKETS), _bucket(lang.to_pylist(), LANG_BUCKETS)]
    )


class Logistic(NamedTuple):
    """A logistic model on standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray

    def odds(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return z @ self.weight[1:] + self.weight[0]


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> Logistic:
    """Newton's method with an L2 penalty on all but the intercept."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-9] = 1.0
    z = np.column_stack([np.ones(len(x)), np.clip((x - mean) / scale, -8, 8)])
    weight = np.zeros(z.shape[1])
    ridge = np.full(len(weight), penalty)
    ridge[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ weight, -30, 30)))
        slope = z.T @ (p - y) + ridge * weight
        curve = (z * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ z + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        weight -= step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return Logistic(mean, scale, weight)


def _chance(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


class Model(NamedTuple):
    """Both views, their calibration, and how they combine; ``views`` is empty without labels."""

    views: tuple[Logistic, ...]
    calibration: tuple[Logistic, ...]
    combined: Logistic | None
    base: float
    lent: tuple[int, int]

    def score(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of good quality by text, by metadata, and combined."""
        if not self.views:
            return tuple(np.full(len(text), self.base) for _ in range(3))
        odds = [c.odds(v.odds(x)[:, None]) for v, c, x in zip(self.views, self.calibration, (text, meta))]
        return _chance(odds[0]), _chance(odds[1]), _chance(self.combined.odds(np.column_stack(odds)))


class Lent(NamedTuple):
    """Documents that one view labels for the other: ``to`` is the view that gets them."""

    to: int
    label: float
    features: np.ndarray


#: Takes views, calibrations and how many to lend of each label; a document goes to a view once.
Lender = Callable[[list[Logistic], list[Logistic], dict[float, int]], list[Lent]]


def co_train_with(text: np.ndarray, meta: np.ndarray, y: np.ndarray, lend: Lender, rounds: int = ROUNDS) -> Model:
    """Fit both views on labelled rows, let labels be lent in rounds, calibrate on every fourth row."""
    held = np.arange(len(y)) % 4 == 3
    if min(y[~held].sum(), (1 - y[~held]).sum()) < 5 or min(y[held].sum(), (1 - y[held]).sum()) < 2:
        return Model((), (), None, float(y.mean()) if len(y) else 1.0, (0, 0))
    x = (text, meta)
    lent_x: list[list[np.ndarray]] = [[], []]
    lent_y: list[list[np.ndarray]] = [[], []]
    per_round = max(10, int((~held).sum()) // 10)
    wanted = {label: max(1, int(per_round * share)) for label, share in ((1.0, y.mean()), (0.0, 1 - y.mean()))}
    for number in range(rounds + 1):
        views = [
            fit_logistic(np.vstack([x[v][~held], *lent_x[v]]), np.concatenate([y[~held], *lent_y[v]])) for v in (0, 1)
        ]
        calibration = [fit_logistic(views[v].odds(x[v][held])[:, None], y[held], 1e-3) for v in (0, 1)]
        found = [] if number == rounds else [f for f in lend(views, calibration, wanted) if len(f.features)]
        if not found:
            break
        for some in found:
            lent_x[some.to].append(some.features)
            lent_y[some.to].append(np.full(len(some.features), some.label))
    odds = np.column_stack([calibration[v].odds(views[v].odds(x[v][held])[:, None]) for v in (0, 1)])
    combined = fit_logistic(odds, y[held], 1e-2)
    lent = tuple(int(sum(map(len, lent_y[v]))) for v in (0, 1))
    return Model(tuple(views), tuple(calibration), combined, float(y.mean()), lent)


def co_train(
    text: np.ndarray, meta: np.ndarray, y: np.ndarray, pool_text: np.ndarray, pool_meta: np.ndarray, rounds: int = ROUNDS
) -> Model:
    """``co_train_with`` for unlabelled rows at hand, of equally sure ones the first."""
    pool = (pool_text, pool_meta)
    free = [np.ones(len(pool_text), dtype=bool), np.ones(len(pool_text), dtype=bool)]

    def lend(views: list[Logistic], calibration: list[Logistic], wanted: dict[float, int]) -> list[Lent]:
        out = []
        for v in (0, 1):
            other = 1 - v
            p = _chance(calibration[v].odds(views[v].odds(pool[v])[:, None]))
            for label, sure in ((1.0, p), (0.0, 1 - p)):
                some = np.flatnonzero(free[other] & (sure >= CONFIDENT))
                some = some[np.argsort(-sure[some], kind="stable")][: wanted[label]]
                free[other][some] = False
                out.append(Lent(other, label, pool[other][some]))
        return out

    return co_train_with(text, meta, y, lend, rounds)


def _columns(docs: DataFrame, text: str = "text") -> list[F.Column]:
    """The columns the views read; a metadata column that is missing is null."""
    have = set(docs.columns)
    kinds = {"source": "string", "lang": "string", "n_chars": "double"}
    meta = [(F.col(c) if c in have else F.lit(None)).cast(kind) for c, kind in kinds.items()]
    return [F.col(text).cast("string"), *meta]


@F.arrow_udf(T.StructType([T.StructField(n, T.ArrayType(T.DoubleType())) for n in ("text", "meta")]))
def _features(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    for text, *meta in columns:
        parts = [text_features(text.slice(b, e - b)) for b, e in slices(text)]
        both = [pa.array(list(x), pa.list_(pa.float64())) for x in (np.vstack(parts), meta_features(*meta))]
        yield pa.StructArray.from_arrays(both, ["text", "meta"])


def _sampled(docs: DataFrame, extra: list[str]) -> tuple[np.ndarray, np.ndarray, object]:
    rows = docs.select(*extra, _features(*_columns(docs)).alias("_f")).select(*extra, "_f.*").toPandas()
    rows = rows.assign(key=[hash(tuple(t)) for t in rows["text"]]).sort_values([*extra, "key"])
    if not len(rows):
        return np.zeros((0, 18)), np.zeros((0, 3 + SOURCE_BUCKETS + LANG_BUCKETS)), rows
    return np.vstack(rows["text"].tolist()), np.vstack(rows["meta"].tolist()), rows


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def _text_view(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for text in texts:
        parts = [text_features(text.slice(b, e - b)) for b, e in slices(text)]
        yield pa.array(list(np.vstack(parts)), pa.list_(pa.float64()))


def unlabelled(docs: DataFrame, labels: DataFrame, kept: list[str]) -> DataFrame:
    """Features of all documents without a label, written once for all rounds: ``_id, x``, metadata, ``_row``."""
    text, source, lang, n_chars = _columns(docs)
    made = docs.select(
        F.col("doc_id").cast("long").alias("_id"), _text_view(text).alias("x"),
        source.alias("source"), lang.alias("lang"), n_chars.alias("n_chars"),
    )
    known = labels.select(F.col("doc_id").cast("long").alias("_id")).distinct()
    free = made.join(known, "_id", "left_anti").withColumn("_key", F.xxhash64("x", "source", "lang", "n_chars"))
    return cut_lineage(free.withColumn("_row", F.monotonically_increasing_id()), "pool", kept)


def lender(pool: DataFrame) -> Lender:
    """Scores all of ``pool`` in each round and lends the surest, of equally sure ones the least id.

    What comes to the driver is what is lent: a share of the labelled sample.
    """
    gone: list[np.ndarray] = [np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)]

    def lend(views: list[Logistic], calibration: list[Logistic], wanted: dict[float, int]) -> list[Lent]:
        lent = [gone[0], gone[1]]

        @F.arrow_udf("struct<to0:double,to1:double>")
        def chances(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
            for x, row, *meta in columns:
                both = (np.asarray(x.flatten()).reshape(len(x), -1), meta_features(*meta))
                by = [_chance(calibration[v].odds(views[v].odds(both[v])[:, None])) for v in (0, 1)]
                given = [pa.array(by[1 - to], mask=np.isin(np.asarray(row), lent[to])) for to in (0, 1)]
                yield pa.StructArray.from_arrays(given, ["to0", "to1"])

        columns = ("x", "_row", "source", "lang", "n_chars")
        judged = pool.withColumn("_p", chances(*columns)).withColumn("_group", F.spark_partition_id() % GROUPS)
        offers = F.array(*[
            F.struct(F.lit(to).alias("to"), F.lit(label).alias("label"), sure.alias("sure"))
            for to in (0, 1) for label, sure in ((1.0, F.col(f"_p.to{to}")), (0.0, 1 - F.col(f"_p.to{to}")))
        ])
        offers = F.filter(offers, lambda o: F.coalesce(o["sure"] >= CONFIDENT, F.lit(False)))
        rows = judged.select("_id", "_key", *columns, "_group", F.inline(offers))
        first = [F.desc("sure"), "_id", "_key", "_row"]
        most = max(wanted.values())
        # The surest of each group of partitions, then of all: no task meets all that are sure.
        for by in (["to", "label", "_group"], ["to", "label"]):
            place = F.row_number().over(Window.partitionBy(*by).orderBy(*first))
            rows = rows.withColumn("_place", place).where(F.col("_place") <= most)
        found = rows.drop("_group").toPandas()
        out = []
        for to in (0, 1):
            for label in (1.0, 0.0):
                some = found[(found["to"] == to) & (found["label"] == label)].sort_values("_place")[: wanted[label]]
                gone[to] = np.concatenate([gone[to], some["_row"].to_numpy(dtype=np.int64)])
                if not len(some):
                    continue
                meta = [pa.array(some[c], kind, from_pandas=True) for c, kind in zip(columns[2:], (pa.string(), pa.string(), pa.float64()))]
                out.append(Lent(to, label, meta_features(*meta) if to else np.vstack(some["x"].tolist())))
        return out

    return lend


def learn(docs: DataFrame, labels: DataFrame, *, labelled_rows: int = LABELLED_ROWS) -> Model:
    """A model from about ``labelled_rows`` labelled documents and all unlabelled ones.

    Documents without id are unlabelled. Repeated rows are lent one by one.
    Without usable labels nothing is lent.
    """
    text, meta, rows = _sampled(labelled(docs, labels, labelled_rows), ["_id", "quality"])
    written: list[str] = []
    ready: list[Lender] = []

    def lend(*asked) -> list[Lent]:
        if not ready:
            ready.append(lender(unlabelled(docs, labels, written)))
        return ready[0](*asked)

    model = co_train_with(text, meta, rows["quality"].to_numpy(dtype=float), lend)
    drop_written(docs.sparkSession, written)
    return model


def score(docs: DataFrame, model: Model, name: str = "_quality") -> DataFrame:
    """``docs`` with a struct column ``name``: ``text``, ``meta`` and ``both``, each from 0 to 1.

    A null text is an empty one; empty texts are scored by a feature of their
    own. Missing metadata columns and null metadata are "unknown". Without
    usable labels each score is the share of good labels (1 if there are none).
    """

    @F.arrow_udf("struct<text:double,meta:double,both:double>")
    def judge(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for text, *meta in columns:
            parts = []
            for begin, end in slices(text):
                rows = [c.slice(begin, end - begin) for c in (text, *meta)]
                found = model.score(text_features(rows[0]), meta_features(*rows[1:]))
                parts.append(pa.StructArray.from_arrays([pa.array(p) for p in found], ["text", "meta", "both"]))
            yield pa.concat_arrays(parts)

    return docs.withColumn(name, judge(*_columns(docs)))


def scores(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, p_text, p_meta, p_good, kept`` for each row of ``docs``."""
    out = score(docs, model).select(
        "doc_id",
        F.col("_quality.text").alias("p_text"),
        F.col("_quality.meta").alias("p_meta"),
        F.col("_quality.both").alias("p_good"),
    )
    return out.withColumn("kept", F.col("p_good") >= threshold)


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` that are not rejected; columns are unchanged, whatever their names."""
    read = [c for c in ("text", "source", "lang", "n_chars") if c in docs.columns]
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *read)
    return score(packed, model, "_quality").where(F.col("_quality.both") >= threshold).select("_row.*")
