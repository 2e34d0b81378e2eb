"""Exact ranks and order statistics without a single-task window.

A window without partitions would pull the table into one task. The helpers
here either number rows by partition offsets or find the value at a rank by
counting, so every step is a scan with a small aggregate.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from cellsift.sources.scratch import cut_lineage

# Rank error of the percentile sketch is at most rows / accuracy.
SKETCH_ACCURACY = 10_000
# Half the width of the brackets around a rank, as shares of the rows.
NARROW, WIDE = 2.0 / SKETCH_ACCURACY, 0.02
# Values of a bracket that one task puts in order.
BRACKET_ROWS = 1_000_000
_POSITION_BITS = 33


def row_positions(df: DataFrame, name: str, order_by: Sequence[str] = ()) -> DataFrame:
    """Add the 0-based row position, in the given order or in input order.

    The numbered table is materialised once, since the partition offsets and
    the rows must see the same partitioning, also when an executor is lost.
    """
    ordered = df.orderBy(*order_by) if order_by else df
    rows = cut_lineage(ordered.withColumn("_mid", F.monotonically_increasing_id()))
    part = F.shiftright(F.col("_mid"), _POSITION_BITS)
    # One row per partition of the table: bounded by the number of tasks.
    counts = sorted(rows.groupBy(part.alias("part")).count().collect())
    offset, offsets = 0, []
    for r in counts:
        offsets.append((r["part"], offset))
        offset += r["count"]
    offset_table = df.sparkSession.createDataFrame(offsets, "_part long, _offset long")
    place = F.col("_offset") + F.col("_mid").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        rows.withColumn("_part", part)
        .join(F.broadcast(offset_table), "_part")
        .select(*df.columns, place.alias(name))
    )


def hash_order(seed: int | str, key: Column) -> Column:
    """Text whose order is a random but repeatable order of the keys."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))


def hash_thresholds(
    df: DataFrame, order: Column, ranks_of: Callable[[int], Sequence[int]]
) -> list[str | None]:
    """For each rank r the largest hash text among the first r rows in hash order.

    ``order`` must be hexadecimal text and ``ranks_of`` maps the row count to
    the wanted ranks. Rows are counted by a prefix of the hash; only prefixes
    that a wanted rank falls into are counted again by a longer one. A rank of
    0 gives None. Rows with equal hashes stay together: a group that crosses
    the rank is left out. ``hash_cuts`` tells how many of it are still wanted.
    """
    return [m.bound for m in hash_cuts(df, order, ranks_of)]


def row_order(seed: int | str, key: Column, columns: Sequence[str]) -> Column:
    """``hash_order`` of the key, then a hash of the whole row: only equal rows are equal in it."""
    row = F.to_json(F.struct(*[F.col(c) for c in columns]))
    return F.concat(hash_order(seed, key), F.md5(row))


def hash_cuts(
    df: DataFrame, order: Column, ranks_of: Callable[[int], Sequence[int]], head: Column | None = None
) -> list[_Mark]:
    """For each rank its ``bound``, and ``left`` more rows wanted of those whose hash is ``prefix``.

    ``head``, the first 32 digits of ``order``, spares hashing whole rows where they suffice.
    """
    whole = df.select(order.alias("h"))
    short = whole if head is None else df.select(head.alias("h"))
    marks: list[_Mark] = []
    done = 0
    for length in HASH_PREFIXES:
        open_prefixes = {m.prefix for m in marks if m.open}
        if done and not open_prefixes:
            break
        hashes = short if length <= HEAD_DIGITS else whole
        scope = hashes.filter(F.substring("h", 1, done).isin(*open_prefixes)) if done else hashes
        # At most 16**3 groups per open rank where many rows can be left, then few.
        groups = scope.groupBy(F.substring("h", 1, length).alias("p")).count().orderBy("p").collect()
        if not done:
            marks = [_Mark(rank) for rank in ranks_of(sum(g["count"] for g in groups))]
        for mark in marks:
            if mark.open:
                mark.advance(groups)
        done = length
    return marks


def up_to(bound: str, order: Column, head: Column) -> Column:
    """Whether a row is within a bound; whole rows are hashed only if the bound goes beyond ``head``."""
    return head <= bound[:HEAD_DIGITS] if bound.endswith("g" * HEAD_DIGITS) else order <= bound


# Digits of the hash of a key in ``row_order``.
HEAD_DIGITS = 32
# Prefix lengths of one or two md5 texts that ranks are narrowed by. The second is
# narrowed as the first: any share of the rows can agree in all of the first.
HASH_PREFIXES = (3, 6, 12, 32, 35, 38, 44, 64)


class _Mark:
    """Progress of one rank towards its hash."""

    def __init__(self, rank: int):
        self.left, self.prefix, self.bound = rank, "", None
        self.open = rank > 0

    def advance(self, groups) -> None:
        for g in groups:
            if not g["p"].startswith(self.prefix):
                continue
            if g["count"] > self.left:
                self.prefix = g["p"]
                return
            self.left -= g["count"]
            # "g" sorts after every hexadecimal digit.
            self.bound = g["p"].ljust(64, "g")
            if not self.left:
                break
        self.open = False


def exact_quantiles(df: DataFrame, wanted: Mapping[str, Sequence[float]]) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of double columns, exact at any size; null for a column without values."""
    return quantiles_and(df, wanted, [])[0]


def quantiles_and(
    df: DataFrame, wanted: Mapping[str, Sequence[float]], also: Sequence[Column]
) -> tuple[dict[str, list[float | None]], Row | None]:
    """``exact_quantiles``, and the row of further aggregates of the first scan.

    All columns and ranks go together, in three scans. The first sketches every
    column and brackets each rank from both sides, the second counts what lies
    below and in the brackets, the third reads only values inside them. A bracket
    that turns out to miss its rank is widened, one that still holds too many
    rows is sketched again, so a few more scans come with very large tables only.
    """
    columns = list(wanted)
    if not columns:
        return {}, df.agg(*also).first() if also else None
    measures = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        marks = [min(1.0, max(0.0, q + s)) for q in wanted[c] for s in (-NARROW, NARROW, -WIDE, WIDE)]
        sketch = F.percentile_approx(x, marks, SKETCH_ACCURACY)
        measures += [F.count(x).alias(f"_n{i}"), F.min(x).alias(f"_l{i}"), F.max(x).alias(f"_h{i}"), sketch.alias(f"_q{i}")]
    head = df.agg(*measures, *also).first()
    places: dict[tuple[str, float], float] = {}
    ranks: dict[tuple[str, int], _Rank] = {}
    for i, c in enumerate(columns):
        n = head[f"_n{i}"]
        for k, q in enumerate(wanted[c]):
            if not n:
                continue
            place = places[c, q] = (n - 1) * q
            narrow, wide = (tuple(head[f"_q{i}"][4 * k + a : 4 * k + a + 2]) for a in (0, 2))
            whole = (head[f"_l{i}"], head[f"_h{i}"])
            brackets = [b for b, s in ((narrow, NARROW), (wide, WIDE)) if n * s >= 4] + [whole]
            for r in {math.floor(place), math.ceil(place)}:
                ranks.setdefault((c, r), _Rank(c, r, brackets))
    _find(df, [r for r in ranks.values()])
    out: dict[str, list[float | None]] = {}
    for c in columns:
        out[c] = []
        for q in wanted[c]:
            place = places.get((c, q))
            if place is None:
                out[c].append(None)
                continue
            low, high = math.floor(place), math.ceil(place)
            a, b = ranks[c, low].value, ranks[c, high].value
            out[c].append(a if high == low else a + (place - low) * (b - a))
    return out, head


class _Rank:
    """A wanted 0-based rank of a column, the brackets to try, and its value once found."""

    def __init__(self, column: str, rank: int, brackets: list[tuple[float, float]]):
        self.column, self.rank, self.brackets = column, rank, brackets
        self.value: float | None = None
        # Values strictly inside, and the rank among them.
        self.inside: tuple[int, int] | None = None

    def counts(self) -> list[Column]:
        x, (left, right) = F.col(self.column).cast("double"), self.brackets[0]
        return [F.count_if(x < left), F.count_if(x <= left), F.count_if(x < right), F.count_if(x <= right)]

    def judge(self, below: int, to_left: int, to_right: int, up_to: int) -> None:
        left, right = self.brackets[0]
        if not below <= self.rank < up_to:
            self.brackets = self.brackets[1:]
        elif self.rank < to_left:
            self.value = left
        elif self.rank >= to_right:
            self.value = right
        else:
            self.inside = (to_right - to_left, self.rank - to_left)

    def within(self) -> Column:
        x, (left, right) = F.col(self.column).cast("double"), self.brackets[0]
        return (x > left) & (x < right)


def _find(df: DataFrame, ranks: list[_Rank]) -> None:
    while True:
        # Two ranks of a column may share a bracket; each is counted, in one scan.
        unknown = [r for r in ranks if r.value is None and r.inside is None]
        if unknown:
            counted = list(df.agg(*[c.alias(f"c{i}") for i, c in enumerate(c for r in unknown for c in r.counts())]).first())
            for k, r in enumerate(unknown):
                r.judge(*counted[4 * k : 4 * k + 4])
        large = [r for r in ranks if r.value is None and r.inside and r.inside[0] > BRACKET_ROWS]
        if large:
            _narrow(df, large)
        if not any(r.value is None and r.inside is None for r in ranks):
            break
    left = [r for r in ranks if r.value is None]
    if not left:
        return
    # Distinct values of each bracket with their counts: at most BRACKET_ROWS for each rank.
    hits = F.array_compact(
        F.array(*[F.when(r.within(), F.struct(F.lit(k).alias("k"), F.col(r.column).cast("double").alias("x"))) for k, r in enumerate(left)])
    )
    any_hit = reduce(lambda a, b: a | b, [r.within() for r in left])
    values = df.where(any_hit).select(F.inline(hits)).groupBy("k", "x").count()
    seen = F.sum("count").over(Window.partitionBy("k").orderBy("x"))
    wanted = F.element_at(F.array(*[F.lit(r.inside[1]) for r in left]), F.col("k") + 1)
    found = values.withColumn("seen", seen).where(F.col("seen") > wanted).groupBy("k").agg(F.min("x").alias("x"))
    for row in found.collect():
        left[row["k"]].value = row["x"]


def _narrow(df: DataFrame, ranks: list[_Rank]) -> None:
    """Sketch the inside of brackets that hold too many rows."""
    sketches = []
    for k, r in enumerate(ranks):
        n, rank = r.inside
        marks = [min(1.0, max(0.0, rank / n + s)) for s in (-NARROW, NARROW, -WIDE, WIDE)]
        x = F.when(r.within(), F.col(r.column).cast("double"))
        sketches += [F.percentile_approx(x, marks, SKETCH_ACCURACY).alias(f"q{k}"), F.min(x).alias(f"l{k}"), F.max(x).alias(f"h{k}")]
    row = df.agg(*sketches).first()
    for k, r in enumerate(ranks):
        q = row[f"q{k}"]
        r.brackets = [(q[0], q[1]), (q[2], q[3]), (row[f"l{k}"], row[f"h{k}"])]
        r.inside = None


def most_frequent(df: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """Most frequent non-null text of each column, the smallest of several."""
    if not columns:
        return {}
    pairs = F.explode(
        F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("v")) for i, c in enumerate(columns)])
    )
    counted = (
        df.select(pairs.alias("p"))
        .select("p.*")
        .filter(F.col("v").isNotNull())
        .groupBy("i", "v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = counted.groupBy("i").agg(F.min(F.struct((-F.col("n")).alias("neg"), F.col("v"))).alias("b"))
    found = {r["i"]: r["b"]["v"] for r in best.collect()}
    return {c: found.get(i) for i, c in enumerate(columns)}
