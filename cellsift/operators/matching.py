"""Closest entry of a long list for each of many texts: a similarity join by q-grams.

The similarity is ``1 - edits / longer length``, rounded to 4 places. Two texts
with few edits between them share most of their bigrams, so among the rarest
bigrams of each, as many as an edit can destroy and one more, they share at least
one. The first that survives stands at nearly the same place in both, so only these are
indexed and joined, within the lengths and places that the edits allow. Texts that are very close to an entry are
settled first, by a short index; only the rest goes on to wider ones.

A wide index has little to choose by, and a pair meets at each bigram that it shares.
Unless that makes far fewer meetings than there are pairs of lengths near enough, short texts
meet entries by length instead, each pair once; both are counted beforehand. Bits that
stand for the characters of a text rule most of these pairs out, the edits of the others
are counted for many pairs at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellsift.functions.similarity import levenshtein_ratio
from cellsift.operators.keyed import dealt
from cellsift.sources.scratch import cut_lineage

# Similarities that the search goes down through before the wanted one.
BANDS = (0.9, 0.8)
# Half a unit of the last place that similarities are rounded to.
_ROUNDING = 0.00005
_EDGE = "\x00"
# Texts up to this length fit the words of bits that edits are counted with.
SHORT = 64
# Most texts and entries that meet in a group by length, and pairs that are counted together.
GROUP_TEXTS, GROUP_ENTRIES = 8192, 4096
# A meeting at a bigram is shuffled and counted by itself: it costs about as much as this many by length.
GRAM_COST = 16
PAIRS = 16_384


def _edits(length: Column, least: float) -> Column:
    """Most edits between texts of which the longer has this length."""
    return F.floor(length * (1 - least + _ROUNDING) + 1e-9)


def _grams(rows: DataFrame) -> DataFrame:
    """``text, size, gram, place`` of each bigram, with an edge before and after the text."""
    rows = rows.withColumns({"size": F.length("text"), "_padded": F.concat(F.lit(_EDGE), "text", F.lit(_EDGE))})
    rows = rows.select("text", "size", "_padded", F.explode(F.sequence(F.lit(1), F.col("size") + 1)).alias("place"))
    return rows.select("text", "size", F.substring(F.col("_padded"), F.col("place"), F.lit(2)).alias("gram"), "place")


def _letters(rows: DataFrame) -> DataFrame:
    """``low, high``: 128 bits, one for the first, second, third ... occurrence of each character.

    An edit takes away one occurrence at most and adds one at most. Occurrences may
    share a bit, which only makes texts look more alike.
    """

    def add(seen: Column, c: Column) -> Column:
        n = F.when(c == seen["c"], seen["n"] + 1).otherwise(0)
        bit = F.pmod(F.xxhash64(c, n), F.lit(128))
        one = lambda at: F.call_function("shiftleft", F.lit(1).cast("long"), at.cast("int"))
        low = F.when(bit < 64, seen["low"].bitwiseOR(one(bit))).otherwise(seen["low"])
        high = F.when(bit >= 64, seen["high"].bitwiseOR(one(bit - 64))).otherwise(seen["high"])
        return F.struct(c.alias("c"), n.alias("n"), low.alias("low"), high.alias("high"))

    none = F.struct(F.lit("").alias("c"), F.lit(0).alias("n"), *[F.lit(0).cast("long").alias(x) for x in ("low", "high")])
    bits = F.aggregate(F.array_sort(F.split("text", "")), none, add)
    return rows.withColumn("_bits", bits).select("*", "_bits.low", "_bits.high").drop("_bits")


def _ranked(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """``text, size, grams, low, high``: the bigrams of each text, the rarest of the list first."""
    ranked = _grams(rows).join(counts, "gram", "left").groupBy("text", "size").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram", "place"))).alias("grams")
    )
    return _letters(ranked)


def _indexed(ranked: DataFrame, least: float) -> DataFrame:
    """As many of the first bigrams of each text as the index needs for this similarity."""
    wanted = F.size("grams")
    if least >= 0.5:
        wanted = (F.floor(2 * (1 - least + _ROUNDING) * F.col("size") + 1e-9) + 1).cast("int")
    return ranked.select("text", "size", "low", "high", F.inline(F.slice("grams", F.lit(1), wanted))).drop("n")


def meetings(many: DataFrame, few: DataFrame, key: str) -> int:
    """Pairs of rows that share a key."""
    one, two = (x.groupBy(key).agg(F.count(F.lit(1)).alias(n)) for x, n in ((many, "_n"), (few, "_m")))
    return one.join(two, key).agg(F.sum(F.col("_n") * F.col("_m"))).first()[0] or 0


def _close(texts: DataFrame, entries: DataFrame, least: float) -> DataFrame:
    """Best entry of each text that has one of this similarity or more."""
    if least < 0.1:
        return _best(_by_grams(texts, entries, least), least)
    short = texts.where(F.col("size") <= SHORT)
    mine, theirs = _by_length(short, entries, least)
    if meetings(mine, theirs, "_size") > GRAM_COST * meetings(_indexed(short, least), _indexed(entries, least), "gram"):
        return _best(_by_grams(texts, entries, least), least)
    long = _by_grams(texts.where(F.col("size") > SHORT), entries, least)
    return _best(long.unionByName(_counted(mine, theirs, least)), least)


def _best(met: DataFrame, least: float) -> DataFrame:
    best = F.max(F.struct("ratio", "match"))
    return met.where(F.col("ratio") >= least).groupBy("text").agg(best.alias("best"))


def _by_grams(texts: DataFrame, entries: DataFrame, least: float) -> DataFrame:
    """``text, match, ratio`` of pairs that share a bigram of the index at nearly the same place."""
    theirs = _indexed(entries, least).select(
        F.col("text").alias("match"), F.col("size").alias("_size"), "gram", F.col("place").alias("_place")
    )
    # Comparing costs time, not bytes, so few bytes must not mean few tasks.
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mine, theirs = (x.repartition(tasks, "gram", "_deal") for x in dealt(_indexed(texts, least), theirs, "gram", "text"))
    edits = _edits(F.greatest("size", "_size"), least)
    near = (F.abs(F.col("size") - F.col("_size")) <= edits) & (F.abs(F.col("place") - F.col("_place")) <= edits)
    met = mine.join(theirs, ["gram", "_deal"]).where(near).select("text", "match")
    met = met.repartition(tasks, "text").distinct()
    return met.withColumn("ratio", F.round(levenshtein_ratio(F.col("text"), F.col("match")), 4))


def _by_length(texts: DataFrame, entries: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """Texts with each length ``_size`` that an entry may have, and the entries."""
    theirs = entries.select(F.col("text").alias("match"), F.col("size").alias("_size"), "low", "high")
    allowed = _edits(F.greatest("size", "_size"), least).cast("int")
    sizes = entries.select(F.col("size").alias("_size")).distinct()
    # One row for each pair of lengths.
    lengths = texts.select("size").distinct().join(sizes, F.abs(F.col("size") - F.col("_size")) <= allowed)
    mine = texts.select("text", "size", "low", "high").join(F.broadcast(lengths.withColumn("allowed", allowed)), "size")
    return mine, theirs


def _counted(mine: DataFrame, theirs: DataFrame, least: float) -> DataFrame:
    """``text, match, ratio``: the closest entry of each length for each text, the last in order of several."""
    per = lambda rows, most, name: rows.groupBy("_size").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias(name))
    # One row for each length.
    plan = F.broadcast(per(mine, GROUP_TEXTS, "_chunks").join(per(theirs, GROUP_ENTRIES, "_blocks"), "_size"))
    part = lambda by, parts: F.pmod(F.xxhash64(by), F.col(parts)).cast("int")
    each = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    mine = mine.join(plan, "_size").withColumn("_chunk", part("text", "_chunks")).withColumn("_block", each("_blocks"))
    theirs = theirs.join(plan, "_size").withColumn("_block", part("match", "_blocks")).withColumn("_chunk", each("_chunks"))
    group = ["_size", "_chunk", "_block"]
    tasks = int(mine.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = mine.select(*group, "text", "size", "low", "high", "allowed").repartition(tasks, *group)
    right = theirs.select(*group, "match", "low", "high").repartition(tasks, *group)
    kind = "text string, size int, _size int, match string, edits int"
    met = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(_closest, kind)
    ratio = F.round(1 - F.col("edits") / F.greatest("size", "_size"), 4)
    return met.select("text", "match", ratio.alias("ratio"))


def _points(texts: list[str]) -> list[np.ndarray]:
    return [np.frombuffer(t.encode("utf-32-le"), dtype=np.uint32) for t in texts]


def _closest(texts: pa.Table, entries: pa.Table) -> pa.Table:
    """The closest entry of each text within the edits allowed; all entries have one length."""
    out: list[tuple] = []
    if texts.num_rows and entries.num_rows:
        entries = entries.sort_by("match")
        names, length = entries["match"].to_pylist(), entries["_size"][0].as_py()
        alphabet, codes = np.unique(np.concatenate(_points(names)), return_inverse=True)
        codes = np.ascontiguousarray(codes.reshape(-1, length).T)
        theirs = [entries[c].to_numpy().view(np.uint64) for c in ("low", "high")]
        step = max(1, 1_000_000 // len(names))
        for begin in range(0, texts.num_rows, step):
            some = texts.slice(begin, step)
            mine = [some[c].to_numpy().view(np.uint64)[:, None] for c in ("low", "high")]
            allowed = some["allowed"].to_numpy()
            changed = [sum(np.bitwise_count(a & ~b) for a, b in zip(x, y)) for x, y in ((mine, theirs), (theirs, mine))]
            text, entry = np.nonzero(np.maximum(*changed) <= allowed[:, None])
            words = some["text"].to_pylist()
            edits = count_edits(words, text, alphabet, codes, entry)
            good = edits <= allowed[text]
            text, entry, edits = text[good], entry[good], edits[good]
            # The fewest edits first, of equal ones the last entry.
            order = np.lexsort((-entry, edits, text))
            first = order[np.unique(text[order], return_index=True)[1]]
            sizes = some["size"].to_numpy()
            out += [(words[t], int(sizes[t]), length, names[e], int(d)) for t, e, d in zip(text[first], entry[first], edits[first])]
    kinds = {"text": pa.string(), "size": pa.int32(), "_size": pa.int32(), "match": pa.string(), "edits": pa.int32()}
    columns = list(zip(*out)) or [()] * len(kinds)
    return pa.table({name: pa.array(c, kind) for (name, kind), c in zip(kinds.items(), columns)})


def count_edits(
    texts: list[str], text: np.ndarray, alphabet: np.ndarray, codes: np.ndarray, entry: np.ndarray
) -> np.ndarray:
    """Edits between pairs of texts (``SHORT`` at most) and entries, after Myers and Hyyro.

    ``codes`` has a row for each place and a column for each entry. The differences
    down a column of the table of edits are bits of a word, one word for each pair.
    """
    one = np.uint64(1)
    at = np.zeros((len(texts), len(alphabet) + 1), dtype=np.uint64)
    for row, points in zip(at, _points(texts)):
        place = np.minimum(np.searchsorted(alphabet, points), len(alphabet) - 1)
        place = np.where(alphabet[place] == points, place, len(alphabet))
        np.bitwise_or.at(row, place, one << np.arange(len(points), dtype=np.uint64))
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    out = np.empty(len(text), dtype=np.int64)
    for begin in range(0, len(text), PAIRS):
        t, e = text[begin : begin + PAIRS], entry[begin : begin + PAIRS]
        last = (sizes[t] - 1).astype(np.uint64)
        score = sizes[t]
        more, less = np.full(len(t), ~np.uint64(0)), np.zeros(len(t), dtype=np.uint64)
        for column in codes:
            same = at[t, column[e]]
            diagonal = (((same & more) + more) ^ more) | same | less
            up, down = less | ~(diagonal | more), diagonal & more
            score = score + ((up >> last) & one).astype(np.int64) - ((down >> last) & one).astype(np.int64)
            up, down = (up << one) | one, down << one
            more, less = down | ~(diagonal | up), up & diagonal
        out[begin : begin + PAIRS] = score
    return out


def best_matches(
    texts: DataFrame, entries: DataFrame, cutoff: float, kept: list[str] | None = None
) -> DataFrame:
    """``text, match, ratio`` for each distinct text that has an entry of similarity ``cutoff`` or more.

    ``texts`` and ``entries`` have one text column each. Of several entries that are
    equally close the last in order wins. Null and empty texts match nothing. No
    text meets every entry, and no bigram's rows are held by one task.
    """
    kept = [] if kept is None else kept
    left = texts.select(F.col(texts.columns[0]).cast("string").alias("text")).where("length(text) > 0").distinct()
    entries = entries.select(F.col(entries.columns[0]).cast("string").alias("text")).where("length(text) > 0").distinct()
    counts = _grams(entries).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    counts = cut_lineage(counts, "gram-counts", kept)
    entries = cut_lineage(_ranked(entries, counts), "entry-grams", kept)
    left = cut_lineage(_ranked(left, counts), "text-grams", kept)
    found: list[DataFrame] = []
    for least in [b for b in BANDS if b > cutoff] + [cutoff]:
        some = _close(left, entries, least)
        found.append(cut_lineage(some, "matches", kept))
        # Whoever has a match here has all of this similarity, the best among them.
        left = left.join(found[-1].select("text"), "text", "left_anti")
    out = found[0]
    for some in found[1:]:
        out = out.unionByName(some)
    return out.select("text", "best.match", "best.ratio")
