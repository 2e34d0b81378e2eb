"""Mixing sources to target weights, in DataFrame operations only.

Source token shares are raised to an exponent a from 0 (uniform) to 1 (as they
are). The least a is taken whose weights keep an entropy target and a limit on
repetition, found by bisection on a grid of 2^-20. Each source then has a token
quota: whole passes over its documents, and a last pass over a prefix of a
permutation. The permutation is the order of a hash; its leading bits are
blocks. Block totals find the block in which the quota ends, and only that block
is looked at row by row, so no source is ever sorted or held in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellsift.sources.scratch import cut_lineage

GRID_BITS = 20
#: Rows of a block, on average.
BLOCK_ROWS = 4096
HASH_BITS = 60
SEED = 11

#: Exponents tried at once: four halvings of the bracket in one job.
_FAN = 16


def token_count(text: str = "text") -> F.Column:
    """Words of a text; none for a null."""
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("long")


def numbered(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs`` with ``_src`` (the source, nulls apart), ``_tokens`` and ``_h`` (its place in the permutation).

    The hash covers ``doc_id`` and text, so only rows that repeat both share a place.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text))
    place = F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")
    source = F.col("source").cast("string")
    return docs.select(
        "*",
        F.when(source.isNull(), "n").otherwise(F.concat(F.lit("s"), source)).alias("_src"),
        token_count().alias("_tokens"),
        place.alias("_h"),
    )


def exponent(
    sources: DataFrame, *, entropy_share: float | None, max_repeats: float | None, cover: bool
) -> float:
    """The least exponent on the grid within both limits; ``sources`` has ``tokens``.

    ``entropy_share``: entropy at most that share of the way from the sources' own
    entropy to that of equal weights. ``max_repeats``: passes over any source at
    most that many. With ``cover`` the budget lets every source have one pass at
    least; otherwise it is the sum of the tokens. Only sums reach the driver.
    """
    rows = sources.where("tokens > 0").select(F.col("tokens").cast("double").alias("t"))
    total = rows.agg(F.sum("t").alias("s"), F.count("*").alias("k"), F.max("t").alias("most"), F.min("t").alias("least")).first()
    if not total["k"] or total["k"] == 1:
        return 1.0
    p = F.col("t") / total["s"]
    own = rows.agg(F.sum(-p * F.log(p)).alias("h")).first()["h"]
    top = F.log(F.lit(float(total["k"])))
    target = None if entropy_share is None else F.lit(own) + entropy_share * (top - own) + 1e-12
    low, high = -1, 1 << GRID_BITS
    while high - low > 1:
        step = max(1, (high - low) // _FAN)
        tried = F.explode(F.array(*(F.lit(m) for m in range(low + step, high, step))))
        a = F.col("m") / float(1 << GRID_BITS)
        x = F.pow(F.col("t") / total["most"], a)
        found = rows.select("t", tried.alias("m")).select("m", "t", x.alias("x")).groupBy("m")
        found = found.agg(F.sum("x").alias("z"), F.sum(F.col("x") * F.log("x")).alias("xl"))
        entropy = F.log("z") - F.col("xl") / F.col("z")
        good = F.lit(True)
        if target is not None:
            good = good & (entropy <= target)
        if max_repeats is not None:
            ratio = F.pow(F.lit(total["most"] / total["least"]), 1 - a)
            per_token = 1.0 if cover else F.lit(total["s"] / total["most"]) / F.col("z")
            good = good & (ratio * per_token <= max_repeats + 1e-9)
        fits = [r["m"] for r in found.where(good).select("m").collect()]
        high = min([high, *fits])
        low = max([low, *(m for m in range(low + step, high, step))])
    return high / (1 << GRID_BITS)


def plan(
    rows: DataFrame,
    kept: list[str],
    *,
    entropy_share: float | None = 0.5,
    max_repeats: float | None = 4.0,
    cover: bool = False,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Per ``_src`` of ``rows`` (see ``numbered``): weight, whole passes, and where the last one ends.

    A source without tokens has one pass, which costs nothing.
    """
    sources = rows.groupBy("_src").agg(F.sum("_tokens").alias("tokens"), F.count("*").alias("n"))
    sources = cut_lineage(sources, "sources", kept)
    a = exponent(sources, entropy_share=entropy_share, max_repeats=max_repeats, cover=cover)
    sums = sources.agg(F.sum("tokens").alias("s"), F.max("tokens").alias("most"), F.sum(F.pow(F.col("tokens").cast("double"), F.lit(a))).alias("z"))
    # pow(0, 0) is 1: with an exponent of 0 sources without tokens must not count.
    if a == 0:
        sums = sources.where("tokens > 0").agg(F.sum("tokens").alias("s"), F.max("tokens").alias("most"), F.count("*").cast("double").alias("z"))
    s, most, z = sums.first() or (0, 0, 0)
    weight = F.when(F.col("tokens") > 0, F.pow(F.col("tokens").cast("double"), F.lit(a)) / F.lit(z or 1.0)).otherwise(0.0)
    budget = float(s or 0) if not cover else (float(most or 0) ** (1 - a)) * (z or 0)
    quota = F.round(weight * budget).cast("long")
    sources = sources.select("_src", "tokens", "n", weight.alias("weight"), quota.alias("quota"))
    sources = sources.withColumn("passes", F.when(F.col("tokens") > 0, F.floor(F.col("quota") / F.col("tokens"))).otherwise(1).cast("int"))
    sources = sources.withColumn("rest", F.when(F.col("tokens") > 0, F.col("quota") - F.col("passes") * F.col("tokens")).otherwise(0))
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / block_rows))).cast("int")
    sources = cut_lineage(sources.withColumn("bits", bits), "quotas", kept)

    blocked = rows.select("_src", "_h", "_tokens").join(sources.select("_src", "bits", "rest"), "_src")
    block = F.expr(f"shiftright(_h, {HASH_BITS} - bits)")
    blocked = blocked.withColumn("block", block)
    totals = blocked.groupBy("_src", "block").agg(F.sum("_tokens").alias("t"), F.first("rest").alias("rest"))
    running = Window.partitionBy("_src").orderBy("block")
    totals = totals.withColumn("upto", F.sum("t").over(running)).where("upto > rest")
    ends = totals.groupBy("_src").agg(F.min(F.struct("block", (F.col("upto") - F.col("t")).alias("before"))).alias("e"))
    ends = cut_lineage(ends.select("_src", "e.block", "e.before"), "ends", kept)
    # Rows that share a place go together, so a place repeated often is one row here.
    last = blocked.join(ends, ["_src", "block"]).groupBy("_src", "_h")
    last = last.agg(F.sum("_tokens").alias("t"), F.first("rest").alias("rest"), F.first("before").alias("before"))
    last = last.withColumn("upto", F.col("before") + F.sum("t").over(Window.partitionBy("_src").orderBy("_h")))
    cuts = last.where("upto > rest").groupBy("_src").agg(F.min("_h").alias("cut"))
    out = sources.join(cuts, "_src", "left").withColumn("cut", F.coalesce("cut", F.lit(1 << HASH_BITS)))
    return cut_lineage(out.select("_src", "weight", "passes", "bits", "cut"), "plan", kept)


def repeated(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Each row as often as planned, with ``_epoch`` from 0, ``_block`` and ``_weight``."""
    times = F.col("passes") + F.when(F.col("_h") < F.col("cut"), 1).otherwise(0)
    # Without a cut the last pass is whole, so there is none beyond the passes.
    times = F.when((F.col("cut") == F.lit(1 << HASH_BITS)), F.col("passes")).otherwise(times)
    out = rows.join(plans, "_src").withColumn("_times", times).where("_times > 0")
    out = out.withColumn("_epoch", F.explode(F.sequence(F.lit(0), F.col("_times") - 1)))
    out = out.withColumn("_block", F.expr(f"shiftright(_h, {HASH_BITS} - bits)"))
    return out.withColumn("_weight", F.col("weight")).drop("weight", "passes", "bits", "cut", "_times")


def order_key(seed: int = SEED) -> F.Column:
    """Sorts (epoch, block) of all sources among each other, epochs one after another."""
    name = F.concat_ws(":", F.lit(str(seed)), F.col("_epoch"), F.col("_src"), F.col("_block"))
    return F.concat_ws("-", F.lpad(F.col("_epoch").cast("string"), 6, "0"), F.substring(F.md5(name), 1, 16))


def mixed(docs: DataFrame, kept: list[str], **options) -> DataFrame:
    """One row per copy: ``doc_id, source, n_tokens, epoch, block, weight, order_key``.

    A null ``source`` is a source of its own; null ids and repeated rows are drawn
    like others, rows that repeat id and text together. Other columns are
    ignored. Without tokens each row is there once.
    """
    rows = numbered(docs.select("doc_id", "source", "text")).select("doc_id", "source", "_src", "_tokens", "_h")
    rows = cut_lineage(rows, "numbered", kept)
    out = repeated(rows, plan(rows, kept, **options))
    return out.select(
        "doc_id",
        "source",
        F.col("_tokens").alias("n_tokens"),
        F.col("_epoch").alias("epoch"),
        F.col("_block").alias("block"),
        F.round("_weight", 9).alias("weight"),
        order_key().alias("order_key"),
    )


def remix(docs: DataFrame, kept: list[str], **options) -> DataFrame:
    """``docs`` with each row as often as planned; columns are unchanged."""
    small = numbered(docs.select("doc_id", "source", "text")).select("_src", "_tokens", "_h")
    plans = plan(cut_lineage(small, "numbered", kept), kept, **options)
    # All columns travel in one, so that no name can clash.
    packed = docs.select(F.struct("*").alias("_doc"), "doc_id", "source", "text")
    return repeated(numbered(packed), plans).select("_doc.*")
