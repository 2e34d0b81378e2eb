"""List ranking: the place of each element of a linked list, and sums of what stands before it.

Elements are (a, b) and name their successor. A task takes a block of elements that
are near one another in (a, b), joins chains of successors inside it, and keeps the
head of each chain with the chain's weights. Heads are ranked in the same way, and
the members then add their place in the chain to their head's. A successor outside
of a block is always a head in its own. Where neighbours in the list seldom share a
block, heads with coin 1 also take in successors with coin 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellsift.sources.scratch import cut_lineage

#: Elements of a block.
BLOCK_ROWS = 1 << 16
#: A level that leaves more than this share of its elements is followed by one with coins.
SLOW = 0.7


def _chains(table: pa.Table, weights: list[str]) -> pa.RecordBatch:
    """Head of each element's chain within the block, its offset, and the chain's end for heads."""
    a, b = table.column("a").to_numpy(), table.column("b").to_numpy()
    n = len(a)
    after = [table.column(c).combine_chunks() for c in ("sa", "sb")]
    open_ = after[0].is_valid().to_numpy(zero_copy_only=False)
    sa, sb = (x.fill_null(0).to_numpy(zero_copy_only=False) for x in after)
    where = pd.MultiIndex.from_arrays([a, b])
    nxt = where.get_indexer(pd.MultiIndex.from_arrays([sa, sb]))
    nxt[~open_] = -1
    own = np.column_stack([table.column(c).to_numpy() for c in weights])
    inside = np.flatnonzero(nxt >= 0)
    head = np.arange(n)
    offset = np.zeros_like(own)
    head[nxt[inside]] = inside
    offset[nxt[inside]] = own[inside]
    is_head = head == np.arange(n)
    for _ in range(64):
        further = head[head]
        if np.array_equal(further, head):
            break
        offset += offset[head]
        head = further
    tail = np.flatnonzero(nxt < 0)
    total = np.zeros_like(own)
    total[head[tail]] = offset[tail] + own[tail]
    last = np.zeros(n, dtype=np.int64)
    last[head[tail]] = tail
    gone = ~(is_head & open_[last])
    columns = {"a": a, "b": b, "ha": a[head], "hb": b[head], "head": is_head}
    columns |= {f"o_{c}": offset[:, k] for k, c in enumerate(weights)}
    columns |= {"sa": pa.array(sa[last], mask=gone), "sb": pa.array(sb[last], mask=gone)}
    columns |= {c: total[:, k] for k, c in enumerate(weights)}
    return pa.RecordBatch.from_pydict(columns)


def _schema(weights: list[str]) -> str:
    offsets, totals = (", ".join(f"{p}{c} long" for c in weights) for p in ("o_", ""))
    return f"a long, b long, ha long, hb long, head boolean, {offsets}, sa long, sb long, {totals}"


def _block(weights: list[str], block_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, block_rows - count)
                batch = batch.slice(part.num_rows)
                held.append(part)
                count += part.num_rows
                if count == block_rows:
                    yield _chains(pa.Table.from_batches(held), weights)
                    held, count = [], 0
        if held:
            yield _chains(pa.Table.from_batches(held), weights)

    return run


def _coin(a: str, b: str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), a, b).bitwiseAND(1)


def _splice(rows: DataFrame, weights: list[str], seed: int) -> DataFrame:
    """Elements with coin 1 take in their successor if it has coin 0."""
    mine, next_ = _coin("a", "b", seed), _coin("sa", "sb", seed)
    takes = (mine == 1) & F.col("sa").isNotNull() & (next_ == 0)
    names = ["a", "b", *weights]
    taker = rows.where(takes).select(*(F.col(c).alias(f"t_{c}") for c in names), F.col("sa").alias("a"), F.col("sb").alias("b"))
    zero = rows.where(mine == 0).join(taker, ["a", "b"], "left")
    nothing = F.lit(0).cast("long")

    def row(a, b, ha, hb, head, offsets, totals) -> Column:
        cells = {"a": F.col(a), "b": F.col(b), "ha": F.col(ha), "hb": F.col(hb), "head": F.lit(head)}
        cells |= {f"o_{c}": x for c, x in zip(weights, offsets)}
        cells |= {"sa": F.col("sa"), "sb": F.col("sb")} | dict(zip(weights, totals))
        return F.struct(*(x.alias(c) for c, x in cells.items()))

    own = [F.col(c) for c in weights]
    none = [nothing for _ in weights]
    both = [F.col(c) + F.col(f"t_{c}") for c in weights]
    alone = row("a", "b", "a", "b", True, none, own)
    taken = row("a", "b", "t_a", "t_b", False, [F.col(f"t_{c}") for c in weights], own)
    grown = row("t_a", "t_b", "t_a", "t_b", True, none, both)
    joined = zero.select(F.explode(F.when(F.col("t_a").isNull(), F.array(alone)).otherwise(F.array(taken, grown))).alias("r"))
    return joined.union(rows.where((mine == 1) & ~takes).select(alone.alias("r"))).select("r.*")


def ranked(rows: DataFrame, weights: list[str], kept: list[str], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``a, b`` and for each of ``weights`` its sum over all elements before this one.

    ``rows`` has long columns ``a, b``, unique together, ``sa, sb`` of the successor
    (null at the end), and ``weights``, which must be at least one. Several lists are
    ranked each for itself. Work falls from level to level; the last level is one
    block, of ``block_rows`` elements at most.
    """
    columns = ["a", "b", "sa", "sb", *weights]
    rows = rows.select(*columns)
    levels: list[DataFrame] = []
    left, seed = rows.count(), 0
    while True:
        blocks = max(1, ceil(left / block_rows))
        placed = rows.repartitionByRange(blocks, "a", "b").sortWithinPartitions("a", "b") if blocks > 1 else rows.repartition(1)
        levels.append(cut_lineage(placed.mapInArrow(_block(weights, block_rows), _schema(weights)), "chains", kept))
        if blocks == 1:
            break
        rows = levels[-1].where("head").select(*columns)
        before, left = left, rows.count()
        if left > SLOW * before:
            seed += 1
            levels.append(cut_lineage(_splice(rows, weights, seed), "spliced", kept))
            rows = levels[-1].where("head").select(*columns)
            left = rows.count()
    found = levels[-1].select("a", "b", *(F.col(f"o_{c}").alias(c) for c in weights))
    for level in reversed(levels[:-1]):
        heads = found.select(F.col("a").alias("ha"), F.col("b").alias("hb"), *weights)
        members = level.select("a", "b", "ha", "hb", *(f"o_{c}" for c in weights))
        found = members.join(heads, ["ha", "hb"]).select(
            "a", "b", *((F.col(f"o_{c}") + F.col(c)).alias(c) for c in weights)
        )
    return found
