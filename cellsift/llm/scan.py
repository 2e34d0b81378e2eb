"""Running sums over sorted rows, spread by ranges of the order; one group may hold any share of the rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellsift.sources.scratch import cut_lineage


def _scan(group: list[str], sums: list[str], lag: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums and the former row's value, for each group within one range."""
        part, at = TaskContext.get().partitionId(), 0
        last: tuple | None = None
        total = np.zeros(len(sums), dtype=np.int64)
        before = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = np.column_stack([batch.column(batch.schema.get_field_index(c)).to_numpy() for c in group])
            fresh = np.ones(n, dtype=bool)
            fresh[1:] = (keys[1:] != keys[:-1]).any(axis=1)
            fresh[0] = last is None or tuple(keys[0]) != last
            begin = np.maximum.accumulate(np.where(fresh, np.arange(n), -1))
            columns = list(batch.columns)
            for k, c in enumerate(sums):
                place = batch.schema.get_field_index(c)
                run_ = np.concatenate([[0], np.cumsum(batch.column(place).to_numpy(), dtype=np.int64)])
                run_ = run_[1:] - np.where(begin >= 0, run_[np.maximum(begin, 0)], -total[k])
                total[k], columns[place] = run_[-1], pa.array(run_)
            if lag:
                value = batch.column(batch.schema.get_field_index(lag)).to_pylist()
                former = [None if f else v for f, v in zip(fresh.tolist(), [before, *value[:-1]])]
                before = value[-1]
                columns.append(pa.array(former, batch.schema.field(lag).type))
            columns += [pa.array(np.full(n, part)), pa.array(np.arange(at, at + n))]
            at, last = at + n, tuple(keys[-1])
            names = [*batch.schema.names, *(["_former"] if lag else []), "_part", "_at"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def running(
    rows: DataFrame, group: list[str], order: list[Column], sums: list[str], kept: list[str], lag: str | None = None
) -> DataFrame:
    """``rows`` with each column of ``sums`` replaced by its running sum within its group.

    ``group`` and ``sums`` are long columns without nulls; ``order`` sorts the rows
    of a group. ``lag`` adds ``_former``: that column's value in the row before, null
    in a group's first row. Columns of ``order`` that are only there to sort by may
    be dropped by the caller's later steps. Each task scans one range; one row for
    each range goes through the driver to tell the next ranges where to start.
    """
    by = [F.col(c) for c in group]
    ranges = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sorted_ = rows.repartitionByRange(ranges, *by, *order).sortWithinPartitions(*by, *order)
    fields = [f for f in rows.schema.fields if f.name in {*group, *sums} or f.name in _kept_columns(rows)]
    slim = sorted_.select(*[f"`{f.name}`" for f in fields])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    schema += (f", _former {rows.schema[lag].dataType.simpleString()}" if lag else "") + ", _part long, _at long"
    parts = cut_lineage(slim.mapInArrow(_scan(group, sums, lag), schema), "ranges", kept)

    ends = F.struct("_at", *group, *sums, *([lag] if lag else []))
    heads = parts.groupBy("_part").agg(F.min(F.struct("_at", *group)).alias("first"), F.max(ends).alias("last"))
    starts, former = [], None
    for r in sorted(heads.collect(), key=lambda r: r["_part"]):
        key, tail = tuple(r["first"][c] for c in group), tuple(r["last"][c] for c in group)
        carried = [0] * len(sums)
        if former and former[0] == key:
            carried = former[1]
            starts.append((r["_part"], *key, *carried, *([former[2]] if lag else [])))
        own = [r["last"][c] for c in sums]
        # A range of one group only hands on what it was handed.
        same = key == tail
        former = (tail, [a + b for a, b in zip(own, carried)] if same else own, r["last"][lag] if lag else None)
    kinds = [f"`{c}` long" for c in group] + [f"_s{k} long" for k in range(len(sums))]
    kinds += [f"_lag {rows.schema[lag].dataType.simpleString()}"] if lag else []
    carry = rows.sparkSession.createDataFrame(starts, ", ".join(["_part long", *kinds]))
    out = parts.join(F.broadcast(carry), ["_part", *group], "left")
    out = out.withColumns({c: F.col(f"`{c}`") + F.coalesce(f"_s{k}", F.lit(0)) for k, c in enumerate(sums)})
    if lag:
        out = out.withColumn("_former", F.when(F.col("_at") == 0, F.col("_lag")).otherwise(F.col("_former")))
    return out.select(*[f"`{f.name}`" for f in fields], *(["_former"] if lag else []))


def _kept_columns(rows: DataFrame) -> set[str]:
    """Columns whose names begin with an underscore only sort."""
    return {c for c in rows.columns if not c.startswith("_")}
