"""CSV records that do not fit their columns, in a table of their own."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellsift.operators.normalize import na_tokens_to_null
from cellsift.sources.files import CSV_OPTIONS
from cellsift.sources.scratch import cut_lineage, drop_written


@dataclass
class Ingest:
    """Rows that fit and records that do not. Call ``close`` when both have been used.

    ``rejected`` has ``file``, ``block_start`` (byte where the block that Spark read
    begins), ``record_number`` (place in the block, from 1, without header and blank
    lines), ``record`` (the text), ``n_cells`` and ``reason``.
    """

    rows: DataFrame
    rejected: DataFrame
    _kept: list[str] = field(default_factory=list)

    def close(self) -> None:
        drop_written(self.rows.sparkSession, self._kept)


def _free_name(name: str, taken) -> str:
    while name in taken:
        name = "_" + name
    return name


def _reason(record: Column, columns: int, separator: str, quote: str) -> tuple[Column, Column]:
    # A doubled quote ends one quoted part and begins the next, so both go.
    bare = F.regexp_replace(record, f"\\Q{quote}\\E[^\\Q{quote}\\E]*+\\Q{quote}\\E", "")
    count = F.size(F.split(bare, f"\\Q{separator}\\E", -1))
    reason = (
        F.when(F.contains(bare, F.lit(quote)), "open quote").when(count < columns, "too few cells")
        .when(count > columns, "too many cells").otherwise("cell of another type")
    )
    return count, reason


def read_with_quarantine(
    spark: SparkSession, path: str, schema: T.StructType, options: Mapping[str, str] | None = None
) -> Ingest:
    """Read CSV files; every record that is not blank ends up in one of two tables.

    A record is rejected if its number of cells is not that of the schema or if a
    cell does not have its column's type. The files are parsed once: the parsed
    records are written to the scratch folder with the place they were read at,
    and both tables are filters of these. Texts for "no value" become null, as
    in ``FileSource``. An empty folder gives two empty tables.
    """
    settings = {**CSV_OPTIONS, **(options or {})}
    names = schema.fieldNames()
    raw, file, block, place = (_free_name(n, names) for n in ("_record", "_file", "_block", "_place"))
    # Without pruning, a record is judged by all its cells, whichever are asked for.
    settings |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": raw, "columnPruning": "false"}
    reader = spark.read.schema(T.StructType([*schema.fields, T.StructField(raw, T.StringType())])).options(**settings)
    kept: list[str] = []
    parsed = cut_lineage(
        reader.csv(path).select(
            "*", F.col("_metadata.file_path").alias(file), F.col("_metadata.file_block_start").alias(block),
            F.monotonically_increasing_id().alias(place),
        ),
        "csv_records", kept,
    )
    rows = na_tokens_to_null(parsed.filter(F.col(raw).isNull()).select(*[F.col(f"`{n}`") for n in names]))
    bad = parsed.filter(F.col(raw).isNotNull())
    # A block is read by one task in order, so places in it follow one another.
    first = parsed.groupBy(file, block).agg(F.min(place).alias("_first"))
    separator = settings.get("sep", settings.get("delimiter", ","))
    count, reason = _reason(F.col(raw), len(names), separator, settings["quote"])
    rejected = bad.select(file, block, place, raw).join(first, [file, block]).select(
        F.col(file).alias("file"), F.col(block).alias("block_start"),
        (F.col(place) - F.col("_first") + 1).alias("record_number"),
        F.col(raw).alias("record"), count.alias("n_cells"), reason.alias("reason"),
    )
    return Ingest(rows, rejected, kept)
