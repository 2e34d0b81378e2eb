"""File sources and sinks over Spark's readers and writers."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cellsift.operators.normalize import na_tokens_to_null

FORMATS = ("csv", "parquet", "json", "orc")
# Doubled quotes escape quotes, as in files written by spreadsheet tools.
# Blanks around a cell belong to it, also on writing.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


class TableSource(Protocol):
    def read(self, spark: SparkSession) -> DataFrame: ...


class TableSink(Protocol):
    def write(self, df: DataFrame, name: str, small: bool = False) -> str: ...


@dataclass(frozen=True)
class FileSource:
    """A table in files. CSV cells come as text with "no value" texts as null."""

    path: str
    format: str = "csv"
    options: Mapping[str, str] = field(default_factory=dict)
    schema: T.StructType | None = None

    def read(self, spark: SparkSession) -> DataFrame:
        reader = spark.read.format(self.format)
        if self.schema is not None:
            reader = reader.schema(self.schema)
        if self.format != "csv":
            return reader.options(**self.options).load(self.path)
        return na_tokens_to_null(reader.options(**{**CSV_OPTIONS, **self.options}).load(self.path))


@dataclass(frozen=True)
class FileSink:
    """Writes ``folder/name``; small reports become a single file."""

    folder: str
    format: str = "parquet"
    mode: str = "overwrite"
    options: Mapping[str, str] = field(default_factory=dict)

    def write(self, df: DataFrame, name: str, small: bool = False) -> str:
        path = f"{self.folder.rstrip('/')}/{name}"
        # Reports keep their order in one file; they have a row per metric or column.
        rows = df.coalesce(1) if small else df
        options = {**(CSV_OPTIONS if self.format == "csv" else {}), **self.options}
        rows.write.format(self.format).options(**options).mode(self.mode).save(path)
        return path


def convert(spark: SparkSession, source: FileSource, sink: FileSink, name: str) -> str:
    """Read a table in one format and write it in another."""
    return sink.write(source.read(spark), name)


def text_schema(columns) -> T.StructType:
    """All columns as text, which spares a CSV scan the header lookup."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])
