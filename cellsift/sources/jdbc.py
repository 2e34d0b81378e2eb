"""Database tables over Spark's JDBC source."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTable:
    """One table of a database, as source and as sink.

    With a partition column and its bounds the scan runs in parallel; rows
    outside the bounds are read too. Filters and column choices are pushed into
    the database by Spark.
    """

    url: str
    table: str
    properties: Mapping[str, str] = field(default_factory=dict)
    partition_column: str | None = None
    lower: str | int | None = None
    upper: str | int | None = None
    partitions: int = 16
    fetch_rows: int = 10_000

    def read_options(self) -> dict[str, str]:
        options = {**self.properties, "url": self.url, "dbtable": self.table, "fetchsize": str(self.fetch_rows)}
        if self.partition_column is not None:
            if self.lower is None or self.upper is None:
                raise ValueError("a partition column needs lower and upper bounds")
            options |= {
                "partitionColumn": self.partition_column,
                "lowerBound": str(self.lower),
                "upperBound": str(self.upper),
                "numPartitions": str(self.partitions),
            }
        return options

    def write_options(self, name: str, keep_table: bool = False) -> dict[str, str]:
        return {
            **self.properties,
            "url": self.url,
            "dbtable": name,
            "truncate": str(keep_table).lower(),
            "numPartitions": str(self.partitions),
        }

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.format("jdbc").options(**self.read_options()).load()

    def write(self, df: DataFrame, name: str, small: bool = False) -> str:
        rows = df.coalesce(1) if small else df
        rows.write.format("jdbc").options(**self.write_options(name)).mode("overwrite").save()
        return name
