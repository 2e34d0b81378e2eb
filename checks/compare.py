"""Run registered queries and their DuckDB statements side by side.

Usage: python -m checks.compare [folder] [query ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

from cellsift.plans import workloads
from checks import oracles

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        gone = df[c].isna()
        if pd.api.types.is_numeric_dtype(df[c]) and not pd.api.types.is_bool_dtype(df[c]):
            df[c] = df[c].astype(float).round(9) + 0.0
        df[c] = df[c].astype(object).where(~gone, None).map(lambda v: v if v is None else str(v))
    return df.sort_values(list(df.columns), ignore_index=True, na_position="first")


def _kind(column: pd.Series) -> str:
    return "time" if pd.api.types.is_datetime64_any_dtype(column) else str(column.dtype)


def differences(left: pd.DataFrame, right: pd.DataFrame) -> str | None:
    a, b = normal(left), normal(right)
    if list(a.columns) != list(b.columns):
        return f"columns {list(a.columns)} != {list(b.columns)}"
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    unlike = (a.fillna("~") != b.fillna("~")).any(axis=1)
    if unlike.any():
        return f"{int(unlike.sum())} rows differ:\n{a[unlike].head(3)}\n{b[unlike].head(3)}"
    types = [
        f"{c}: {left[c].dtype} / {right[c].dtype}"
        for c in a.columns
        if _kind(left[c]) != _kind(right[c]) and left[c].notna().all() and right[c].notna().all()
    ]
    return f"types {types}" if types else None


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, checks, bad = connect(folder), oracles.statements(), 0
    for name, run in workloads.registered().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        try:
            found = run(spark, folder).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: {str(e)[:600]}", flush=True)
            bad += 1
            continue
        middle = time.time()
        if name not in checks:
            print(f"rows {name}: {len(found)} rows, {middle - start:.1f}s", flush=True)
            continue
        try:
            wanted = con.execute(checks[name]).df()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name} (statement): {str(e)[:600]}", flush=True)
            bad += 1
            continue
        problem = differences(found, wanted)
        bad += problem is not None
        print(
            f"{'ok  ' if problem is None else 'DIFF'} {name}: {len(found)} rows, spark {middle - start:.1f}s, "
            f"duckdb {time.time() - middle:.1f}s {problem or ''}", flush=True,
        )
        spark.catalog.clearCache()
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
