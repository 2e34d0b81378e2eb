"""Where intermediate tables go: the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared scratch folder; a local one only for a local master."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get(CHECKPOINT_KEY, None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="cellsift-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{checkpoint_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, label: str = "stage", kept: list[str] | None = None, **options: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Later steps start from the written rows, also after executors were lost.
    ``kept`` collects the path, for ``drop_written`` once the table is done with.
    ``options`` are the writer's.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    if kept is not None:
        kept.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables that ``cut_lineage`` wrote below the scratch folder."""
    root = checkpoint_folder(spark)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        if path.startswith(root):
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)
    paths.clear()
