"""Outputs of a run that readers see all at once or not at all.

Tables of a run go to ``<folder>/runs/<run id>``; when all are written, a list of
their places is put beside them and the file ``current.json``, which readers go
by, is replaced by renaming. A run that stops half way changes nothing for
readers, and is written anew under its id; one that was published is not.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession

from cellsift.plans.pipeline import DetectionRun, write_run
from cellsift.sources.files import FileSink
from cellsift.spec import SpecError

CURRENT, MANIFEST = "current.json", "manifest.json"


def _hadoop(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(context._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    place, files = _hadoop(spark, path)
    return files.exists(place)


def _replace(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file aside and rename it over the one in place."""
    jvm = spark.sparkContext._jvm
    aside, files = _hadoop(spark, f"{path}.new")
    out = files.create(aside, True)
    out.write(text.encode())
    out.close()
    place = files.makeQualified(_hadoop(spark, path)[0])
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        place.toUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE
    context.rename(files.makeQualified(aside), place, how)


def _load(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def publish_run(
    run: DetectionRun, folder: str, run_id: str, fix_mode: str | None = None, format: str = "parquet",
) -> dict[str, str]:
    """Write all tables of a run and make them the current ones; returns their places.

    ``run_id`` names the run and its input. Publishing a finished id again writes
    no table, it only makes that run the current one.
    """
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", run_id):
        raise SpecError(f"Not a run id: {run_id}")
    spark = run.table.sparkSession
    folder = folder.rstrip("/")
    home = f"{folder}/runs/{run_id}"
    if _exists(spark, f"{home}/{MANIFEST}"):
        entry = _load(spark, f"{home}/{MANIFEST}")
    else:
        entry = {"run_id": run_id, "format": format, "tables": write_run(run, FileSink(home, format), fix_mode)}
        _replace(spark, f"{home}/{MANIFEST}", json.dumps(entry))
    _replace(spark, f"{folder}/{CURRENT}", json.dumps(entry))
    return entry["tables"]


def published(spark: SparkSession, folder: str) -> dict | None:
    """Id, format and places of the current run, None if there is none yet."""
    path = f"{folder.rstrip('/')}/{CURRENT}"
    return _load(spark, path) if _exists(spark, path) else None


def read_published(spark: SparkSession, folder: str, name: str) -> DataFrame:
    entry = published(spark, folder)
    if entry is None or name not in entry["tables"]:
        raise SpecError(f"No published table {name} in {folder}")
    reader = spark.read.format(entry["format"])
    return (reader.option("header", "true") if entry["format"] == "csv" else reader).load(entry["tables"][name])
