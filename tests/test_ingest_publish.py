"""Records set aside on reading, repairs of stored partitions, runs published as one."""

import os
from types import SimpleNamespace

import pytest
from pyspark.sql import types as T

from cellsift import ColumnRule, QualitySpec, SpecError
from cellsift.operators import repair
from cellsift.plans import publish
from cellsift.sources.files import text_schema
from cellsift.sources.quarantine import read_with_quarantine


# Quarantine ----------------------------------------------------------------------
def test_every_line_is_a_row_or_rejected(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,2\n3\n\n"a,b","c""d"\n5,6,7\n"q",NA\n"open,1\n')
    found = read_with_quarantine(spark, str(tmp_path), text_schema(["x", "y"]))
    assert sorted(map(tuple, found.rows.collect()), key=str) == [("1", "2"), ("a,b", 'c"d'), ("q", None)]
    bad = {r["record"]: (r["record_number"], r["n_cells"], r["reason"]) for r in found.rejected.collect()}
    assert bad == {"3": (2, 1, "too few cells"), "5,6,7": (4, 3, "too many cells"), '"open,1': (6, 2, "open quote")}
    where = found.rejected.select("file", "block_start").distinct().collect()
    assert len(where) == 1 and where[0][0].endswith("/a.csv") and where[0][1] == 0
    found.close()


def test_rejected_by_type_and_whatever_is_selected(spark, tmp_path):
    (tmp_path / "a.csv").write_text("_record;n\nu;1\nv;x\nw\n")
    schema = T.StructType([T.StructField("_record", T.StringType()), T.StructField("n", T.IntegerType())])
    found = read_with_quarantine(spark, str(tmp_path), schema, {"sep": ";"})
    assert [r[0] for r in found.rows.select("_record").collect()] == ["u"]
    assert {(r["record"], r["reason"]) for r in found.rejected.collect()} == {
        ("v;x", "cell of another type"), ("w", "too few cells"),
    }
    assert found.rejected.count() == 2


def test_no_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n")
    found = read_with_quarantine(spark, str(tmp_path), text_schema(["x", "y"]))
    assert found.rows.count() == 0 and found.rejected.count() == 0


# Repair in place -------------------------------------------------------------------
SPEC = QualitySpec(
    table_name="t", id_column="id", cross_field=(),
    rules={"id": ColumnRule("id", use_for_detection=False), "v": ColumnRule("numeric"), "p": ColumnRule("categorical")},
)
ISSUES = (
    "issue_id string, row_id string, column_name string, suggested_value string, suggested_num double, "
    "confidence double, can_auto_fix boolean, issue_seq long, reason string"
)
TABLE = "id string, v double, p string"


def _files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def _stored(spark, path):
    rows = [(f"r{i}", float(i), None if i % 4 == 3 else f"p{i % 4}") for i in range(40)]
    spark.createDataFrame(rows, TABLE).write.partitionBy("p").parquet(path)
    return {r[0]: r for r in rows}


def _issue(row, column, number=None, text=None, confidence=1.0):
    return ("i", row, column, text if text else str(number), number, confidence, True, 1, "why")


def test_only_partitions_with_a_fix_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = _stored(spark, path)
    issues = spark.createDataFrame(
        [_issue("r1", "v", -1.0), _issue("r3", "v", -3.0), _issue("r2", "v", -2.0, confidence=0.1)], ISSUES
    )
    before = _files(path)
    schema = spark.read.parquet(path).schema
    assert repair.repair_in_place(spark, path, ["p"], issues, SPEC, schema=schema) == 2
    after = _files(path)
    same = {f for f in before if "/p=p0/" in f or "/p=p2/" in f}
    assert same and before & after == same
    want = rows | {"r1": ("r1", -1.0, "p1"), "r3": ("r3", -3.0, None)}
    got = [(r["id"], r["v"], r["p"]) for r in spark.read.schema(schema).parquet(path).collect()]
    assert sorted(got) == sorted(want.values())


def test_nothing_to_fix_changes_no_file(spark, tmp_path):
    path = str(tmp_path / "t")
    _stored(spark, path)
    before = _files(path)
    assert repair.repair_in_place(spark, path, ["p"], spark.createDataFrame([], ISSUES), SPEC) == 0
    assert repair.repair_in_place(spark, path, ["p"], spark.createDataFrame([_issue("no", "v", 1.0)], ISSUES), SPEC) == 0
    assert _files(path) == before


def test_moves_between_partitions_are_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    _stored(spark, path)
    before = _files(path)
    moves = spark.createDataFrame([_issue("r1", "p", text="p0")], ISSUES)
    with pytest.raises(SpecError):
        repair.repair_in_place(spark, path, ["p"], moves, SPEC)
    fixes = spark.createDataFrame([_issue("r1", "v", 5.0)], ISSUES)
    with pytest.raises(SpecError):
        repair.repair_in_place(spark, path, ["p"], fixes, SPEC, rederive=lambda df: df.selectExpr("id", "v", "'p9' AS p"))
    assert _files(path) == before


# Published runs ----------------------------------------------------------------------
def _fake_run(spark, number, broken=False):
    def table():
        return spark.createDataFrame([(number,)], "n int")

    def stop():
        raise RuntimeError("lost")

    return SimpleNamespace(
        table=table(), public_issues=table, recommendations=table, summary=stop if broken else table, profile=table
    )


def test_readers_see_a_whole_run_or_the_former_one(spark, tmp_path):
    folder = str(tmp_path)
    assert publish.published(spark, folder) is None
    with pytest.raises(SpecError):
        publish.read_published(spark, folder, "detected_issues")
    publish.publish_run(_fake_run(spark, 1), folder, "one")
    with pytest.raises(RuntimeError):
        publish.publish_run(_fake_run(spark, 2, broken=True), folder, "two")
    assert os.path.exists(f"{folder}/runs/two/detected_issues")
    assert publish.published(spark, folder)["run_id"] == "one"
    assert publish.read_published(spark, folder, "detected_issues").first()["n"] == 1
    publish.publish_run(_fake_run(spark, 2), folder, "two")
    assert {publish.read_published(spark, folder, n).first()["n"] for n in ("detected_issues", "final_report")} == {2}


def test_publishing_again_writes_no_table(spark, tmp_path):
    folder = str(tmp_path)
    places = publish.publish_run(_fake_run(spark, 1), folder, "one")
    files = _files(folder)
    publish.publish_run(_fake_run(spark, 2), folder, "two")
    assert publish.publish_run(_fake_run(spark, 9), folder, "one") == places
    assert files <= _files(folder) and publish.read_published(spark, folder, "recommendations").first()["n"] == 1
    with pytest.raises(SpecError):
        publish.publish_run(_fake_run(spark, 1), folder, "../x")
