"""Shards as files: every row once, no file over the limit."""

from collections import Counter

from cellsift.llm import sharding


def test_written_shards(spark, tmp_path):
    limit = 2000
    rows = [(i, f"text {i} " * (1 + i % 30), "x", i % 5) for i in range(300)]
    rows += [(7, "the same row " * 23, None, 1)] * 40 + [(None, None, "n", 2), (None, "", None, None), (900, "long " * 900, "y", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string, depth int").repartition(4)
    names = sharding.write_shards(docs, f"{tmp_path}/out", [], limit)
    assert names == ("shard_1", "part")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert Counter(tuple(r) for r in back.select(docs.columns).collect()) == Counter(rows)
    size, count, files = Counter(), Counter(), {}
    for r in back.selectExpr("*", "_metadata.file_path AS file").collect():
        place = (r.shard_1, r.part)
        size[place] += len((r.text or "").encode())
        count[place] += 1
        files.setdefault(place, set()).add(r.file)
    assert all(size[p] <= limit or count[p] == 1 for p in size)
    assert all(len(f) == 1 for f in files.values())
    # Names are text whatever digits they have, and agree with the assignment.
    assert all(isinstance(s, str) and s[0] == "s" and set(s[1:]) <= set("01") for s, _ in size)
    told = {"s" + r.shard for r in sharding.shards(docs, [], limit).select("shard").distinct().collect()}
    assert {s for s, _ in size} == told


def test_written_shards_small(spark, tmp_path):
    one = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    assert sharding.write_shards(one, f"{tmp_path}/one", []) == ("shard", "part")
    # All fits: one shard of depth 0, whose name is no null.
    assert {(r.doc_id, r.text, r.shard, r.part) for r in spark.read.parquet(f"{tmp_path}/one").collect()} == {(1, "a", "s", 0), (2, "b", "s", 0)}
    sharding.write_shards(one.limit(0), f"{tmp_path}/none", [])
