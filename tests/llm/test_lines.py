"""Line dedup against brute force, on odd tables and with filters of any size."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cellsift.llm import lines
from cellsift.llm.keyed import join_keyed

DOCS = "doc_id long, text string, row string, n_lines int, drop string, doc string, _lines string"
STRIP = " \t\n\v\f\r"


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(STRIP))


def brute(rows):
    """(id, text) to (id, lines, dropped, digest), by the rule as it is written."""
    held = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            held[key_of(line)].add((i is None, i or 0))
    out = []
    for i, text in rows:
        all_lines = (text or "").split("\n")
        left = [x for x in all_lines if len(key_of(x)) < 10 or min(held[key_of(x)]) == (i is None, i or 0)]
        digest = hashlib.sha256("\n".join(left).encode()).hexdigest()
        out.append((i, len(all_lines), len(all_lines) - len(left), digest))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(4)
    pool = [f"Shared line {k} of the pool" for k in range(60)] + ["short", "", "ten chars!", "nine char", "ÄÖÜ äöü ßßß"]
    out = []
    for i in range(150):
        some = [rnd.choice(pool) if rnd.random() < 0.5 else f"own {i} {k} {rnd.random()}" for k in range(rnd.randint(0, 9))]
        some = [rnd.choice(["", " ", "\t", "\v\f\r"]) + rnd.choice([x, x.upper(), x.lower()]) + rnd.choice(["", "  "]) for x in some]
        out.append((i, "\n".join(some)))
    twice = "the same line, twice in one text"
    out += [(900, f"{twice}\n{twice}\nend"), (901, None), (902, ""), (903, "\n\n\n"), (904, " \n" * 5 + "x" * 300_000)]
    out += [(905, "x" * 300_000), (None, pool[0]), (None, "only here, in rows without id"), (None, "only here, in rows without id")]
    out += [(906, pool[1] + "\nnew text of 906"), (906, pool[1] + "\nother text of 906"), out[3], out[3], (907, "a" * 9), (908, "a" * 9)]
    return out + [(1000 + i, pool[2]) for i in range(400)]


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame([(*r, "a", 1, "b", "c", "d") for r in rows], DOCS).repartition(7)


def digested(out):
    got = out.select("doc_id", "_lines.n_lines", "_lines.n_dropped", F.sha2("_lines.text", 256)).collect()
    return sorted(map(tuple, got), key=repr)


@pytest.mark.parametrize("sizes", [{}, {"line_bits": 1}, {"most_bits": 1}])
def test_lines(table, rows, sizes):
    out = lines.drop_repeated(table, [], **sizes)
    assert digested(out) == brute(rows)
    # Clashing columns stay, but for the result's own name.
    assert [c for c in out.columns if c != "_lines"] == [c for c in table.columns if c != "_lines"]
    assert out.where("row <> 'a' or n_lines <> 1 or drop <> 'b' or doc <> 'c'").count() == 0


def test_only_suspects_shuffle(table, rows):
    """The filter lets pass what repeats, and little else."""
    filter_ = lines.repeats(table)
    found = lines.find_lines(pa.array([t for _, t in rows]))
    at, value = lines._hashes(found)
    held = defaultdict(int)
    for i, (a, b) in enumerate(zip(found.start[at], found.end[at])):
        held[found.data[a:b].tobytes()] += 1
    often = np.array([held[found.data[a:b].tobytes()] > 1 for a, b in zip(found.start[at], found.end[at])])
    hit = filter_.holds(value)
    assert hit[often].sum() >= often.sum() - 3  # what one text only repeats is no suspect
    assert hit[~often].mean() < 0.02


def test_no_rows(spark):
    assert lines.drop_repeated(spark.createDataFrame([], DOCS), []).count() == 0


def test_segments():
    rnd = np.random.default_rng(1)
    for share in (0, 0.001, 0.02, 0.5, 1):
        bits = np.packbits(rnd.random(lines.SEGMENT_BITS) < share, bitorder="little")
        assert (lines._unpacked(lines._packed(bits)) == bits).all()


def test_join_keyed(spark):
    """A heavy key is joined by broadcast, others by a shuffle, with the rows of a plain join."""
    rows = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 0, id % 400) as k")
    keyed = rows.groupBy("k").agg(F.count("*").alias("n")).where("k % 2 = 0")
    for how in ("inner", "left"):
        got = join_keyed(rows, keyed, "k", "n", how)
        assert sorted(map(repr, got.select("id", "k", "n").collect())) == sorted(
            map(repr, rows.join(keyed, "k", how).select("id", "k", "n").collect())
        )
    assert join_keyed(rows, keyed.limit(0), "k", "n").count() == 0


def test_query_and_sql(spark, sf):
    import __spark_entry__ as entry
    import duckdb

    got = entry.queries()["op12_line_dedup"](spark, sf).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    cursor = con.execute(entry.oracle_sql()["op12_line_dedup"])
    names = [c[0] for c in cursor.description]
    assert sorted(map(tuple, got)) == sorted(tuple(dict(zip(names, r))[c] for c in got[0].__fields__) for r in cursor.fetchall())
    assert sum(r.n_dropped for r in got) > 0
