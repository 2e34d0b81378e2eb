"""The prefix trie against brute force, list ranking and running sums on lists of any layout."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cellsift.llm import prefixes, tour
from cellsift.llm.scan import running

TURNS = "conv_id long, turn long, role string, text string, depth string, name string, parent int"


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        first = c - (c % 100 if c >= 0 else -(-c % 100))
        whole[c] = own.get(first, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, convs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(convs) - 1) * len(node[-1][1]) if node else 0
    out = []
    for node, convs in members.items():
        done = ",".join(str(c) for c in sorted(c for c in convs if len(whole[c]) == len(node)))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(done.encode()).hexdigest()
        out.append((min(convs), len(node), parent, len(convs), children[node], leaves[node], saved[node], digest))
    return sorted(out, key=repr)


def odd_rows(seed):
    rnd = random.Random(seed)
    texts = ["", "a", "ünï", "hello there", "x" * 5000, None]
    rows = []
    for c in [*range(0, 30), *range(100, 130), *range(195, 205), *range(301, 340), -250, -200, -3, 7_000_000_000]:
        for t in range(rnd.randint(1, 9)):
            rows.append((c, rnd.choice([t, t, t, None, 3]), rnd.choice(["user", "assistant", None]), rnd.choice(texts)))
    rows += [(c, t, "user", f"same {t}") for c in range(2000, 2150) for t in range(7)]  # one very common conversation
    rows += [(5000, t, "user", "again") for t in range(700)]  # one long conversation
    rows += rows[:5] + [(None, 0, "user", "nobody's"), (None, None, None, None)]
    return rows


@pytest.mark.parametrize("block", [1 << 16, 40])
def test_trie(spark, block):
    rows = odd_rows(block)
    table = spark.createDataFrame([(*r, "d", "n", 1) for r in rows], TURNS).repartition(5)
    got = prefixes.prefix_trie(table, [], block)
    assert sorted((tuple(r)[:8] for r in got.collect()), key=repr) == brute(rows)
    tops = got.where("depth = 0").collect()
    assert len(tops) == 1 and tops[0].n_nodes == got.count() and tops[0].exit_at == 2 * tops[0].n_nodes - 1


def test_no_rows(spark):
    assert prefixes.prefix_trie(spark.createDataFrame([], TURNS), []).count() == 0


def test_turnless(spark):
    """All own turns are replaced and there is nothing to take: a member of the root only."""
    conv = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 2)
    row = prefixes.prefix_trie(spark.createDataFrame([(conv, 0, "user", "x")], "conv_id long, turn long, role string, text string"), [])
    assert [tuple(r)[:8] for r in row.collect()] == [
        (conv, 0, None, 1, 0, 1, 0, hashlib.sha256(str(conv).encode()).hexdigest())
    ]


@pytest.mark.parametrize("near", [True, False])
def test_ranking(spark, near):
    """Lists whose neighbours share blocks, and lists in random order, where coins are needed."""
    n = 3000
    order = list(range(n))
    if not near:
        random.Random(1).shuffle(order)
    rows = [(order[i], 0, order[i + 1] if i + 1 < n else None, 0 if i + 1 < n else None, 1, i % 7) for i in range(n)]
    rows += [(-1, 5, None, None, 4, 4)]
    kept = []
    table = spark.createDataFrame(rows, "a long, b long, sa long, sb long, one long, w long")
    got = {(r.a, r.b): (r.one, r.w) for r in tour.ranked(table, ["one", "w"], kept, 100).collect()}
    want, total = {(-1, 5): (0, 0)}, 0
    for i, a in enumerate(order):
        want[a, 0] = (i, total)
        total += i % 7
    assert got == want
    assert any("spliced" in p for p in kept) != near


def test_running(spark):
    """Sums and former values go on where a group crosses ranges."""
    rows = [(g, k, (g * 31 + k) % 11) for g, n in ((1, 5), (2, 4000), (3, 1), (4, 900)) for k in range(n)]
    table = spark.createDataFrame(rows, "g long, k long, x long").repartition(6)
    got = running(table, ["g"], [F.col("k")], ["x"], [], lag="k").collect()
    want, total = [], defaultdict(int)
    for g, k, x in rows:
        total[g] += x
        want.append((g, k, total[g], k - 1 if k else None))
    assert sorted(map(tuple, got)) == sorted(want)
    assert running(table.limit(0), ["g"], [F.col("k")], ["x"], []).count() == 0


def test_query_and_sql(spark, sf):
    import __spark_entry__ as entry
    import duckdb

    name = "op13_conversation_prefix_trie"
    got = entry.queries()[name](spark, sf).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf}/conversations.parquet')")
    cursor = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    want = [tuple(dict(zip(names, r))[c] for c in got[0].__fields__) for r in cursor.fetchall()]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
