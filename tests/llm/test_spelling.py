"""Spelling variants against brute force, with lists of any length."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cellsift.llm import spelling

DOCS = "doc_id long, text string, word string, key string, n string"


def brute(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % 199 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) >= 6:
                counts[word] += 1
    words = {w: n for w, n in counts.items() if n >= 5}
    near = defaultdict(set)
    for a in words:
        for b in words:
            if len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 1:
                near[a].add(b)
            elif len(a) == len(b) + 1 and any(a[:k] + a[k + 1 :] == b for k in range(len(a))):
                near[a].add(b)
                near[b].add(a)
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best and words[best] >= 5 * words[w]:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows():
    """Chains of forms, ties, repeated letters, long words, many words that share both halves, odd rows."""
    rnd = random.Random(3)
    words = ["colour", "color", "colours", "colouur", "aaaaaa", "aaaaaaa", "aaaaaaaa", "aabaaa", "éàüößç", "éàüoßç", "École"]
    words += ["x" * 70, "x" * 69 + "y", "x" * 71, "straße", "strasse", "naïvely", "naively", "×÷×÷×÷", "×÷×÷××"]
    words += ["".join(rnd.choice("abé") for _ in range(rnd.randint(5, 8))) for _ in range(150)]
    words += [f"prefix{a}{b}{tail}" for a in "abcd" for b in "abcd" for tail in ("suffix", "sufix")]
    rows = []
    for i in range(200):
        some = rnd.choices(words, weights=[1 + (k * 7919) % 40 for k in range(len(words))], k=rnd.randint(0, 120))
        rows.append((i, rnd.choice([" ", "-", "\n", "1"]).join(rnd.choice([w, w.upper(), w.title()]) for w in some)))
    rows += [(300, "colour " * 3000), (None, "colour color " * 9), (301, None), (302, ""), (303, "12 %% ."), (304, "z" * 100_000)]
    rows += [(400 + k, "chaittne " * 10 + "chaintne " * (k % 2) + ("chainone" if k % 14 == 0 else "")) for k in range(100)]
    return rows + [rows[0]] * 3 + [(None, None)]


@pytest.mark.parametrize("size", [4096, 4])
def test_variants(spark, rows, size):
    table = spark.createDataFrame([(*r, "w", "k", "n") for r in rows], DOCS).repartition(5)
    got = spelling.variants(table, [], size)
    want = brute(rows)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert max(w[4] for w in want) > 3 and any(w[1] and w[1] != w[2] for w in want)


def test_lists_are_bounded(spark):
    """Words that share long fronts and backs are dealt on, and every near pair keeps one list."""
    words = [(f"commonfront{a}{b}{c}commonback", 9) for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"]
    found = spelling.lists(spark.createDataFrame(words, "word string, n long"), [], 20)
    sizes = found.groupBy("key").agg(F.count("*").alias("n"), F.max(F.length("window")).alias("free")).collect()
    assert max(r.n for r in sizes if r.free > 2) <= 20 and max(r.n for r in sizes) <= 64
    rows = [(k, f"{w} " * 9) for k, (w, _) in enumerate(words)]
    out = spelling.variants(spark.createDataFrame(rows, "doc_id long, text string"), [], 20)
    assert sorted(map(tuple, out.collect()), key=repr) == brute(rows)


def test_no_rows(spark):
    assert spelling.variants(spark.createDataFrame([], DOCS), []).count() == 0


def test_hashes():
    rnd = np.random.default_rng(2)
    data = rnd.integers(0, 256, 5000).astype(np.uint8)
    start = rnd.integers(0, 4000, 300)
    end = start + np.concatenate([rnd.integers(1, 70, 295), [0, 64, 65, 500, 1000]])
    begun = rnd.integers(0, 1 << 32, 300).astype(np.uint32)
    want = [zlib.crc32(data[a:b], int(c)) for a, b, c in zip(start, end, begun)]
    assert spelling._run_hashes(data, start, end, begun).tolist() == want


def test_counts_of_a_slice():
    texts = ["Straßen straßen", None, "", "abcdefÉ", "éé ééééééé"]
    word, n = spelling.count_words(pa.array(["1", None, "3", "4", "5"]), pa.array(texts))
    assert dict(zip(word.to_pylist(), n.to_pylist())) == {"straßen": 2, "abcdefÉ": 1, "ééééééé": 1}


def test_query_and_sql(spark, sf):
    import __spark_entry__ as entry
    import duckdb

    name = "op11_spelling_variants"
    got = entry.queries()[name](spark, sf).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    cursor = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    want = [tuple(dict(zip(names, r))[c] for c in got[0].__fields__) for r in cursor.fetchall()]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert spark.createDataFrame(got).where(F.col("form").isNotNull()).count() > 0
