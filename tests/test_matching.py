"""The similarity join for long lists against all pairs, and joins with heavy keys."""

import random

import pytest
from pyspark.sql import functions as F

from cellsift import ColumnRule, QualitySpec
from cellsift.operators import keyed, matching, recommend, rules


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def best(texts, entries, cutoff):
    out = {}
    for t in {t for t in texts if t}:
        found = max((round(1 - edits(t, e) / max(len(t), len(e)), 4), e) for e in set(entries) if e)
        if found[0] >= cutoff:
            out[t] = (found[1], found[0])
    return out


def column(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v string")


@pytest.mark.parametrize("cutoff", [0.6, 0.9, 0.4])
def test_best_matches(spark, cutoff):
    rnd = random.Random(int(cutoff * 10))
    entries = ["".join(rnd.choice("abcé ") for _ in range(rnd.randint(1, 14))) for _ in range(250)]
    texts = [e[: rnd.randint(0, len(e))] + rnd.choice(["", "z", "ab"]) + e[rnd.randint(0, len(e)) :] for e in entries]
    texts += ["".join(rnd.choice("abcé ") for _ in range(rnd.randint(1, 14))) for _ in range(100)]
    texts += ["abab" * 9, "ab" * 17 + "ba", "", None, "a", texts[0], texts[0]]
    entries += ["abab" * 10, "ba" * 18, None, "", entries[3]]
    got = {r.text: (r.match, r.ratio) for r in matching.best_matches(column(spark, texts), column(spark, entries), cutoff).collect()}
    assert got == best(texts, entries, cutoff)


@pytest.mark.parametrize("cutoff", [0.6, 0.4])
def test_labels_of_few_words_meet_by_length(spark, cutoff, monkeypatch):
    """Labels share all their bigrams, so each pair meets once, by length, in groups of bounded size."""
    monkeypatch.setattr(matching, "GROUP_TEXTS", 16)
    monkeypatch.setattr(matching, "GROUP_ENTRIES", 8)
    monkeypatch.setattr(matching, "PAIRS", 50)
    entries = [f"{a} {b} Brand#{n}" for a in ("large", "blue", "réd") for b in ("ring", "bolt") for n in range(1, 14)]
    texts = [f"new {e[: 4 + i % 9]}-{i}" for i, e in enumerate(entries)] + [e[:3] + e[4:] for e in entries[::5]]
    texts += [e + " " + e + " " + e + " " + e for e in entries[:2]] + ["?" * 64, "?" * 65, "ring large Brand#1"]
    entries += [entries[0] * 5, "x" * 64]
    left, right = (matching._letters(column(spark, x).selectExpr("v as text", "length(v) as size")) for x in (texts, entries))
    mine, theirs = matching._by_length(left, right, cutoff)
    assert matching.meetings(mine, theirs, "_size") <= len(texts) * len(entries)
    got = {r.text: (r.match, r.ratio) for r in matching.best_matches(column(spark, texts), column(spark, entries), cutoff).collect()}
    assert got == best(texts, entries, cutoff)


def test_no_entries(spark):
    assert matching.best_matches(column(spark, ["abc"]), column(spark, []), 0.6).count() == 0
    assert matching.best_matches(column(spark, []), column(spark, ["abc"]), 0.6).count() == 0


def test_heavy_bigram_is_dealt_out(spark):
    many = spark.range(4000).selectExpr("id", "if(id % 2 = 0, 'hot', concat('k', id % 900)) as gram")
    few = spark.createDataFrame([("hot", 1), ("hot", 2), ("k3", 3)], "gram string, e int")
    one, two = keyed.dealt(many, few, "gram", "id")
    got = one.join(two, ["gram", "_deal"]).select("id", "e").collect()
    want = many.join(few, "gram").select("id", "e").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    # At most 1 / 256 of the rows for each deal, about.
    assert one.groupBy("gram", "_deal").count().agg(F.max("count")).first()[0] < 60


def test_keyed_join(spark):
    rows = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 0, id % 400) as k")
    unique = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("k % 2 = 0")
    for how in ("inner", "left"):
        got = keyed.join_keyed(rows, unique, "k", "n", how).select("id", "k", "n").collect()
        assert sorted(map(repr, got)) == sorted(map(repr, rows.join(unique, "k", how).select("id", "k", "n").collect()))
    assert keyed.join_keyed(rows, unique.limit(0), "k", "n", "left").count() == 3000


def test_long_lists_of_a_spec(spark):
    """A list beyond the inline length goes through the index, with the suggestions of the expression."""
    allowed = tuple(f"{a}{b} value" for a in "abcdefg" for b in "uvwxyz")
    spec = QualitySpec("t", "id", {"id": ColumnRule("id"), "g": ColumnRule("categorical", allowed_values=allowed)}, cross_field=())
    rows = [(str(i), v) for i, v in enumerate(["au valu", "zz value", "nothing like it", None, "au value"] + ["hot valeu"] * 40)]
    df = spark.createDataFrame(rows, "id string, g string")
    findings = rules.explode_findings(rules.with_findings(df, spec), spec)
    got = {r.row_id: (r.suggested_value, r.confidence) for r in recommend.recommend_invalid(findings, spec).collect()}
    want = {}
    for i, v in rows:
        if v is not None and v not in allowed:
            want[i] = best([v], allowed, 0.6).get(v, (allowed[0], 0.5))
    assert got == want


def test_suggestions_from_a_table(spark):
    entries = column(spark, ["red bolt", "red bolts", "blue gear", "blue gear", None])
    rows = spark.createDataFrame([(1, "red bolt", 7), (2, "red blt", 8), (3, "???", 9), (4, None, 1), (5, "red blt", 2)], "id int, name string, match int")
    got = recommend.suggest_from_table(rows, "name", entries)
    assert sorted(tuple(r) for r in got.select("id", "name", "suggested_value", "confidence").collect()) == [
        (2, "red blt", "red bolt", 0.875), (3, "???", "blue gear", 0.5), (5, "red blt", "red bolt", 0.875),
    ]
