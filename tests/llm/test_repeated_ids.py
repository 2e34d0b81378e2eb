"""Rows that share an id, columns with a helper's name, and redaction by the reported spans."""

import numpy as np
from pyspark.sql import functions as F

from cellsift.llm import embeddings, minhash, pii, quality


def test_vectors_with_a_repeated_or_null_id(spark):
    rnd = np.random.default_rng(3)
    u, v = rnd.normal(size=(2, 16))
    w = u + 1e-3
    rows = [(5, u, "a"), (5, v, "a"), (7, w, "a"), (None, v + 1e-3, "a"), (None, rnd.normal(size=16), "a"), (9, u, "b")]
    df = spark.createDataFrame([(i, [float(x) for x in e], g) for i, e, g in rows], "vec_id long, embedding array<double>, label string")
    got = sorted((tuple(r) for r in embeddings.near_duplicates(df, []).collect()), key=repr)
    want = [(5, 1, 5, True), (5, 1, 5, True), (7, 1, 5, False), (9, 0, 9, True), (None, 1, 5, False), (None, 0, None, False)]
    assert got == sorted(want, key=repr)
    # Labels that are equal as whole numbers only are different labels.
    two = spark.createDataFrame([(1, [1.0, 2.0], 1.2), (2, [1.0, 2.0], 1.7)], "vec_id long, embedding array<double>, label double")
    assert [r.n_links for r in embeddings.near_duplicates(two, []).collect()] == [0, 0]


def test_texts_with_a_repeated_id(spark):
    own = [" ".join(f"t{k}w{j}" for j in range(60)) for k in range(5)]
    near = own[1] + " end"
    rows = [(1, own[0]), (1, own[1]), (1, own[1]), (2, near), (2, own[2]), (3, own[2]), (4, own[3]), (4, None), (4, ""), (None, own[0])]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, same string").repartition(3)
    left = minhash.keep_one(df, [])
    assert left.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in left.collect()), key=repr)
    want = [(1, own[0]), (1, own[1]), (2, own[2]), (4, own[3]), (4, None), (4, ""), (None, own[0])]
    assert got == sorted(want, key=repr)
    classes = {r.doc_id: r.class_id for r in minhash.classes(df, []).collect()}
    assert classes == {1: 1, 2: 1, 3: 1, 4: 4}


def test_redaction_follows_the_report(spark):
    said = ["reach us +49 30 1234567, ref 212-555-1234", "mail a@b.example now", None, "", "no data", "ip 10.0.0.1 and 10.0.0.2 ünï x@y.example"]
    df = spark.createDataFrame([(i, t, "o", "b", 9) for i, t in enumerate(said)], "doc_id long, text string, _old string, base string, n_chars int")
    spans = {r.doc_id: r.spans for r in pii.report(df).collect()}
    out = {r.doc_id: r for r in pii.redact(df).collect()}
    for i, text in enumerate(said):
        want, at = "", 0
        for kind, a, z in sorted((s.split(":") for s in spans[i].split(",") if s), key=lambda x: int(x[1])):
            want += text[at : int(a)] + f"[{kind.upper()}]"
            at = int(z)
        want = None if text is None else want + text[at:]
        assert out[i].text == want and out[i]["_old"] == "o" and out[i].base == "b"
        assert out[i].n_chars == (9 if want == text else len(want))


def test_columns_named_like_a_helper(spark):
    df = spark.createDataFrame([(1, "good text here", "mine", "row")], "doc_id long, text string, _quality string, _row string")
    model = quality.Model((), (), None, 1.0, (0, 0))
    assert [tuple(r) for r in quality.keep_good(df, model).collect()] == [(1, "good text here", "mine", "row")]
    assert quality.keep_good(df, model._replace(base=0.0)).where(F.col("_quality") == "mine").count() == 0
