"""Co-training on all unlabelled documents, against one that holds them in memory."""

import random

import numpy as np
import pyarrow as pa

from cellsift.llm import quality


def _documents():
    rnd = random.Random(5)
    vocabulary = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 8))) for _ in range(400)]
    rows = []
    for i in range(700):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randint(30, 90))]
        if i % 3 == 0:
            words = [rnd.choice(["###", "$$$!", "BUY!!", "0099"]) if rnd.random() < 0.5 else w for w in words]
        text = " ".join(words)
        rows.append((i, text, rnd.choice(["en", "de", None]), "ads" if i % 3 == 0 and i % 7 else f"s{i % 4}", len(text)))
    rows += [(800, None, None, None, None), (801, "", "en", "s1", 0), (None, rows[1][1], "en", "s1", 9), (10, rows[10][1], "de", "s2", 4)]
    return rows, {i: int(i % 3 != 0) for i in range(700) if i % 4 == 1}


def test_every_unlabelled_document_may_be_lent(spark):
    rows, given = _documents()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").repartition(5)
    labels = spark.createDataFrame([(i, q) for i, q in given.items()], "doc_id long, quality int")
    model = quality.learn(docs, labels)

    def features(some):
        text = quality.text_features(pa.array([r[1] for r in some], pa.string()))
        meta = [pa.array([r[k] for r in some], kind) for k, kind in ((3, pa.string()), (2, pa.string()), (4, pa.float64()))]
        return text, quality.meta_features(*meta)

    known = [r for r in rows if r[0] in given]
    # Rows without id come first; the rest by id, of one id in any order.
    pool = sorted((r for r in rows if r[0] not in given), key=lambda r: -1 if r[0] is None else r[0])
    plain = quality.co_train(*features(known), np.array([float(given[r[0]]) for r in known]), *features(pool))
    assert model.lent == plain.lent and min(model.lent) > 26  # more than two rounds of 13
    for a, b in zip(model.views + (model.combined,), plain.views + (plain.combined,)):
        np.testing.assert_allclose(a.weight, b.weight, rtol=1e-6, atol=1e-8)
    out = quality.scores(docs, model).collect()
    assert len(out) == len(rows)
    good = {r.doc_id: r.kept for r in out if r.doc_id is not None and r.doc_id < 700}
    assert sum(good[i] == (i % 3 != 0) for i in good) / len(good) > 0.95


def test_pool_keeps_all_rows_without_label(spark):
    rows, given = _documents()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    labels = spark.createDataFrame([(i, q) for i, q in given.items()] + [(None, 1)], "doc_id long, quality int")
    pool = quality.unlabelled(docs, labels, [])
    assert pool.count() == sum(r[0] not in given for r in rows)
    assert pool.select("_row").distinct().count() == pool.count()
