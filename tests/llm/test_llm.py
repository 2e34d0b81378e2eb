"""The operators on text collections against brute force, and on odd tables."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cellsift.llm import embeddings, html, language, minhash, mixing, pieces, pii, quality, rules, sharding
from cellsift.llm.components import components
from cellsift.llm.queries import piece_model

DOCS = "doc_id long, text string, lang string, source string, n_chars int, quality int, _src string, label string"


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls in each column, empty, blank and long texts, repeated rows, clashing names."""
    rnd = random.Random(1)
    words = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "mail@host.example.com", "###"]
    rows = []
    for i in range(120):
        text = " ".join(rnd.choice(words) + str(rnd.randint(0, 60)) for _ in range(rnd.randint(30, 120)))
        rows.append((i, text, rnd.choice(["en", "fr", None]), rnd.choice(["s0", "s1", "s2", None]), len(text), 5, "x", "l"))
    long = "wort ünd " * 60_000
    rows += [(200, None, None, None, None, None, None, None), (201, "", "en", "s0", 0, 1, "x", ""), (202, " \n\t ", "en", "s0", 4, 1, "x", "")]
    rows += [(203, long, "de", "s0", len(long), 1, "x", ""), (204, "123 456", "en", "s1", 7, 1, "x", ""), (None, "no id here", "en", "s1", 9, 1, "x", "")]
    rows += [rows[0]] * 3 + [(300 + k, rows[1][1], "en", "s1", 1, 1, "x", "") for k in range(5)]
    return spark.createDataFrame(rows, DOCS).repartition(4)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, int(i % 3 > 0), 0) for i in range(100)] + [(0, 1, 0), (None, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_components(spark):
    rnd = random.Random(2)
    edges = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1100)]
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), []).collect()}
    want = {x: x for e in edges for x in e}
    for _ in want:
        for a, b in edges:
            want[a] = want[b] = min(want[a], want[b])
    assert {x: got.get(x, x) for x in want} == want


def test_language(spark, docs, empty):
    out = language.identify(docs).collect()
    by_id = {r.doc_id: r for r in out}
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    assert by_id[200].lang_pred == by_id[201].lang_pred == by_id[204].lang_pred == "und"
    assert language.identify(empty).count() == 0
    profiles = language.learn(spark.createDataFrame([("a", "abab aab ab"), ("b", "xyxy yx")], "lang string, text string"), 5)

    def ranks(text):
        counts = Counter()
        for word in re.findall("[^\\W\\d_]+", text.lower()):
            padded = f"\x01{word}\x01"
            counts.update(word)
            counts.update(padded[i : i + 2] for i in range(len(padded) - 1))
            counts.update(padded[i : i + 3] for i in range(len(padded) - 2))
        code = lambda g: sum(ord(c) << 21 * k for k, c in enumerate(reversed(g)))
        return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], code(x[0])))][:5]

    models = {"a": ranks("abab aab ab"), "b": ranks("xyxy yx")}
    for text in ("ab ba", "yyx xy x", "zz ab yx"):
        mine = ranks(text)
        far = {k: sum(abs(i - m.index(g)) if g in m else 5 for i, g in enumerate(mine)) for k, m in models.items()}
        lang = min(far, key=lambda k: (far[k], k))
        assert profiles.predict(text) == (lang, pytest.approx(1 - far[lang] / (5 * len(mine))))


def test_language_held_out(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = language.identify(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def test_embeddings(spark):
    rng = np.random.default_rng(3)
    rows, centre = [], rng.normal(size=(6, 8))
    for i in range(400):
        v = centre[i % 6] + rng.normal(size=8) * rng.choice([0.02, 0.3])
        rows.append((i, [float(np.float32(x)) for x in v], i % 2))
    rows += [(500 + k, rows[0][1], 0) for k in range(30)]
    odd = [(600, None, 0), (601, [0.0] * 8, 0), (602, [float("nan")] * 8, 0), (603, [1.0, None], 0), (604, rows[0][1], None), (605, [], 1), (606, [1.0], 1)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int")
    for options in ({}, {"cell_rows": 20, "block_rows": 16}):
        got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(df, [], **options).collect()}
        x = np.array([r[1] for r in rows], dtype=np.float32).astype(float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        link = (x @ x.T >= 0.98) & (np.array([r[2] for r in rows])[:, None] == np.array([r[2] for r in rows])[None, :])
        np.fill_diagonal(link, False)
        ids = np.array([r[0] for r in rows])
        root = ids.copy()
        for _ in rows:
            root = np.minimum(root, np.where(link, root[None, :], 10**9).min(axis=1))
        assert [got[i] for i in ids] == list(zip(link.sum(axis=1).tolist(), root.tolist()))
        assert all(got[o[0]] == (0, o[0]) for o in odd)
    assert embeddings.near_duplicates(df.limit(0), []).count() == 0


def test_shards(spark, docs, empty):
    limit = 4000
    rows = sharding.shards(docs, [], limit).collect()
    assert len(rows) == docs.count()
    size, count = Counter(), Counter()
    for r in rows:
        size[r.shard, r.part] += r.n_bytes
        count[r.shard, r.part] += 1
        assert len(r.shard) == r.depth
    assert all(size[k] <= limit or count[k] == 1 for k in size)
    # A shard's parent did not fit: no bucket is split without need.
    names = {k[0] for k in size}
    for name in names - {""}:
        inside = sum(n for (s, _), n in size.items() if s.startswith(name[:-1]))
        assert inside > limit
    assert sharding.shards(empty, []).count() == 0


def test_sentencepiece(spark, docs, empty):
    encoder = pieces.Encoder(piece_model())
    rnd = random.Random(4)
    texts = ["", " ", "  a  b ", "▁x", "a" * 500, "ab" * 300, "\x00\n", "日本語テキスト🙂", "<s></s><0x0A>", " " * 40, "th" * 50 + "e"]
    texts += ["".join(rnd.choice("aehnort isz") for _ in range(rnd.randint(1, 200))) for _ in range(400)]
    texts += ["".join(chr(rnd.choice([rnd.randint(32, 126), rnd.randint(160, 592), rnd.randint(0x4E00, 0x9FFF)])) for _ in range(40)) for _ in range(200)]
    ids, starts, word, bounds = encoder.encode(texts)
    want = encoder.library.encode(texts, num_threads=1)
    for k in range(len(texts)):
        assert [i for w in word[bounds[k] : bounds[k + 1]] for i in ids[starts[w] : starts[w + 1]].tolist()] == want[k]
    out = pieces.decode(pieces.encode(docs, piece_model()).select("*", "_pieces.*"), piece_model()).collect()
    for r in out:
        text = r.text or ""
        assert list(r.ids) == encoder.library.encode(text) and r.n_tokens == len(r.ids)
        assert r.decoded == encoder.library.decode(list(r.ids))
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
    assert pieces.encode(empty, piece_model()).count() == 0


def _statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)


def test_quality_rules(spark, docs, labels, empty):
    found = rules.learn_rules(docs, labels)
    texts = {d.doc_id: d.text for d in docs.collect()}
    for r in rules.apply_rules(docs, found).collect():
        stats = _statistics(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == stats
        assert r.base_failed == (stats[0] < 50 or 100 * stats[4] > 50 * stats[0])
        assert r.kept == (not r.base_failed and r.rule == 0)
    assert rules.apply_rules(empty, rules.learn_rules(empty, labels.limit(0))).count() == 0
    rng = np.random.default_rng(0)
    rows = {n: rng.random(3000) for n in rules.RATIOS}
    bad = (rows["symbol_share"] > 0.8) | ((rows["repeat_share"] > 0.7) & (rows["word_length"] < 0.4))
    learned = rules.learn(rows, bad)
    said = np.logical_or.reduce([r.covers(rows) for r in learned])
    assert (said == bad).mean() > 0.97


def test_pii(spark, docs, empty):
    rnd = random.Random(5)
    bits = ["a", "b@", ".c", "1", "12", "+", " ", "-", "255", ".", "(", "@x.y", "é", "4111111111111111", "🙂", "\n"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(1, 60))) for _ in range(400)]
    texts += ["1" * 20000, "a." * 20000, "a@b" + ".c" * 9000, "+1" + "-" * 9000, None, "", "a@b.c_d@e.f", "1.2.3.4 " * 500]
    luhn = lambda d: sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    digits = lambda m: re.sub("[^0-9]", "", m)
    checks = {
        "email": lambda m: True,
        "ip": lambda m: all(int(x) <= 255 for x in m.split(".")),
        "card": lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m)),
        "phone": lambda m: 8 <= len(digits(m)) <= 15,
    }
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.report(df).collect():
        text = texts[r.doc_id] or ""
        spans = {k.name: [m.span() for m in re.finditer(k.pattern, text, re.A) if checks[k.name](m[0])] for k in pii.BASE}
        base = ",".join(f"{k}:{a}:{b}" for k, s in spans.items() for a, b in s)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(map(len, spans.values()))
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest() and r.spans.startswith(base)
    said = ["iban DE89370400440532013000.", "DE88370400440532013000", "my ssn 123-45-6789", "123-45-6789", "call 212-555-1234"]
    out = pii.redact(spark.createDataFrame(list(enumerate(said)), "doc_id long, text string")).orderBy("doc_id")
    assert [r.text for r in out.collect()] == ["iban [IBAN].", said[1], "my ssn [SSN]", said[3], "call [TEL]"]
    assert pii.redact(docs).columns == docs.columns and pii.report(docs).count() == docs.count()
    assert pii.report(empty).count() == 0


def test_html(spark):
    article = "<article><h1>Title &amp; more</h1><p><b>One  two,\nthree<br><p>Four four four four</p></article>"
    page = '<html><head><title>x</title><script>var t="</p>";</script></head><body><nav><a href=/>Menu</a></nav>{}<div class="comments"><p>I disagree, really, with all of this, sir</p></div><aside>Side</aside><form>Send</form><footer>&copy; 2</footer></body></html>'
    rows = [(i, "http://a.example/1", page.format('<div class="ad">Buy, buy, buy, now</div>' + article)) for i in range(5)]
    rows += [(10, None, None), (11, "", ""), (12, "http://b.example", "plain text only"), (13, "x", "<p>open <i>tags"), (14, "http://a.example/2", "<div><p>Other shape, no article here</p></div>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    got = {r.page_id: r.text for r in html.main_text(df, []).collect()}
    assert {got[i] for i in range(5)} == {"Title & more One two, three Four four four four"}
    assert [got[i] for i in (10, 11, 12, 13, 14)] == ["", "", "plain text only", "open tags", "Other shape, no article here"]
    assert html.main_text(df.limit(0), []).count() == 0


def test_html_of_several_containers(spark):
    """Text in several containers comes whole and once; pages of a minority template do not fall to the body."""
    words = lambda n: "Text of a story that runs on. " * n
    top = "<html><body><nav><a href=/>Menu</a></nav><div class=legal>All rights kept</div>{}</body></html>"
    two = top.format("<div class=intro><p>Begin. {}</div><div class=story><p>Middle. {}<div class=quote>Quote.</div></div>")
    article = top.format("<article><h1>Head</h1><section><p>{}</section><section>{}</section></article>")
    post = top.format("<div class=post><p>Post. {}</div>")
    loose = top.format("<p>Loose. {}</p><div class=rest><p>Rest. {}</div>")
    rows = [(i, "http://two.example/", two.format(words(8), words(12 + i % 3))) for i in range(20)]
    # One page has a short intro, one none.
    rows += [(20, "http://two.example/", two.format("", words(60))), (21, "http://two.example/", two.replace("Begin. ", "").format("", words(9)))]
    rows += [(100 + i, "http://mixed.example/", article.format(words(9), words(5))) for i in range(90)]
    rows += [(200 + i, "http://mixed.example/", post.format(words(9))) for i in range(10)]
    rows += [(300 + i, "http://loose.example/", loose.format(words(9), words(9))) for i in range(3)]
    rows += [(400, "http://mixed.example/", top.format(f"<div class=odd><p>Odd. {words(9)}</div>"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = {r.page_id: r.text for r in html.main_text(df, []).collect()}
    for i in range(20):
        assert got[i] == f"Begin. {words(8)}Middle. {words(12 + i % 3)}Quote."
    assert got[20] == f"Begin. Middle. {words(60)}Quote." and got[21] == f"Middle. {words(9)}Quote."
    assert {got[100 + i] for i in range(90)} == {f"Head {words(9)}{words(5)}".strip()}
    assert {got[200 + i] for i in range(10)} == {f"Post. {words(9)}".strip()}
    assert {got[300 + i] for i in range(3)} == {f"Loose. {words(9)}Rest. {words(9)}".strip()}
    assert got[400] == f"Odd. {words(9)}".strip()


def test_mixing(spark, docs, empty):
    rows = mixing.mixed(docs, [], max_repeats=3.0).collect()
    tokens = Counter()
    for d in docs.collect():
        tokens[d.source] += len(re.findall(r"[^\x20\x09-\x0D]+", d.text or ""))
    total, used, weight = sum(tokens.values()), Counter(), {}
    for r in rows:
        used[r.source] += r.n_tokens
        weight[r.source] = r.weight
    most = max(len(re.findall(r"\S+", d.text or "")) for d in docs.collect() if d.doc_id != 203)
    for s in tokens:
        # The last pass ends before the document that would exceed the quota.
        assert weight[s] * total - 1 <= used[s] + max(most, 120_000 if s == "s0" else 0)
        assert used[s] <= weight[s] * total + 1
    cover = mixing.remix(docs, [], cover=True, max_repeats=2.0)
    assert cover.columns == docs.columns
    have, more = Counter(map(str, docs.collect())), Counter(map(str, cover.collect()))
    assert set(have) == set(more) and all(have[k] <= more[k] <= 2 * have[k] for k in have)
    assert mixing.mixed(empty, []).count() == 0 and mixing.remix(empty, []).count() == 0


def test_quality_classifier(spark, sf, docs, labels, empty):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    given = spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.learn(table, given)
    out = quality.scores(table, model).join(given, "doc_id")
    assert out.where("(quality = 1) = kept").count() / out.count() > 0.95
    small = quality.scores(docs, quality.learn(docs, labels))
    assert small.count() == docs.count() and small.where("p_good is null or p_good not between 0 and 1").isEmpty()
    assert quality.keep_good(empty, quality.learn(empty, labels.limit(0))).columns == empty.columns
    assert quality.scores(docs, quality.learn(docs, labels.limit(0))).where("not kept").isEmpty()


def test_near_duplicates(spark, docs, empty):
    rnd = random.Random(6)
    vocabulary = [f"w{i}" for i in range(2000)]
    rows = []
    for group in range(12):
        base = [rnd.choice(vocabulary) for _ in range(200)]
        for copy in range(8):
            text = list(base)
            for _ in range(rnd.choice([0, 1, 2, 3, 5, 9])):
                text[rnd.randrange(200)] = rnd.choice(vocabulary)
            rows.append((group * 8 + copy, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bags = {i: Counter(zip(*(t.split()[k:] for k in range(5)))) for i, t in rows}
    freq = Counter(s for b in bags.values() for s in b)
    share = max(0.01 * len(rows), 1)
    idf = {s: (np.log1p(len(rows) / max(n, share)) / np.log1p(100)) ** 0.25 for s, n in freq.items()}
    parent = {i: i for i, _ in rows}
    close = False
    for i in bags:
        for j in bags:
            if i < j:
                both = sum(min(n, bags[j][s]) * idf[s] for s, n in bags[i].items() if s in bags[j])
                all_ = sum(n * idf[s] for b in (bags[i], bags[j]) for s, n in b.items()) - both
                close |= 0.79 < both / all_ < 0.8
                if both / all_ >= 0.8:
                    a, b = sorted((parent[i], parent[j]))
                    parent = {k: a if v == b else v for k, v in parent.items()}
    got = {r.doc_id: r.class_id for r in minhash.classes(df, []).collect()}
    assert got == parent
    odd = {r.doc_id: r.class_id for r in minhash.classes(docs, []).collect()}
    assert all(odd[i] == i for i in (200, 201, 202)) and all(odd[300 + k] == 1 for k in range(5))
    kept = minhash.keep_one(docs, [])
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.select("doc_id").collect())
    assert max(ids.values()) == 1 and not set(ids) & {300, 301, 302, 303, 304} and None in ids
    assert minhash.classes(empty, []).count() == 0


def test_every_shingle_has_its_own_frequency(spark):
    """Below the share that tasks know by name, frequencies count too: here they decide a pair."""
    rows = []
    for i in range(600):
        text = [f"d{i}w{j}" for j in range(30)]
        # A passage in five of 600 documents, less than a hundredth of them.
        rows.append((i, " ".join(text + [f"p{j}" for j in range(30)] if i < 5 else text)))
    base = [f"b{j}" for j in range(105)]
    # Two texts that share much, and each a passage that three others have as well.
    rows += [(700, " ".join(base + [f"q{j}" for j in range(13)])), (701, " ".join(base + [f"r{j}" for j in range(13)]))]
    rows += [(710 + 10 * k + m, " ".join([f"{c}{j}" for j in range(13)] + [f"o{k}{m}x{j}" for j in range(30)])) for k, c in enumerate("qr") for m in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bags = {i: Counter(zip(*(t.split()[k:] for k in range(5)))) for i, t in rows}
    freq = Counter(s for b in bags.values() for s in b)
    a, b = bags[700], bags[701]

    def similarity(idf):
        both = sum(min(n, b[s]) * idf(s) for s, n in a.items() if s in b)
        return both / (sum(n * idf(s) for x in (a, b) for s, n in x.items()) - both)

    exact = similarity(lambda s: np.log1p(len(rows) / freq[s]) ** minhash.IDF_POWER)
    flat = similarity(lambda s: np.log1p(len(rows) / max(freq[s], minhash.IDF_SHARE * len(rows))) ** minhash.IDF_POWER)
    between = (exact + flat) / 2
    assert flat < between < exact
    got = {r.doc_id: r.class_id for r in minhash.classes(df, [], similarity=between, bands=60, rows=3).collect()}
    assert got[700] == got[701] == 700
    assert sum(k != v for k, v in got.items()) == 1


def test_many_frequent_shingles(spark, monkeypatch):
    """Where the list of frequent shingles is too long, all are weighed by the share it was made with."""
    made = []

    class Recorded(minhash.Weights):
        def __init__(self, *args):
            super().__init__(*args)
            made.append((args[2], self.factor))

    monkeypatch.setattr(minhash, "Weights", Recorded)
    monkeypatch.setattr(minhash, "MAX_FREQUENT", 40)
    passages = [[f"p{k}x{j}" for j in range(9)] for k in range(12)]
    texts = [" ".join([f"d{i}w{j}" for j in range(20)] + [w for k, p in enumerate(passages) if i % (k + 1) == 0 for w in p]) for i in range(40)]
    counts = Counter(s for t in texts for s in set(zip(*(t.split()[k:] for k in range(5)))))
    # The mean number of shingles of a text, over the length of the list, is the share.
    share = max(minhash.IDF_SHARE, sum(counts.values()) / 40 / 40)
    assert share > minhash.IDF_SHARE and sum(n >= share * 40 for n in counts.values()) <= 40
    minhash.classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), []).count()
    ((count, factor),) = made
    assert sorted(count) == sorted(n for n in counts.values() if n >= share * 40)
    assert factor == pytest.approx((np.log1p(40 / count) / np.log1p(1 / share)) ** minhash.IDF_POWER)


def test_pipeline(spark, sf):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, sf).collect()
    table = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert out and {r.doc_id for r in out} <= set(table)
    assert all(r.n_tokens == len(r.ids) for r in out)
    assert max(Counter(r.doc_id for r in out).values()) <= 2


def _shares(tokens, a):
    raised = {s: t**a for s, t in tokens.items()}
    return {s: x / sum(raised.values()) for s, x in raised.items()}


def _entropy(shares):
    return -sum(p * np.log(p) for p in shares.values())


def test_pipeline_equals_plain_python(spark, tmp_path):
    """Each stage's decisions: who is rejected, which copy stays, what is redacted, how often a document comes."""
    import corpus_pipeline

    rnd = random.Random(8)
    vocabulary = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(3, 9))) for _ in range(3000)]
    sources = ["hot"] * 90 + ["s1"] * 40 + ["s2"] * 25 + ["s3"] * 12
    texts, redacted = {}, {}
    for i, _ in enumerate(sources):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randint(70, 110))]
        if i % 6 == 1:
            words = [rnd.choice(["###", "$$$!", "BUY!!", "0099", "%%"]) if rnd.random() < 0.6 else w for w in words]
        elif i % 6 == 2:
            words = texts[i - 2].split()
            words[20] = rnd.choice(vocabulary)
        elif i % 6 == 3:
            words[5], words[30] = f"user{i}@host.example.com", f"10.2.3.{i}"
        texts[i] = " ".join(words)
        redacted[i] = re.sub(r"user\d+@host.example.com", "[EMAIL]", re.sub(r"10\.2\.3\.\d+", "[IP]", texts[i]))
    rows = [(i, texts[i], "en", s, len(texts[i])) for i, s in enumerate(sources)]
    given = {i: int(i % 6 != 1) for i in texts if i % 5}
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, q, 0) for i, q in given.items()], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    def features(ids):
        text = quality.text_features(pa.array([texts[i] for i in ids]))
        return text, quality.meta_features(pa.array([sources[i] for i in ids]), pa.array(["en"] * len(ids)), pa.array([float(len(texts[i])) for i in ids]))

    known, pool = sorted(given), [i for i in texts if i not in given]
    model = quality.co_train(*features(known), np.array([float(given[i]) for i in known]), *features(pool))
    good = [i for i in texts if model.score(*features([i]))[2][0] >= 0.5]
    assert 0 < len(texts) - len(good) < 60

    bags = {i: Counter(zip(*(texts[i].split()[k:] for k in range(5)))) for i in good}
    freq = Counter(s for b in bags.values() for s in b)
    idf = {s: (np.log1p(len(good) / max(n, 0.01 * len(good))) / np.log1p(100)) ** 0.25 for s, n in freq.items()}
    kind = {i: i for i in good}
    for i in good:
        for j in good:
            if i < j and set(bags[i]) & set(bags[j]):
                both = sum(min(n, bags[j][s]) * idf[s] for s, n in bags[i].items() if s in bags[j])
                alike = both / (sum(n * idf[s] for b in (bags[i], bags[j]) for s, n in b.items()) - both)
                assert not 0.78 < alike < 0.82
                if alike >= 0.8:
                    a, b = sorted((kind[i], kind[j]))
                    kind = {k: a if v == b else v for k, v in kind.items()}
    stay = [i for i in good if kind[i] == i]
    assert len(stay) < len(good)

    size = {i: len(redacted[i].split()) for i in stay}
    tokens = Counter()
    for i in stay:
        tokens[sources[i]] += size[i]
    own = _shares(tokens, 1)
    target = _entropy(own) + 0.5 * (np.log(len(own)) - _entropy(own)) + 1e-12
    ratio = max(tokens.values()) / min(tokens.values())
    fits = lambda m: _entropy(_shares(tokens, m / 2**20)) <= target and ratio ** (1 - m / 2**20) <= 4 + 1e-9
    low, high = -1, 2**20
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle, high)
    share = _shares(tokens, high / 2**20)
    budget = max(tokens.values()) / max(share.values())
    want = Counter()
    encoder = pieces.Encoder(piece_model()).library
    for s in tokens:
        quota = round(share[s] * budget)
        left = quota % tokens[s]
        place = lambda i: hashlib.md5(f"{mixing.SEED}:{i}:{hashlib.md5(redacted[i].encode()).hexdigest()}".encode()).hexdigest()[:15]
        for i in sorted((i for i in stay if sources[i] == s), key=place):
            left -= size[i]
            want[i, s, tuple(encoder.encode(redacted[i]))] = quota // tokens[s] + (left >= 0)
            left = left if left >= 0 else -1
    assert max(want.values()) > 1
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.source, tuple(r.ids)) for r in out) == want
    # The target itself is reached, not a limit on the way.
    assert abs(_entropy(share) - target) < 1e-4
