"""Main text: nothing lost by size, boilerplate out, and votes recomputed in plain Python."""

import re
from collections import defaultdict

from cellsift.llm import html

PAGES = "page_id long, url string, html string, host string, of string, verdicts string"
WORDS = "Running text of a story, with commas and all. "


def texts(spark, rows):
    df = spark.createDataFrame([(*r, "h", "o", "v") for r in rows], PAGES).repartition(3)
    return {r.page_id: r.text for r in html.main_text(df, []).collect()}


def page(body):
    return f"<html><body><nav><a href=/>Menu</a></nav>{body}<footer>&copy; us</footer></body></html>"


def test_nothing_is_lost_by_size(spark):
    many = [[f"Part {i} {k}. {WORDS * 3}".strip() for k in range(24)] for i in range(5)]
    rows = [(i, "http://many.example/", page("".join(f"<div>{t}</div>" for t in m))) for i, m in enumerate(many)]
    ends = "<div class=lead>Short lead {}.</div><div class=story>{}</div><div class=close>The end {}.</div>"
    rows += [(10 + i, "http://ends.example/", page(ends.format(i, WORDS * (40 + i), i))) for i in range(6)]
    deep = "".join(f"<div class=c{chr(97 + k)}>Own {k} {{0}}.</div>" for k in range(26))
    rows += [(30 + i, "http://deep.example/", page(deep.format(i))) for i in range(4)]
    got = texts(spark, rows)
    assert [got[i] for i in range(5)] == [" ".join(m) for m in many]
    assert all(got[10 + i] == f"Short lead {i}. {WORDS * (40 + i)}The end {i}." for i in range(6))
    assert all(got[30 + i] == " ".join(f"Own {k} {i}." for k in range(26)) for i in range(4))


def test_words_in_classes(spark):
    inside = (
        "<article><h1>Head {0}</h1><div class='notice-board'>Half of it {0}.</div><p id=search>We search on {0}.</p>"
        "<p class=share>They share.</p><div class=advert>Buy now</div><div id=comments><p>I disagree</p></div></article>"
    )
    rows = [(i, "http://in.example/", page(inside.format(i))) for i in range(4)]
    outside = "<div class='reader-comments'>Me too {0}</div><div class=ad-slot>Buy {0}</div><div class=notice-board>Text {0}.</div>"
    rows += [(10 + i, "http://out.example/", page(outside.format(i))) for i in range(4)]
    got = texts(spark, rows)
    assert all(got[i] == f"Head {i} Half of it {i}. We search on {i}. They share." for i in range(4))
    assert all(got[10 + i] == f"Text {i}." for i in range(4))


def test_signs(spark):
    body = "<div class=text>Story {0}, {1}</div><div class=strip>On paper</div><div class=more><a href=/a>One {0}</a> or <a href=/b>two</a></div>"
    rows = [(i, "http://a.example/", page(body.format(i, WORDS * 3))) for i in range(4)]
    # Copies of one page are no sign that its text is boilerplate.
    rows += [(20 + i, "http://copies.example/", page(f"<div class=text>Same. {WORDS}</div>")) for i in range(30)]
    rows += [(60, "http://copies.example/", page(f"<div class=text>Other. {WORDS}</div>"))]
    got = texts(spark, rows)
    assert all(got[i] == f"Story {i}, {WORDS * 3}".strip() for i in range(4))
    assert {got[20 + i] for i in range(30)} == {f"Same. {WORDS}".strip()} and got[60] == f"Other. {WORDS}".strip()


def test_long_and_repeated_pages(spark):
    long = page("<div>" + f"<p>{WORDS}</p>" * 20_000 + "</div>")
    rows = [(1, "http://l.example/", long), (1, "http://l.example/", long), (2, None, "<p>x" * 3000), (None, None, "no id")]
    df = spark.createDataFrame([(*r, "h", "o", "v") for r in rows], PAGES)
    got = sorted(((r.page_id, r.n_chars, len(r.text)) for r in html.main_text(df, []).collect()), key=repr)
    size = len(WORDS) * 20_000 - 1
    assert got == sorted([(1, size, size)] * 2 + [(2, 5999, 5999), (None, 5, 5)], key=repr)


def test_votes_in_plain_python(spark, sf):
    """The verdicts that Spark adds up, and the texts by them, on all pages of a host."""
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    rows += [(10_000 + i, "http://x.example/", page(f"<div class=a>Own {i % 9}</div><div class=b>Always the same</div>")) for i in range(40)]
    of, seen = defaultdict(int), defaultdict(list)
    name = lambda u: (re.findall(r"^\s*[A-Za-z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", u or "") or [""])[0].lower()
    for _, url, text in rows:
        of[name(url)] += 1
        if text:
            parsed = html.parse(text)
            found = html.held(parsed, html.homes(parsed))
            whole = tuple(sorted((p, h.hash) for p, h in found.items()))
            for path, h in found.items():
                seen[name(url), path].append((h, whole, sum(x.text for x in found.values())))
    want = defaultdict(dict)
    for (host, path), votes in seen.items():
        if len(votes) < max(2, of[host] / 100):
            continue
        different = defaultdict(set)
        for h, whole, _ in votes:
            different[h.hash].add(whole)
        pages = sum(map(len, different.values()))
        size = sum(h.text for h, _, _ in votes)
        least = 3 if size < 0.1 * sum(t for _, _, t in votes) else 8
        repeated = pages >= least and 2 * max(map(len, different.values())) >= pages
        weight = 0.25 if any(h.hinted for h, _, _ in votes) else 1
        want[host][path] = size * weight > sum(h.links for h, _, _ in votes) and not repeated
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    assert {r.host: {v.path: v.wins for v in r.verdicts} for r in html.verdicts(df).collect()} == dict(want)
    got = {r.page_id: r.text for r in html.main_text(df, []).collect()}
    assert got == {i: html.extract(t, want[name(u)]) for i, u, t in rows}
    assert got[10_005] == "Own 5"
