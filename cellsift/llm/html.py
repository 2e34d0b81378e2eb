"""Main text of web pages by consensus of each host's pages.

Each page's running text belongs to the containers that hold it. Their paths,
generalised to tags and classes, are voted on per host in Spark: a path loses by
signs of boilerplate, which are links that outweigh its text, a class that hints at
it, and the same text on most of the host's different pages. Size alone is no sign.
Then each page is read again: all containers at paths that win, with what they hold,
are its main text, in page order. Paths that few pages have are judged by the page.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellsift.operators.keyed import join_keyed
from cellsift.sources.scratch import cut_lineage

#: Share of a host's pages that must have a path for the host to vote on it; so a host
#: votes on as many paths, at most, as a hundred of its pages have.
PRESENT = 0.01
#: A text is repeated if this share of a host's different pages with the path have it. Of so many
#: different pages at least: the first number where it is a small share of their text, else the second.
REPEATED = 0.5
DIFFERENT = (3, 8)
SMALL = 0.1
#: A class that hints at boilerplate leaves so much of a text's weight against links.
HINTED = 0.25

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|</?([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>|[^>]*>)", re.S
)
_CLASS = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
_CONTAINER = frozenset("article main section div td body".split())
_DROP = frozenset(
    "nav footer aside form script style textarea title noscript iframe template head button select svg canvas object "
    "dialog menu fieldset input audio video map".split()
)
#: Words that say what a container is, if its class or id consists of them, and hint at it if they are a part.
_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsors sponsored promo promos promotion banner sidebar "
    "widget widgets menu nav navbar navigation breadcrumb breadcrumbs comment comments commentlist disqus reply replies "
    "responses respond notice notices alert cookie cookies consent gdpr popup modal overlay newsletter subscribe signup "
    "login social share sharing related recommended recommendations footer copyright legal disclaimer masthead toolbar "
    "pagination pager search skip hidden".split()
)
#: Words that may stand beside them.
_NEUTRAL = frozenset(
    "site page box list area wrap wrapper container block section item items inner outer top bottom left right reader "
    "readers user users global slot unit bar side links link form thread count js mobile desktop main primary secondary".split()
)
_GROUPS = frozenset("div section ul ol dl table header nav aside footer".split())
_GENERIC = frozenset("# html body".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: An open tag of the key closes an open one of the values.
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}}
_CLOSES |= {"td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_BLOCK_ENDS_P = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section "
    "table ul".split()
)


class Page(NamedTuple):
    """Elements in page order (parent, tag, path, dropped, hinted) and texts with their element."""

    parent: list[int]
    tag: list[str]
    path: list[str]
    dropped: list[bool]
    hinted: list[bool]
    texts: list[tuple[int, str]]


def _sign(value: str) -> int:
    """2 if a class or id names boilerplate, 1 if a part of one does, else 0."""
    sign = 0
    for token in value.lower().split():
        parts = [x for x in re.split(r"[-_\d]+", token) if x]
        listed = sum(x in _WORDS for x in parts)
        if listed:
            sign = max(sign, 2 if all(x in _WORDS or x in _NEUTRAL for x in parts) else 1)
    return sign


def _attributes(rest: str) -> tuple[str, int]:
    """Generalised classes of a tag, and the sign of its class, id or role."""
    classes, sign = "", 0
    for name, a, b, c in _CLASS.findall(rest.rstrip(">/")):
        value = a or b or c
        name = name.lower()
        if name == "class":
            classes = ".".join(sorted(re.sub(r"\d+", "N", value).split()))
        sign = max(sign, 2 * (value.lower() in _ROLES) if name == "role" else _sign(value))
    return classes, sign


def parse(html: str) -> Page:
    """Elements and texts of a page; tags that are not closed end with their parent."""
    page = Page([-1], ["#"], [""], [False], [False], [])
    stack = [0]
    at = 0
    while True:
        found = _TOKEN.search(html, at)
        text = html[at : found.start()] if found else html[at:]
        if text:
            page.texts.append((stack[-1], unescape(text)))
        if not found:
            return page
        at = found.end()
        tag = found[1]
        if tag is None:
            continue
        tag = tag.lower()
        block = tag not in _INLINE
        if block:
            page.texts.append((stack[-1], " "))
        if html[found.start() + 1] == "/":
            for depth in range(len(stack) - 1, 0, -1):
                if page.tag[stack[depth]] == tag:
                    del stack[depth:]
                    break
            continue
        closes = _CLOSES.get(tag, set()) | ({"p"} if tag in _BLOCK_ENDS_P else set())
        for depth in range(len(stack) - 1, 0, -1):
            inside = page.tag[stack[depth]]
            if inside in closes:
                del stack[depth:]
                if tag != "tr":
                    break
            elif inside in _CONTAINER or inside in ("ul", "ol", "table", "dl"):
                break
        if tag in _VOID:
            continue
        classes, sign = _attributes(found[2])
        up = stack[-1]
        page.parent.append(up)
        page.tag.append(tag)
        page.path.append(f"{page.path[up]}>{tag}.{classes}" if classes else f"{page.path[up]}>{tag}" if tag not in _INLINE else page.path[up])
        within = any(page.tag[e] in ("article", "main") for e in stack)
        # Inside an article a word names a group, not a paragraph or a phrase.
        named = sign == 2 and tag not in ("html", "body", "article", "main") and (tag in _GROUPS or not within)
        comment = sign == 2 and tag == "article" and "comment" in classes.lower()
        page.dropped.append(page.dropped[up] or tag in _DROP or (tag == "header" and not within) or named or comment)
        page.hinted.append(page.hinted[up] or (sign == 1 and not within))
        if tag in _RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at)
            at = end.end() if end else len(html)
        elif not found[2].endswith("/>"):
            stack.append(len(page.tag) - 1)


def homes(page: Page) -> list[int]:
    """The container each element's text belongs to: the nearest article or main, else the nearest of all."""
    home = [0] * len(page.tag)
    for e in range(1, len(page.tag)):
        up = home[page.parent[e]]
        inner = page.tag[e] in _CONTAINER and page.tag[up] not in ("article", "main")
        home[e] = e if inner or page.tag[e] in ("article", "main") else up
    return home


class Held(NamedTuple):
    """Running text of a path on a page: code points outside and inside of links, whether hinted at, its hash."""

    text: int
    links: int
    hinted: bool
    hash: int

    @property
    def wins(self) -> bool:
        return self.text * (HINTED if self.hinted else 1) > self.links


def held(page: Page, home: list[int]) -> dict[str, Held]:
    """What each path holds, of elements that are not dropped."""
    link = [False] * len(page.tag)
    for e in range(1, len(page.tag)):
        link[e] = link[page.parent[e]] or page.tag[e] == "a"
    parts: dict[str, list] = {}
    for e, text in page.texts:
        if page.dropped[e]:
            continue
        size = len("".join(text.split()))
        if size:
            found = parts.setdefault(page.path[home[e]], [0, 0, page.hinted[home[e]], []])
            found[link[e]] += size
            found[3].append(text)
    return {p: Held(a, b, c, _digest(" ".join(" ".join(d).split()))) for p, (a, b, c, d) in parts.items()}


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def _article(path: str) -> bool:
    return path.rsplit(">", 1)[-1].partition(".")[0] in ("article", "main")


def text_at(page: Page, home: list[int], paths: set[str]) -> str:
    """Text of all elements at the paths and inside of them, in page order and once, without what is dropped.

    Body and root give the text that belongs to no other container.
    """
    inside = [False] * len(page.tag)
    for e in range(len(page.tag)):
        own = home[e] == e and page.path[e] in paths and page.tag[e] not in _GENERIC
        inside[e] = own or (e > 0 and inside[page.parent[e]])
    return " ".join("".join(t for e, t in page.texts if (inside[e] or page.path[home[e]] in paths) and not page.dropped[e]).split())


def extract(html: str | None, verdicts: dict[str, bool] | None) -> str:
    """The text at paths that win by the host's verdicts or, without one, by the page's own signs.

    Where none wins, at those that hold more text than links.
    """
    if not html:
        return ""
    page = parse(html)
    home = homes(page)
    found = held(page, home)
    verdicts = verdicts or {}
    chosen = {p for p, h in found.items() if _article(p) or verdicts.get(p, h.wins)}
    return text_at(page, home, chosen or {p for p, h in found.items() if h.text > h.links})


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each page holds at each of its paths, with hashes of that text and of the page's."""
    for batch in batches:
        rows = []
        for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if html:
                page = parse(html)
                found = held(page, homes(page))
                whole = _digest(",".join(str(h.hash) for _, h in sorted(found.items())))
                total = sum(h.text for h in found.values())
                rows += [(host, path, h.text, h.links, total, h.hinted, h.hash, whole) for path, h in found.items()]
        names = ["host", "path", "text", "links", "total", "hinted", "hash", "page"]
        kinds = [pa.string(), pa.string(), *[pa.int64()] * 3, pa.bool_(), pa.int64(), pa.int64()]
        columns = list(zip(*rows)) if rows else [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


@F.arrow_udf(T.StringType())
def _extract(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for html, verdicts in columns:
        known: dict[tuple, dict[str, bool]] = {}
        out = []
        for h, v in zip(html.to_pylist(), verdicts.to_pylist()):
            key = tuple((x["path"], x["wins"]) for x in v or ())
            out.append(extract(h, known.setdefault(key, dict(key))))
        yield pa.array(out, pa.string())


def host(url: str = "url") -> F.Column:
    """The host of a URL in lower case; empty if there is none."""
    name = F.regexp_extract(F.col(url).cast("string"), r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.lower(F.coalesce(name, F.lit("")))


def verdicts(pages: DataFrame) -> DataFrame:
    """``host``, its ``pages``, and the ``verdicts`` on paths that a hundredth of them have, and two at least.

    Equal pages count as one where the same text on different pages is a sign.
    Votes are added before they are dealt by host.
    """
    rows = pages.select(host().alias("host"), F.col("html").cast("string").alias("html"))
    found = rows.mapInArrow(_vote, "host string, path string, text long, links long, total long, hinted boolean, hash long, page long")
    each = found.groupBy("host", "path", "hash", "page").agg(
        F.count("*").alias("n"), *(F.sum(c).alias(c) for c in ("text", "links", "total")), F.max("hinted").alias("hinted")
    )
    sums = [F.sum(c).alias(c) for c in ("n", "text", "links", "total")]
    texts = each.groupBy("host", "path", "hash").agg(*sums, F.max("hinted").alias("hinted"), F.count("*").alias("pages"))
    total = texts.groupBy("host", "path").agg(
        *sums, F.max("hinted").alias("hinted"), F.sum("pages").alias("pages"), F.max("pages").alias("most")
    )
    weight = F.col("text") * F.when(F.col("hinted"), HINTED).otherwise(1.0)
    least = F.when(F.col("text") < SMALL * F.col("total"), DIFFERENT[0]).otherwise(DIFFERENT[1])
    repeated = (F.col("pages") >= least) & (F.col("most") >= REPEATED * F.col("pages"))
    total = total.withColumn("wins", (weight > F.col("links")) & ~repeated)
    sizes = rows.groupBy("host").agg(F.count("*").alias("of"))
    total = total.join(sizes, "host").where(F.col("n") >= F.greatest(F.lit(2.0), PRESENT * F.col("of")))
    return total.groupBy("host").agg(
        F.max("of").alias("of"), F.sort_array(F.collect_list(F.struct("path", "wins"))).alias("verdicts")
    )


def main_text(pages: DataFrame, kept: list[str]) -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``pages``.

    Null and empty pages have an empty text. Pages without a host vote as one
    host. Rows that repeat are extracted one by one, and pages of any length whole;
    other columns are ignored. An empty table has an empty result.
    """
    voted = cut_lineage(verdicts(pages), "paths", kept)
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), host().alias("host"))
    # A host may have any share of the pages.
    rows = join_keyed(rows, voted, "host", "of", "left")
    out = rows.select("page_id", "url", F.coalesce(_extract("html", "verdicts"), F.lit("")).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
