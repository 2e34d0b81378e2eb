"""Personal data: patterns propose spans, checksums confirm them, context adjusts the score.

All is column expressions. A pattern cuts a text into the parts between its
matches; parts and matches give the places, the neighbourhood of each match and,
joined again, the redacted text, in time linear in the text.

Base kinds (email, ip, card, phone) are reported whenever their check holds.
Added kinds (iban, ssn, tel) need a score of ``ACCEPT``: their own score, plus
what a context word nearby gives. An added span that overlaps a base span is
dropped.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCEPT = 0.6
CONTEXT_BEFORE = 40
CONTEXT_AFTER = 20


class Kind(NamedTuple):
    """``pattern`` is stated plainly; ``java`` is the same with fewer attempts per text."""

    name: str
    pattern: str
    java: str
    check: Callable[[Column], Column]
    base: bool
    score: float
    context: str
    bonus: float


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also if used inside other lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    def total(digits: Column) -> Column:
        each = F.transform(
            F.split(F.reverse(digits), ""),
            lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
                F.element_at(F.array(*(F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), c.cast("int") + 1)
            ),
        )
        return F.aggregate(each, F.lit(0), lambda a, x: a + x)

    return let(
        _digits(match),
        lambda d: F.when(F.length(d).between(16, 19), total(d) % 10 == 0).otherwise(F.lit(False)),
    )


def _mod97(match: Column) -> Column:
    def rest(text: Column) -> Column:
        turned = F.concat(F.substring(text, 5, 40), F.substring(text, 1, 4))
        value = F.transform(
            F.split(turned, ""), lambda c: F.when(c.between("0", "9"), c.cast("int")).otherwise(F.ascii(c) - 55)
        )
        return F.aggregate(value, F.lit(0), lambda a, x: (a * F.when(x > 9, 100).otherwise(10) + x) % 97)

    return let(
        F.regexp_replace(match, " ", ""), lambda t: F.when(F.length(t).between(15, 34), rest(t) == 1).otherwise(F.lit(False))
    )


_OCTET = "0*([0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"

#: The base patterns and limits are the contract of the report.
KINDS = (
    Kind(
        "email",
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda m: F.lit(True),
        True,
        0.9,
        "mail|contact|write",
        0.1,
    ),
    Kind(
        "ip",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda m: m.rlike(rf"^{_OCTET}(\.{_OCTET}){{3}}$"),
        True,
        0.6,
        "ip|address|host|server",
        0.3,
    ),
    Kind(
        "card",
        r"[0-9]([\x20-]?[0-9])+",
        r"[0-9](?:[\x20-]?[0-9])++",
        _luhn,
        True,
        0.8,
        "card|visa|credit|payment",
        0.2,
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda m: F.length(_digits(m)).between(8, 15),
        True,
        0.7,
        "phone|tel|call|mobile|fax",
        0.2,
    ),
    Kind(
        "iban",
        r"[A-Z]{2}[0-9]{2}( ?[A-Z0-9]{4}){2,7}( ?[A-Z0-9]{1,3})?",
        r"[A-Z]{2}[0-9]{2}( ?[A-Z0-9]{4}){2,7}( ?[A-Z0-9]{1,3})?",
        _mod97,
        False,
        0.6,
        "iban|account|bank",
        0.3,
    ),
    Kind(
        "ssn",
        r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        lambda m: ~m.rlike("^(000|666|9)") & ~m.rlike("-00-|-0000$"),
        False,
        0.3,
        "ssn|social security",
        0.5,
    ),
    Kind(
        "tel",
        r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}",
        r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}",
        lambda m: F.lit(True),
        False,
        0.3,
        "phone|tel|call|mobile|fax",
        0.4,
    ),
)
BASE = tuple(k for k in KINDS if k.base)
ADDED = tuple(k for k in KINDS if not k.base)


def running_totals(lengths: Column) -> Column:
    """Running totals of an array, by blocks: a long array costs far less than its square."""

    def numbers(n: Column) -> Column:
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    def add(values: Column) -> Column:
        return F.aggregate(values, F.lit(0), lambda a, x: a + x)

    def totals(v: Column, size: Column) -> Column:
        blocks = F.ceil(F.size(v) / size).cast("int")
        sums = F.transform(numbers(blocks), lambda b: add(F.slice(v, b * size + 1, size)))

        def each(offsets: Column) -> Column:
            def upto(i: Column) -> Column:
                block = F.floor(i / size).cast("int")
                return F.element_at(offsets, block + 1) + add(F.slice(v, block * size + 1, i - block * size + 1))

            return F.transform(numbers(F.size(v)), upto)

        before = let(sums, lambda s: F.transform(numbers(F.size(s)), lambda b: add(F.slice(s, F.lit(1), b))))
        return let(before, each)

    return let(lengths, lambda v: let(F.ceil(F.sqrt(F.size(v) + 1)).cast("int"), lambda size: totals(v, size)))


def _around(kind: Kind, before: Column, after: Column) -> Column:
    """Context words within reach of a match, by its neighbouring parts."""
    near = F.concat_ws(" ", F.right(before, F.lit(CONTEXT_BEFORE)), F.left(after, F.lit(CONTEXT_AFTER)))
    return F.lower(near).rlike(f"(^|[^a-z])({kind.context})([^a-z]|$)")


def _judged(kind: Kind, parts: Column, matches: Column) -> Column:
    """``(match, score)`` of each match; a score of 0 is no finding."""

    def judge(match: Column, i: Column) -> Column:
        before, after = F.element_at(parts, i + 1), F.element_at(parts, i + 2)
        score = F.lit(kind.score) + F.when(_around(kind, before, after), kind.bonus).otherwise(0.0)
        good = kind.check(match)
        if not kind.base:
            good = good & ~before.rlike("[A-Za-z0-9-]$") & ~after.rlike("^[A-Za-z0-9-]")
            score = F.when(score >= ACCEPT, score).otherwise(0.0)
        return F.struct(match.alias("match"), F.when(good, score).otherwise(0.0).alias("score"))

    return F.transform(matches, judge)


SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"


def _found(text: Column, kind: Kind) -> Column:
    """Accepted spans of one kind in order; texts without a match cost one pass."""

    def places(parts: Column, judged: Column) -> Column:
        # Lengths of part, match, part, match, ...: each odd total is a start.
        lengths = F.flatten(
            F.transform(judged, lambda m, i: F.array(F.length(F.element_at(parts, i + 1)), F.length(m["match"])))
        )

        def spans(totals: Column) -> Column:
            return F.transform(
                judged,
                lambda m, i: F.struct(
                    F.lit(kind.name).alias("kind"),
                    F.element_at(totals, 2 * i + 1).alias("start"),
                    F.element_at(totals, 2 * i + 2).alias("end"),
                    m["score"].alias("score"),
                ),
            )

        return F.filter(let(running_totals(lengths), spans), lambda s: s["score"] > 0)

    def within(matches: Column) -> Column:
        def cut(parts: Column) -> Column:
            return let(
                _judged(kind, parts, matches),
                lambda j: F.when(F.exists(j, lambda m: m["score"] > 0), places(parts, j)).otherwise(F.array().cast(SPANS)),
            )

        return F.when(F.size(matches) > 0, let(F.split(text, kind.java, -1), cut)).otherwise(F.array().cast(SPANS))

    return let(F.regexp_extract_all(text, F.lit(kind.java), F.lit(0)), within).cast(SPANS)


def find(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` and a column ``found``: an array of spans for each kind.

    A null text is an empty one. Places are code points, ends are exclusive.
    """
    rows = docs.select(*keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    rows = rows.select(*keep, *(_found(F.col("_text"), k).alias(f"_{k.name}") for k in KINDS))
    base = F.concat(*(F.col(f"_{k.name}") for k in BASE))
    rows = rows.withColumn("_base", base)

    def apart(spans: Column) -> Column:
        hits = lambda s: F.exists("_base", lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"]))
        return F.filter(spans, lambda s: ~hits(s))

    added = F.concat(*(apart(F.col(f"_{k.name}")) for k in ADDED))
    counts = [F.size(f"_{k.name}").cast("long").alias(f"n_{k.name}") for k in BASE]
    return rows.select(*keep, *counts, F.col("_base").alias("base"), added.alias("added"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, counts of the base kinds, a digest of the base
    spans, all spans, and the least score among them (null without spans).

    Only ``doc_id`` and ``text`` are read; repeated rows and null ids are reported one by one.
    """
    rows = find(docs.select("doc_id", "text"), ["doc_id"])
    every = F.concat("base", "added")
    return rows.select(
        "doc_id",
        *(f"n_{k.name}" for k in BASE),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(every).alias("spans"),
        F.array_min(F.transform(every, lambda s: F.round(s["score"], 3))).alias("least_score"),
    )


def _cut(text: Column, spans: Column) -> Column:
    """The text with the name of its kind in place of each span; spans that overlap are one, named by the first."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].cast("int").alias("a"), s["end"].cast("int").alias("z"), s["kind"].alias("kind"))))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(done: Column, s: Column) -> Column:
        between = F.substring(text, done["at"] + 1, s["a"] - done["at"])
        name = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        more = F.when(s["a"] >= done["at"], F.concat(done["parts"], F.array(between, name))).otherwise(done["parts"])
        return F.struct(F.greatest(done["at"], s["z"]).alias("at"), more.alias("parts"))

    def finish(done: Column) -> Column:
        return F.concat(F.array_join(done["parts"], ""), F.substring(text, done["at"] + 1, F.length(text)))

    return F.aggregate(ordered, zero, step, finish)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with the spans of ``find`` replaced by their kind, as in ``[EMAIL]``.

    Rows and columns stay, whatever their names; a null text stays null, and
    ``n_chars``, if there, follows a text that changed.
    """
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("text"))
    rows = find(packed, ["_row"]).withColumn("_spans", F.concat("base", "added"))
    text = F.col("_row.text").cast("string")
    new = F.when(F.size("_spans") > 0, _cut(text, F.col("_spans"))).otherwise(text)
    rows = rows.withColumn("_new", new)
    out = []
    for c in docs.columns:
        old = F.col("_row")[c]
        if c == "text":
            old = F.col("_new")
        elif c == "n_chars":
            old = F.when(F.size("_spans") > 0, F.length("_new").cast(docs.schema[c].dataType)).otherwise(old)
        out.append(old.alias(c))
    return rows.select(*out)
