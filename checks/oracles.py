"""DuckDB statements that recompute the registered queries independently.

They start from the same derived tables as the queries; everything after that
is plain SQL over all rows, neighbours by comparing every pair.
"""

from __future__ import annotations

from cellsift.plans.tables import (
    GIVEN_SCORE, LABEL_SQL, LINES_SQL, PART_LABEL, PART_TYPES, PRIORITIES, RAW_SQL, TRANSACTIONS_SQL, TYPO_SQL,
)


def _duck(sql: str) -> str:
    for name in ("orders", "lineitem", "customer", "nation", "part", "tx", "raw"):
        sql = sql.replace("{" + name + "}", name)
    return sql.replace("AS string)", "AS varchar)").strip()


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


_BYTE = (
    "((instr('0123456789abcdef', substr(h, 1, 1)) - 1) * 16"
    " + instr('0123456789abcdef', substr(h, 2, 1)) - 1)"
)
_COLUMNS = (
    "transaction_id", "date", "domain", "location", "value", "transaction_count", "avg_transaction_value",
)

_SEEDED = f"""
ranked AS (
  SELECT tx.*, row_number() OVER (ORDER BY md5('42:' || transaction_id)) AS rk,
         count(*) OVER () AS n, md5('col:42:' || transaction_id) AS h FROM tx),
parts AS (
  SELECT transaction_id, ntile(3) OVER (ORDER BY rk) AS part FROM ranked WHERE rk <= floor(0.2 * n)),
picked AS (
  SELECT ranked.*, part, CASE part WHEN 1 THEN {_BYTE} % 4 WHEN 2 THEN {_BYTE} % 3 WHEN 3 THEN {_BYTE} % 2 END AS pick
  FROM ranked LEFT JOIN parts USING (transaction_id)),
faults AS (
  SELECT *, CASE
    WHEN part = 1 THEN (CASE pick WHEN 0 THEN 'domain' WHEN 1 THEN 'location' WHEN 2 THEN 'value' ELSE 'transaction_count' END)
    WHEN part = 2 THEN (CASE pick WHEN 0 THEN 'domain' WHEN 1 THEN 'value' ELSE 'transaction_count' END)
    WHEN part = 3 THEN (CASE pick WHEN 0 THEN 'value' ELSE 'transaction_count' END) END AS hit
  FROM picked),
seeded AS (
  SELECT transaction_id, date,
    CASE WHEN hit = 'domain' THEN (CASE part WHEN 1 THEN NULL ELSE 'UNKNOWN_DOMAIN' END) ELSE domain END AS domain,
    CASE WHEN hit = 'location' THEN NULL ELSE location END AS location,
    CASE WHEN hit = 'value' THEN (CASE part WHEN 1 THEN NULL WHEN 2 THEN -999 ELSE value * 10 END) ELSE value END AS value,
    CASE WHEN hit = 'transaction_count' THEN (CASE part WHEN 1 THEN NULL WHEN 2 THEN -10 ELSE transaction_count * 1000 END)
         ELSE transaction_count END AS transaction_count,
    avg_transaction_value
  FROM faults),
labels_tx AS (
  SELECT transaction_id AS row_id, hit AS column_name,
    CASE part WHEN 1 THEN 'missing' WHEN 2 THEN 'invalid' ELSE 'anomaly' END AS issue_type,
    CASE hit WHEN 'value' THEN value WHEN 'transaction_count' THEN transaction_count END AS original_num,
    CASE WHEN part = 2 THEN (CASE hit WHEN 'value' THEN -999.0 WHEN 'transaction_count' THEN -10.0 END)
         WHEN part = 3 THEN (CASE hit WHEN 'value' THEN value * 10 ELSE transaction_count * 1000 END) END AS dirty_num
  FROM faults WHERE part IS NOT NULL),
dirty AS (
  SELECT transaction_id, date, domain, location, value, transaction_count,
         value / nullif(transaction_count, 0) AS avg_transaction_value FROM seeded)
"""

_SCORE = {"low": 0.1, "medium": 0.4, "high": 0.7, "critical": 1.0}


def _missing(table: str, row_id: str, column: str, severity: str, score: float | None = None) -> str:
    score = (0.7 if severity == "high" else 0.4) if score is None else score
    return (
        f"SELECT cast({row_id} AS varchar) AS row_id, '{column}' AS column_name, 'missing' AS issue_type, "
        f"'{severity}' AS severity, cast({score} AS double) AS severity_score, "
        f"'Required column ''{column}'' is missing.' AS reason, 'rule_missing_detector' AS source_method, "
        f"1.0::double AS confidence, true AS can_auto_fix, NULL::double AS current_num, NULL::varchar AS current_value "
        f"FROM {table} WHERE {column} IS NULL"
    )


def _invalid(
    table: str, row_id: str, column: str, where: str, reason: str, severity: str = "high",
    number: bool = True, score: float | None = None, method: str = "rule_invalid_detector",
) -> str:
    score = _SCORE[severity] if score is None else score
    reason = reason.replace("'", "''")
    current = f"cast({column} AS double)" if number else "NULL::double"
    text = "NULL::varchar" if number else column
    return (
        f"SELECT cast({row_id} AS varchar) AS row_id, '{column}' AS column_name, 'invalid' AS issue_type, "
        f"'{severity}' AS severity, cast({score} AS double) AS severity_score, '{reason}' AS reason, "
        f"'{method}' AS source_method, 1.0::double AS confidence, true AS can_auto_fix, "
        f"{current} AS current_num, {text} AS current_value FROM {table} WHERE {where}"
    )


def _cross(table: str) -> str:
    return _invalid(
        table, "transaction_id", "transaction_count", "transaction_count = 0 AND value > 0",
        "transaction_count is 0 while value is greater than 0.", score=0.8, method="cross_field_rule",
    )


_SEVERITIES = {
    "transaction_id": "medium", "date": "high", "domain": "medium", "location": "medium",
    "value": "high", "transaction_count": "high",
}
_MISSING = "\nUNION ALL ".join(_missing("dirty", "transaction_id", c, s) for c, s in _SEVERITIES.items())
_ALLOWED = f"Value is not in allowed values: {list(PRIORITIES)}."
_BELOW = "Value is smaller than minimum allowed: 0."
_INVALID = "\nUNION ALL ".join(
    [_invalid("dirty", "transaction_id", "domain", f"domain NOT IN {_in(PRIORITIES)}", _ALLOWED, "medium", number=False)]
    + [
        _invalid("dirty", "transaction_id", c, f"{c} < 0", _BELOW)
        for c in ("value", "transaction_count", "avg_transaction_value")
    ]
)
_CLEAN = f"""
issues AS ({_MISSING} UNION ALL {_INVALID} UNION ALL {_cross('dirty')}),
clean AS (SELECT * FROM dirty WHERE transaction_id NOT IN (SELECT row_id FROM issues))
"""

_NUMBERS = ("value", "transaction_count", "avg_transaction_value")
_TEXTS = ("domain", "location")
_STATS = (
    "meds AS (SELECT " + ", ".join(f"median({c}) AS med_{c}" for c in _NUMBERS) + ",\n"
    + ", ".join(
        f"(SELECT {c} FROM clean WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS mode_{c}"
        for c in _TEXTS
    )
    + " FROM clean),\nstats AS (SELECT any_value(meds) AS m, "
    + ", ".join(
        f"avg(coalesce({c}, med_{c})) AS avg_{c}, stddev_pop(coalesce({c}, med_{c})) AS std_{c}" for c in _NUMBERS
    )
    + " FROM clean, meds)"
)


def _features(table: str, name: str) -> str:
    z = ", ".join(
        f"(coalesce(t.{c}, m.med_{c}) - avg_{c}) / (CASE WHEN std_{c} = 0 THEN 1 ELSE std_{c} END) AS z__{c}"
        for c in _NUMBERS
    )
    x = ", ".join(f"coalesce(t.{c}, m.mode_{c}) AS c__{c}" for c in _TEXTS)
    return f"{name} AS (SELECT t.*, {z}, {x} FROM {table} AS t, stats)"


def _known(query_table: str) -> str:
    """Query features with null for categories that the clean rows do not have."""
    changes = ", ".join(
        f"CASE WHEN c__{c} IN (SELECT c__{c} FROM clean_f) THEN c__{c} END AS c__{c}" for c in _TEXTS
    )
    return f"known_q AS (SELECT * REPLACE ({changes}) FROM {query_table})"


# An unknown category is 1 away from every other one, two known ones 2.
def _pairs(numbers, texts, exclude_self: bool, k: int = 5, payload=()) -> str:
    parts = [f"(q.z__{c} - r.z__{c}) * (q.z__{c} - r.z__{c})" for c in numbers]
    parts += [
        f"(CASE WHEN q.c__{c} IS NULL THEN 1.0::double WHEN q.c__{c} = r.c__{c} THEN 0.0::double ELSE 2.0::double END)"
        for c in texts
    ]
    dist = "round(" + " + ".join(parts) + ", 9)"
    other = "WHERE q.transaction_id <> r.transaction_id" if exclude_self else ""
    return f"""
best AS (SELECT q.transaction_id AS row_id, min({{'d': {dist}, 'k': r.transaction_id}}, {k}) AS near
         FROM known_q AS q, clean_f AS r {other} GROUP BY q.transaction_id),
pairs AS (SELECT row_id, unnest(near) AS n, generate_subscripts(near, 1) AS place FROM best)"""


_KNN_BASE = [_STATS, _features("clean", "clean_f")]
_GAPS = "gaps AS (SELECT * FROM dirty WHERE transaction_id IN (SELECT row_id FROM issues WHERE issue_type = 'missing'))"
_PAIR_ROWS = "SELECT row_id, cast(place AS integer) AS place, n.k AS neighbour_id, round(n.d, 6) AS dist2 FROM pairs"


def _with(*ctes: str) -> str:
    base = [f"tx AS ({_duck(TRANSACTIONS_SQL)})", _SEEDED.strip(), _CLEAN.strip()]
    return "WITH " + ",\n".join([*base, *(c.strip() for c in ctes)]) + "\n"


_RAW = f"raw AS ({_duck(RAW_SQL)})"
_TYPO = f"typo AS ({_duck(TYPO_SQL)})"
_WS = r"[\s\x{1c}-\x{1f}\x{a0}]"
_VIEW = (
    "row_id, column_name, issue_type, severity, severity_score, reason, source_method, confidence, can_auto_fix"
)
_NUMBER = r"\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*"
_DATE_OK = r"regexp_full_match(DATE, '\d{4}-(0[1-9]|1[0-2])-\d{2}')"
_RAW_COLUMNS = ("DATE", "DOMAIN", "LOCATION", "VALUE", "TRANSACTION_COUNT")


def _blank_null(c: str) -> str:
    return f"CASE WHEN NOT regexp_full_match({c}, '{_WS}*') THEN {c} END"


def _number(c: str) -> str:
    return f"CASE WHEN regexp_full_match({c}, '{_NUMBER}') THEN cast(trim({c}) AS double) END"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^{_WS}+|{_WS}+$', '', 'g')"


def _profile() -> str:
    rows = []
    for c in _COLUMNS:
        lo, hi = (f"min({c})", f"max({c})") if c in _NUMBERS else ("NULL::double", "NULL::double")
        count = lambda cond, c=c: f"(SELECT count(*) FROM issues WHERE column_name = '{c}'{cond})"
        rows.append(
            f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count, "
            f"round((count(*) - count({c})) / count(*), 4) AS missing_rate, count(DISTINCT {c}) AS unique_count, "
            f"{lo} AS min, {hi} AS max, {count('')} AS issue_count, "
            f"{count(_TYPE.format('anomaly'))} AS anomaly_count, {count(_TYPE.format('invalid'))} AS invalid_count FROM dirty"
        )
    return " UNION ALL ".join(rows)


_TYPE = " AND issue_type = '{}'"

_SUMMARY = """
SELECT 'total_issues' AS metric, count(*)::double AS value FROM issues
UNION ALL SELECT 'issue_type_' || issue_type, count(*) FROM issues GROUP BY issue_type
UNION ALL SELECT 'severity_' || severity, count(*) FROM issues GROUP BY severity
UNION ALL SELECT 'average_confidence', round(avg(confidence), 4) FROM issues
UNION ALL SELECT 'fixable_rate', round(avg(can_auto_fix::int), 4) FROM issues
"""

_RATES = (
    "CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS p, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS r"
)
_EVALUATION = f"""
, merged AS (
  SELECT coalesce(l.issue_type, i.issue_type) AS issue_type, l.row_id IS NOT NULL AS t, i.row_id IS NOT NULL AS d
  FROM (SELECT DISTINCT row_id, column_name, issue_type FROM labels_tx) AS l
  FULL OUTER JOIN (SELECT DISTINCT row_id, column_name, issue_type FROM issues) AS i
  ON l.row_id = i.row_id AND l.column_name = i.column_name AND l.issue_type = i.issue_type),
counts AS (
  SELECT issue_type, count(*) FILTER (t AND d) AS tp, count(*) FILTER (d AND NOT t) AS fp, count(*) FILTER (t AND NOT d) AS fn
  FROM merged GROUP BY ROLLUP (issue_type)),
rates AS (SELECT *, {_RATES} FROM counts),
full_rates AS (SELECT *, CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END AS f FROM rates)
SELECT CASE WHEN issue_type IS NULL THEN u.overall ELSE issue_type || '_' || u.typed END AS metric, u.v AS value
FROM (SELECT issue_type, unnest([
  {{'overall': 'true_positive', 'typed': 'tp', 'v': tp::double}},
  {{'overall': 'false_positive', 'typed': 'fp', 'v': fp::double}},
  {{'overall': 'false_negative', 'typed': 'fn', 'v': fn::double}},
  {{'overall': 'precision', 'typed': 'precision', 'v': round(p, 4)}},
  {{'overall': 'recall', 'typed': 'recall', 'v': round(r, 4)}},
  {{'overall': 'f1_score', 'typed': 'f1_score', 'v': round(f, 4)}}]) AS u FROM full_rates)
"""

_NO_DERIVED = "\nUNION ALL ".join(
    [_missing("dirty", "transaction_id", c, s, _SCORE[s]) for c, s in _SEVERITIES.items()]
    + [_invalid("dirty", "transaction_id", "domain", f"domain NOT IN {_in(PRIORITIES)}", _ALLOWED, "medium", number=False)]
    + [_invalid("dirty", "transaction_id", c, f"{c} < 0", _BELOW) for c in ("value", "transaction_count")]
    + [
        _invalid(
            "dirty", "transaction_id", "avg_transaction_value",
            "avg_transaction_value < 0 AND coalesce(value, -1) >= 0 AND coalesce(transaction_count, -1) >= 0"
            " AND NOT (transaction_count = 0 AND value > 0)", _BELOW,
        ),
        _cross("dirty"),
    ]
)

# Suggestions for invalid cells: numbers are clipped to 0, no category comes
# close to an allowed one.
_FIXES = f"""
fixes AS (
  SELECT row_id, column_name, source_method, reason, severity, can_auto_fix, issue_type,
    CASE WHEN column_name = 'domain' THEN '{PRIORITIES[0]}' WHEN current_num < 0 THEN '0' END AS suggested_value,
    CASE WHEN column_name <> 'domain' AND current_num < 0 THEN 0.0::double END AS suggested_num,
    CASE WHEN column_name = 'domain' THEN 0.5::double WHEN current_num < 0 THEN 1.0::double ELSE 0.0::double END AS confidence
  FROM issues WHERE issue_type = 'invalid')
"""


def _fixed(where: str) -> str:
    def cell(c: str) -> str:
        fix = f"EXISTS (SELECT 1 FROM fixes WHERE row_id = transaction_id AND column_name = '{c}' AND suggested_value IS NOT NULL AND {where})"
        if c == "domain":
            return f"CASE WHEN {fix} THEN '{PRIORITIES[0]}' ELSE domain END AS domain"
        return f"CASE WHEN {fix} THEN 0.0::double ELSE {c} END AS {c}"

    return _with(_FIXES) + (
        f"SELECT transaction_id, date, {cell('domain')}, location, {cell('value')}, "
        f"{cell('transaction_count')}, {cell('avg_transaction_value')} FROM dirty"
    )


_EVENT_ALLOWED = ["click", "view", "purchase", "signup"]
_PART_REASON = f"Value is not in allowed values: {list(PART_TYPES)}."

_LEVENSHTEIN = f"""
, invalid AS (SELECT part_id AS row_id, kind AS current_value FROM typo WHERE kind NOT IN {_in(PART_TYPES)}),
options AS (SELECT unnest({list(PART_TYPES)}) AS allowed),
scored AS (
  SELECT row_id, current_value, allowed,
    round(1 - levenshtein(current_value, allowed) / greatest(length(current_value), length(allowed)), 4) AS ratio
  FROM invalid, options),
top AS (SELECT row_id, any_value(current_value) AS current_value, max({{'ratio': ratio, 'allowed': allowed}}) AS b
        FROM scored GROUP BY row_id)
SELECT row_id, current_value, CASE WHEN b.ratio >= 0.6 THEN b.allowed ELSE '{PART_TYPES[0]}' END AS suggested_value,
  CASE WHEN b.ratio >= 0.6 THEN b.ratio ELSE 0.5 END::double AS confidence FROM top
"""


_LARGE_LIST = f"""
WITH labels AS ({_duck(LABEL_SQL)}),
entries AS (SELECT DISTINCT {_duck(PART_LABEL)} AS entry FROM part),
invalid AS (SELECT DISTINCT label FROM labels WHERE label NOT IN (SELECT entry FROM entries)),
scored AS (
  SELECT label, entry, round(1 - levenshtein(label, entry) / greatest(length(label), length(entry)), 4) AS ratio FROM invalid, entries),
top AS (SELECT label, max({{'ratio': ratio, 'entry': entry}}) AS b FROM scored GROUP BY label)
SELECT row_id, label AS current_value, CASE WHEN b.ratio >= 0.6 THEN b.entry ELSE (SELECT min(entry) FROM entries) END AS suggested_value,
  CASE WHEN b.ratio >= 0.6 THEN b.ratio ELSE 0.5 END::double AS confidence FROM labels JOIN top USING (label)
"""


def _suspects(query_table: str, exclude_self: bool) -> str:
    values = ", ".join(f"c.{x} AS n_{x}" for x in (*_NUMBERS, *_TEXTS))
    numeric = " UNION ALL ".join(
        f"""SELECT row_id, '{c}' AS column_name FROM judged WHERE cur_{c} IS NULL OR (cnt_{c} >= 2 AND
        CASE WHEN lo_{c} = hi_{c} THEN cur_{c} <> lo_{c} ELSE abs((cur_{c} - mean_{c}) / std_{c}) >= 2.5 END)"""
        for c in _NUMBERS
    )
    texts = " UNION ALL ".join(
        f"SELECT row_id, '{c}' AS column_name FROM judged WHERE cur_{c} IS NULL OR cur_{c} <> mode_{c}" for c in _TEXTS
    )
    aggregates = ", ".join(
        f"count(n_{c}) AS cnt_{c}, min(n_{c}) AS lo_{c}, max(n_{c}) AS hi_{c}, avg(n_{c}) AS mean_{c}, stddev_pop(n_{c}) AS std_{c}"
        for c in _NUMBERS
    )
    # Most frequent neighbour value, the smallest of several.
    modes = ", ".join(
        f"list_sort(list_transform(list_distinct(list(n_{c})), lambda x:"
        f" {{'neg': -len(list_filter(list(n_{c}), lambda y: y = x)), 'v': x}}))[1].v AS mode_{c}"
        for c in _TEXTS
    )
    current = ", ".join(f"any_value(q.{c}) AS cur_{c}" for c in (*_NUMBERS, *_TEXTS))
    return (
        _with(*_KNN_BASE, _GAPS, _features(query_table, "q_f"), _known("q_f"),
              _pairs(_NUMBERS, _TEXTS, exclude_self))
        + f""", near AS (SELECT row_id, {values} FROM pairs JOIN clean AS c ON c.transaction_id = n.k),
        judged AS (SELECT near.row_id, {aggregates}, {modes}, {current}
                   FROM near JOIN {query_table} AS q ON q.transaction_id = near.row_id GROUP BY near.row_id)
        {numeric} UNION ALL {texts}"""
    )


def _neighbour_suggestions() -> str:
    numeric = " UNION ALL ".join(
        f"""SELECT row_id, '{c}' AS column_name, round(median(n_{c}), 2) AS suggested_num, NULL::varchar AS suggested_text,
        CASE WHEN avg(n_{c}) = 0 THEN 0.5 ELSE round(1 / (1 + stddev_pop(n_{c}) / abs(avg(n_{c}))), 4) END AS confidence
        FROM near WHERE row_id IN (SELECT row_id FROM issues WHERE issue_type = 'missing' AND column_name = '{c}') GROUP BY row_id"""
        for c in ("value", "transaction_count")
    )
    texts = " UNION ALL ".join(
        f"""SELECT row_id, '{c}' AS column_name, NULL::double AS suggested_num, v AS suggested_text, round(share, 4) AS confidence
        FROM (SELECT row_id, n_{c} AS v, count(*) / sum(count(*)) OVER (PARTITION BY row_id) AS share,
                row_number() OVER (PARTITION BY row_id ORDER BY count(*) DESC, n_{c}) AS place
              FROM near WHERE row_id IN (SELECT row_id FROM issues WHERE issue_type = 'missing' AND column_name = '{c}')
              GROUP BY row_id, n_{c}) WHERE place = 1"""
        for c in _TEXTS
    )
    values = ", ".join(f"c.{x} AS n_{x}" for x in (*_NUMBERS, *_TEXTS))
    return (
        _with(*_KNN_BASE, _GAPS, _features("gaps", "q_f"), _known("q_f"), _pairs(_NUMBERS, _TEXTS, False))
        + f", near AS (SELECT row_id, {values} FROM pairs JOIN clean AS c ON c.transaction_id = n.k)\n{numeric} UNION ALL {texts}"
    )


# Whole runs on given scores. One row per wanted row and column: the cell, whether
# it stands out from the neighbours, and what they suggest.
def _run(exclude_self: bool = True, left_out: bool = False) -> str:
    values = ", ".join(f"c.{x} AS n_{x}" for x in (*_NUMBERS, *_TEXTS))
    numeric = ", ".join(
        f"min(n_{c}) AS lo_{c}, max(n_{c}) AS hi_{c}, avg(n_{c}) AS mean_{c}, stddev_pop(n_{c}) AS std_{c}, "
        f"count(n_{c}) AS cnt_{c}, median(n_{c}) AS med_{c}"
        for c in _NUMBERS
    )
    modes = ", ".join(
        f"list(n_{c}) AS l_{c}, list_sort(list_transform(list_distinct(list(n_{c})), lambda x:"
        f" {{'neg': -len(list_filter(list(n_{c}), lambda y: y = x)), 'v': x}}))[1].v AS mode_{c}"
        for c in _TEXTS
    )
    current = ", ".join(f"any_value(q.{c}) AS cur_{c}" for c in (*_NUMBERS, *_TEXTS))

    def odd(c: str) -> str:
        if c in _TEXTS:
            return f"cur_{c} IS NULL OR coalesce(cur_{c} <> mode_{c}, false)"
        far = f"CASE WHEN lo_{c} = hi_{c} THEN cur_{c} <> lo_{c} ELSE abs((cur_{c} - mean_{c}) / std_{c}) >= 2.5 END"
        return f"cur_{c} IS NULL OR (cnt_{c} >= 2 AND coalesce({far}, false))"

    def judged(near: str, name: str) -> str:
        return (
            f"{name}_values AS (SELECT row_id, {values} FROM {near} JOIN clean AS c ON c.transaction_id = n.k),\n"
            f"{name} AS (SELECT row_id, {numeric}, {modes}, {current} FROM {name}_values "
            f"JOIN wanted AS q ON q.transaction_id = row_id GROUP BY row_id)"
        )

    cells = [
        f"SELECT row_id, '{c}' AS column_name, cur_{c}::double AS current_num, NULL::varchar AS current_text, "
        f"round(med_{c}::varchar::decimal(38, 15), 2)::double AS num, NULL::varchar AS text, CASE WHEN mean_{c} = 0 THEN 0.5 "
        f"WHEN lo_{c} = hi_{c} THEN 1.0 ELSE round(1 / (1 + std_{c} / abs(mean_{c})), 4) END::double AS sure, {odd(c)} AS odd FROM judged"
        for c in _NUMBERS
    ] + [
        f"SELECT row_id, '{c}', NULL, cur_{c}, NULL, mode_{c}, "
        f"round(len(list_filter(l_{c}, lambda y: y = mode_{c})) / len(l_{c}), 4), {odd(c)} FROM judged"
        for c in _TEXTS
    ]
    odd_cells = "odd_cells AS (SELECT row_id, column_name FROM cells WHERE odd)"
    searches: list[str] = [_pairs(_NUMBERS, _TEXTS, exclude_self)]
    if left_out:
        # One search per column, without it, and without those it is computed from or with.
        found = []
        for c in (*_NUMBERS, *_TEXTS):
            gone = {
                "value": ("value", "avg_transaction_value"),
                "transaction_count": ("transaction_count", "avg_transaction_value"),
                "avg_transaction_value": _NUMBERS,
            }.get(c, (c,))
            own = _pairs([x for x in _NUMBERS if x not in gone], [x for x in _TEXTS if x not in gone], True)
            searches.append(own.replace("best", f"best_{c}").replace("pairs AS", f"pairs_{c} AS"))
            searches.append(judged(f"pairs_{c}", f"judged_{c}"))
            found.append(f"SELECT row_id, '{c}' AS column_name FROM judged_{c} WHERE {odd(c)}")
        odd_cells = "odd_cells AS (" + " UNION ALL ".join(found) + ")"
    score = "CASE WHEN num IS NULL THEN 0.5 ELSE abs(current_num - num) / (abs(num) + 1) END"
    return _with(
        *_KNN_BASE,
        f"scored AS (SELECT transaction_id AS row_id, {GIVEN_SCORE} - (SELECT quantile_cont({GIVEN_SCORE}, 0.08) FROM clean) AS d FROM dirty)",
        "wanted AS (SELECT * FROM dirty WHERE transaction_id IN (SELECT row_id FROM scored WHERE d < 0) "
        "OR transaction_id IN (SELECT row_id FROM issues WHERE issue_type = 'missing'))",
        _features("wanted", "q_f"), _known("q_f"), *searches, judged("pairs", "judged"),
        "cells AS (" + " UNION ALL ".join(cells) + ")", odd_cells, _FIXES,
        f"""
rated AS (SELECT *, {score} AS score FROM cells JOIN odd_cells USING (row_id, column_name) JOIN scored USING (row_id) WHERE d < 0),
found AS (
  SELECT i.row_id, i.column_name, i.issue_type, i.severity, i.severity_score, i.reason, i.source_method, sure AS confidence, true AS can_auto_fix,
    NULL::double AS current_num, NULL::varchar AS current_text, num AS suggested_num, text AS suggested_text, 1 AS stage
  FROM issues AS i JOIN cells USING (row_id, column_name) WHERE i.issue_type = 'missing'
  UNION ALL
  SELECT i.row_id, i.column_name, i.issue_type, i.severity, i.severity_score, i.reason, i.source_method, f.confidence, true,
    i.current_num, i.current_value, f.suggested_num, CASE WHEN f.suggested_num IS NULL THEN f.suggested_value END,
    CASE WHEN i.source_method = 'cross_field_rule' THEN 3 ELSE 2 END
  FROM issues AS i JOIN fixes AS f ON f.row_id = i.row_id AND f.column_name = i.column_name AND f.reason = i.reason
  WHERE i.issue_type = 'invalid'
  UNION ALL
  SELECT row_id, column_name, 'anomaly', CASE WHEN score >= 1 THEN 'critical' WHEN score >= 0.5 THEN 'high' WHEN score >= 0.2 THEN 'medium' ELSE 'low' END,
    score, 'Column ''' || column_name || ''' deviates from similar normal records.', 'isolation_forest+feature_contribution',
    least(sure, round(least(1.0, abs(d) * 5), 4)), true, current_num, current_text, num, text, 4
  FROM rated)""",
    )


_RUN_VIEW = (
    "SELECT row_id, column_name, issue_type, severity, round(severity_score, 6) AS severity_score, reason, source_method, "
    "confidence, can_auto_fix, current_num, suggested_num, suggested_text FROM found"
)


def _run_fixed(where: str) -> str:
    """The last accepted suggestion of each cell, written into its row."""
    last = (
        "last AS (SELECT row_id, column_name, arg_max(suggested_num, stage) AS num, arg_max(suggested_text, stage) AS text "
        f"FROM found WHERE (suggested_num IS NOT NULL OR suggested_text IS NOT NULL) AND {where} GROUP BY row_id, column_name)"
    )
    new = {c: f"(SELECT {'text' if c in _TEXTS else 'num'} FROM last WHERE row_id = transaction_id AND column_name = '{c}')"
           for c in (*_TEXTS, *_NUMBERS)}
    changed = ", ".join(f"coalesce({v}, {c}) AS {c}" for c, v in new.items())
    return f"{_run().rstrip()}, {last} SELECT transaction_id, date, {changed} FROM dirty"


def _issue_order() -> str:
    # The key of an issue is JSON without null entries.
    place = " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(("transaction_id", "date", *_TEXTS, *_NUMBERS)))
    shown = "coalesce(current_text, current_num::varchar)"
    return _run() + (
        f"SELECT row_id, column_name, issue_type, {shown} AS current_value, md5('{{\"row_id\":\"' || row_id || "
        f"'\",\"column_name\":\"' || column_name || '\"' || coalesce(',\"current_value\":\"' || {shown} || '\"', '') || "
        "',\"issue_type\":\"' || issue_type || '\",\"source_method\":\"' || source_method || '\",\"reason\":\"' || reason || '\"}') AS issue_id, "
        f"row_number() OVER (PARTITION BY row_id ORDER BY stage, CASE column_name {place} END)::integer AS place FROM found"
    )


_NA = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

_LINES_BAD = "l_quantity < 3 OR l_quantity > 48 OR l_returnflag NOT IN ('A', 'N')"


def _recommended() -> str:
    return (
        _run() + "SELECT row_id, column_name, issue_type, coalesce(suggested_text, "
        "CASE WHEN issue_type <> 'invalid' THEN suggested_num::varchar WHEN suggested_num = 0 THEN '0' END) AS suggested_value, "
        "confidence, severity, reason, can_auto_fix FROM found"
    )


def statements() -> dict[str, str]:
    raw = _with(_RAW)
    typo = f"WITH {_TYPO}"
    return {
        "csv_roundtrip": raw + "SELECT transaction_id, "
        + ", ".join(f"CASE WHEN {c} NOT IN {_in(_NA)} THEN {c} END AS {c}" for c in _RAW_COLUMNS) + " FROM raw",
        "csv_quarantine": _with(_RAW, f"lines AS ({_duck(LINES_SQL)})") + "SELECT "
        + ", ".join(
            f"CASE WHEN reason IS NULL AND {c} NOT IN {_in(_NA)} THEN {c} END AS {c}" for c in ("transaction_id", *_RAW_COLUMNS)
        ) + ", CASE WHEN reason IS NOT NULL THEN record END AS record, reason FROM lines",
        "format_convert": "SELECT * FROM orders",
        "blank_to_null": raw + "SELECT transaction_id, "
        + ", ".join(f"{_blank_null(c)} AS {c}" for c in _RAW_COLUMNS) + " FROM raw",
        "numeric_coerce": raw + f"SELECT transaction_id, {_number('VALUE')} AS value, "
        f"{_number('TRANSACTION_COUNT')} AS transaction_count FROM raw",
        "canonicalize_category": raw + "SELECT transaction_id, CASE WHEN d = 'RESTRAUNT' THEN 'RESTAURANT' ELSE d END AS domain, "
        f"location FROM (SELECT transaction_id, upper({_strip('DOMAIN')}) AS d, {_strip('LOCATION')} AS location FROM raw)",
        "date_parse_parts": raw + "SELECT transaction_id, date, cast(year(date) AS integer) AS year, "
        "cast(month(date) AS integer) AS month, cast(day(date) AS integer) AS day, "
        "cast(isodow(date) - 1 AS integer) AS day_of_week FROM "
        f"(SELECT transaction_id, CASE WHEN {_DATE_OK} THEN cast(DATE AS timestamp) END AS date FROM raw)",
        "ratio_feature": raw + "SELECT transaction_id, value, n AS transaction_count, value / nullif(n, 0) AS avg_transaction_value "
        f"FROM (SELECT transaction_id, {_number('VALUE')} AS value, {_number('TRANSACTION_COUNT')} AS n FROM raw)",
        "surrogate_key": "SELECT 'T' || lpad(cast(row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS varchar), 8, '0') "
        "AS transaction_id, o_orderkey, o_custkey, o_totalprice FROM orders",
        "missing_issues": _with() + f"SELECT {_VIEW} FROM issues WHERE issue_type = 'missing'",
        "invalid_type_issues": raw + ", found AS ("
        + _invalid("raw", "transaction_id", "date", f"DATE IS NOT NULL AND NOT {_DATE_OK}", "Column 'date' has invalid date format.", number=False)
        + " UNION ALL "
        + _invalid("raw", "transaction_id", "value", f"({_number('VALUE')}) IS NULL", "Column 'value' must be numeric.", number=False)
        + " UNION ALL "
        + _invalid("raw", "transaction_id", "value", f"({_number('VALUE')}) < 0", _BELOW, number=False)
        + " UNION ALL "
        + _invalid("raw", "transaction_id", "domain", f"DOMAIN NOT IN {_in(PRIORITIES)}", _ALLOWED, "medium", number=False)
        + f") SELECT {_VIEW}, current_value FROM found",
        "invalid_min_issues": "SELECT * EXCLUDE (current_value) FROM ("
        + _invalid("(SELECT 'A' || c_custkey AS account_id, c_acctbal AS balance FROM customer)", "account_id", "balance", "balance < 0", _BELOW)
        + " UNION ALL "
        + _invalid("(SELECT 'A' || c_custkey AS account_id, c_acctbal AS balance FROM customer)", "account_id", "balance", "balance > 9000",
                   "Value is larger than maximum allowed: 9000.") + ")",
        "invalid_max_and_category_issues": "SELECT * EXCLUDE (current_value) FROM ("
        + _invalid("events", "event_id", "value", "value > 150", "Value is larger than maximum allowed: 150.") + " UNION ALL "
        + _invalid("events", "event_id", "event_type", f"event_type NOT IN {_in(_EVENT_ALLOWED)}",
                   f"Value is not in allowed values: {_EVENT_ALLOWED}.", number=False) + ")",
        "invalid_category_issues": typo + f" SELECT {_VIEW}, current_value FROM ("
        + _invalid("typo", "part_id", "kind", f"kind NOT IN {_in(PART_TYPES)}", _PART_REASON, number=False) + ")",
        "cross_field_issues": _with() + f"SELECT {_VIEW}, current_num FROM ({_cross('tx')})",
        "all_rule_issues": _with() + f"SELECT {_VIEW}, current_num FROM issues",
        "derived_findings_skipped": _with() + f"SELECT {_VIEW} FROM ({_NO_DERIVED})",
        "clean_rows": _with() + "SELECT * FROM clean",
        "clean_rows_shared_ids": "SELECT l_orderkey, count(*) AS lines, sum(l_quantity) AS quantity FROM lineitem "
        f"WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE {_LINES_BAD}) GROUP BY l_orderkey",
        "issue_summary": _with() + _SUMMARY,
        "recommendations_view": _with(_FIXES)
        + "SELECT row_id, column_name, issue_type, suggested_value, confidence, severity, reason, can_auto_fix FROM fixes",
        "column_profile": _with() + _profile(),
        "exact_sample": "SELECT * FROM orders ORDER BY md5('42:' || o_orderkey) LIMIT 10000",
        "seed_dirty_rows": _with() + "SELECT * FROM seeded",
        "seed_labels": _with() + "SELECT * FROM labels_tx",
        "evaluation_report": _with() + _EVALUATION,
        "eval_prediction": f"""
            WITH m AS (SELECT l.quality = 1 AS t, d.n_chars > 500 AS f FROM labels AS l JOIN documents AS d USING (doc_id)),
            c AS (SELECT count(*) FILTER (t AND f) AS tp, count(*) FILTER (f AND NOT t) AS fp, count(*) FILTER (t AND NOT f) AS fn FROM m),
            r AS (SELECT *, {_RATES} FROM c)
            SELECT tp, fp, fn, round(p, 4) AS precision, round(r, 4) AS recall,
              round(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END, 4) AS f1_score FROM r""",
        "feature_stats": _with(_STATS) + " UNION ALL ".join(
            [f"SELECT '{c}' AS column_name, 'numeric' AS kind, round(m.med_{c}, 4) AS median, round(avg_{c}, 4) AS mean, "
             f"round(std_{c}, 4) AS std, NULL::varchar AS mode FROM stats" for c in _NUMBERS]
            + [f"SELECT '{c}', 'categorical', NULL, NULL, NULL, m.mode_{c} FROM stats" for c in _TEXTS]
        ),
        "feature_transform": _with(_STATS, _features("dirty", "f")) + "SELECT transaction_id, "
        + ", ".join(f"round(z__{c}, 6) AS z__{c}" for c in _NUMBERS) + ", " + ", ".join(f"c__{c}" for c in _TEXTS) + " FROM f",
        "label_encode": "SELECT event_id, event_type, dense_rank() OVER (ORDER BY event_type) - 1 AS code FROM events",
        "knn_of_rows_with_gaps": _with(*_KNN_BASE, _GAPS, _features("gaps", "q_f"), _known("q_f"), _pairs(_NUMBERS, _TEXTS, False)) + _PAIR_ROWS,
        "knn_exclude_self": _with(*_KNN_BASE, "known_q AS (SELECT * FROM clean_f)", _pairs(_NUMBERS, _TEXTS, True)) + _PAIR_ROWS,
        "knn_leave_one_out": _with(*_KNN_BASE, _GAPS, _features("gaps", "q_f"), _known("q_f"),
                                   _pairs(("transaction_count",), _TEXTS, False)) + _PAIR_ROWS,
        "neighbor_suggestions": _neighbour_suggestions(),
        "clip_and_default_suggestions": _with(_FIXES)
        + "SELECT row_id, column_name, source_method, suggested_value, suggested_num, confidence FROM fixes",
        "clip_both_bounds": "SELECT 'A' || c_custkey AS row_id, c_acctbal AS current_num, "
        "CASE WHEN c_acctbal < 0 THEN 0.0 ELSE 9000.0 END::double AS suggested_num, 1.0::double AS confidence "
        "FROM customer WHERE c_acctbal < 0 OR c_acctbal > 9000",
        "fuzzy_suggest_levenshtein": typo + _LEVENSHTEIN,
        "fuzzy_suggest_large_list": _LARGE_LIST,
        "severity_bands": _with() + "SELECT row_id, column_name, round(s, 6) AS severity_score, CASE WHEN s >= 1 THEN 'critical' "
        "WHEN s >= 0.5 THEN 'high' WHEN s >= 0.2 THEN 'medium' ELSE 'low' END AS severity FROM (SELECT row_id, column_name, "
        "abs(dirty_num - original_num) / (abs(original_num) + 1) AS s FROM labels_tx WHERE issue_type = 'anomaly')",
        "score_threshold": "WITH cut AS (SELECT quantile_cont(o_totalprice, 0.08) AS c FROM orders) SELECT o_orderkey, "
        "round(o_totalprice - c, 4) AS decision_score, (o_totalprice - c < 0)::integer AS is_anomaly FROM orders, cut",
        "attribution_exclude_self": _suspects("clean", True),
        "attribution_reference": _suspects("gaps", False),
        "run_scores": _run() + "SELECT row_id, round(d, 6) AS decision_score, (d < 0)::integer AS is_anomaly, "
        + ", ".join(f"CASE WHEN d < 0 THEN {c} END AS {c}" for c in ("domain", "value", "transaction_count"))
        + " FROM scored JOIN dirty ON transaction_id = row_id",
        "run_issues": _run() + _RUN_VIEW,
        "run_issues_reference": _run(exclude_self=False) + _RUN_VIEW,
        "run_issues_left_out": _run(left_out=True) + _RUN_VIEW,
        "run_issue_order": _issue_order(),
        "run_summary": _run() + _SUMMARY.replace("FROM issues", "FROM found"),
        "run_profile": _run() + _profile().replace("FROM issues", "FROM found"),
        "run_recommendations": _recommended(),
        "run_published": _recommended(),
        "run_evaluation": _run().rstrip() + _EVALUATION.replace("FROM issues", "FROM found"),
        "fix_conservative_all": _run_fixed("confidence >= 0.85"),
        "fix_auto_all": _run_fixed("true"),
        "fix_conservative": _fixed("confidence >= 0.85"),
        "fix_auto": _fixed("true"),
        "fix_in_place": _fixed("true"),
        "fix_approved": _fixed("column_name = 'value'"),
        "fix_last_wins_shared_ids": """
            WITH o AS (SELECT l_orderkey, count(*) AS lines, sum(l_quantity) AS quantity,
                bool_or(l_quantity > 48) AS above, bool_or(l_quantity < 3) AS below,
                bool_or(l_returnflag NOT IN ('A', 'N')) AS flagged, count(*) FILTER (l_returnflag = 'A') AS returned
              FROM lineitem GROUP BY l_orderkey)
            SELECT l_orderkey, lines,
              CASE WHEN above THEN 48.0 * lines WHEN below THEN 3.0 * lines ELSE quantity END::double AS quantity,
              CASE WHEN flagged THEN lines ELSE returned END AS returned FROM o""",
    }
