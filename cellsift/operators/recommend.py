"""A repair and a confidence for every finding.

A recommender takes a table of findings and returns it with the columns
``suggested_value``, ``suggested_num`` and ``confidence``. Own recommenders with
that contract can be chained after the built-in ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellsift.functions import arrays, cells, similarity
from cellsift.operators.attribute import only_where, with_neighbour_values
from cellsift.operators.keyed import join_keyed
from cellsift.operators.matching import best_matches
from cellsift.sources.scratch import cut_lineage
from cellsift.spec import QualitySpec

# Least similarity of a match, confidence without one, and the
# confidence when neighbour values average to zero.
SIMILARITY_CUTOFF = 0.6
FALLBACK_CONFIDENCE = 0.5
ZERO_MEAN_CONFIDENCE = 0.5
# Severity score of an anomaly whose cells are no numbers.
TEXT_SEVERITY_SCORE = 0.5
# Lists up to this length are compared within an expression; longer ones are indexed.
INLINE_ENTRIES = 32


def _suggestion(text: Column, num: Column, confidence: Column) -> Column:
    return F.struct(
        text.cast("string").alias("text"),
        num.cast("double").alias("num"),
        confidence.cast("double").alias("confidence"),
    )


def no_suggestion() -> Column:
    return _suggestion(F.lit(None), F.lit(None), F.lit(0.0))


def neighbour_suggestion(spec: QualitySpec, column: str) -> Column:
    """Median or mode of the neighbours. Needs ``with_neighbour_values`` columns."""
    values = f"n__{column}"
    rule = spec.rules[column]
    if rule.dtype == "numeric":
        middle = F.round(arrays.median(values), 2)
        mean, std = F.col(f"mean__{column}"), F.col(f"std__{column}")
        steady = 1 / (1 + F.try_divide(std, F.abs(mean)))
        confidence = F.when(mean == 0, F.lit(ZERO_MEAN_CONFIDENCE)).otherwise(cells.clamp(steady))
        found = _suggestion(middle.cast("string"), middle, confidence)
    elif rule.dtype == "categorical":
        found = _suggestion(
            F.col(f"mode__{column}"), F.lit(None), cells.clamp(arrays.share(values, f"mode__{column}"))
        )
    else:
        return no_suggestion()
    return F.when(F.size(values) > 0, found).otherwise(no_suggestion())


def clip_suggestion(spec: QualitySpec, column: str, number: Column) -> Column:
    """The bound that a number broke, with full confidence."""
    rule = spec.rules[column]
    out = no_suggestion()
    for limit, breaks in ((rule.max_value, "gt"), (rule.min_value, "lt")):
        if limit is not None:
            edge = F.lit(float(limit))
            broken = number > edge if breaks == "gt" else number < edge
            out = F.when(broken, _suggestion(F.lit(str(limit)), edge, F.lit(1.0))).otherwise(out)
    return out


def closest_allowed(values: DataFrame, column: str, allowed, method: str = "gestalt") -> DataFrame:
    """(value, match, ratio) for each distinct value of a column.

    Only distinct values are compared, each with the allowed list of the spec.
    """
    distinct = values.select(F.col(column).cast("string").alias("value")).filter("value IS NOT NULL").distinct()
    if method == "gestalt":
        match = similarity.gestalt_match(tuple(allowed), SIMILARITY_CUTOFF)
        return distinct.withColumn("_m", match("value")).select(
            "value", F.col("_m.match").alias("match"), F.col("_m.ratio").alias("ratio")
        )
    found = nearest_allowed(F.col("value"), allowed)
    return distinct.select("value", found["match"].alias("match"), found["ratio"].alias("ratio"))


def nearest_allowed(value: Column, allowed) -> Column:
    """(match, ratio) of the allowed value with the best edit-distance ratio; nulls below the cutoff."""
    options = F.array(
        *[
            F.struct(
                F.round(similarity.levenshtein_ratio(value, F.lit(str(a))), 4).alias("ratio"),
                F.lit(str(a)).alias("match"),
            )
            for a in allowed
        ]
    )

    def judged(best: Column) -> Column:
        near = best["ratio"] >= SIMILARITY_CUTOFF
        return F.struct(F.when(near, best["match"]).alias("match"), F.when(near, best["ratio"]).alias("ratio"))

    # The array of one names the maximum, so it is found once.
    return F.transform(F.array(F.array_max(options)), judged)[0]


def category_matches(findings: DataFrame, spec: QualitySpec, columns) -> DataFrame | None:
    """(column, value, match, ratio) for the invalid categories found in these columns."""
    parts = []
    invalid = findings.filter("issue_type = 'invalid'")
    for column in columns:
        allowed, here = spec.rules[column].allowed_values, invalid.filter(F.col("column_name") == column)
        if spec.similarity == "gestalt":
            found = closest_allowed(here, "current_value", allowed, spec.similarity)
        else:
            entries = findings.sparkSession.createDataFrame([(str(a),) for a in allowed], "entry string")
            found = best_matches(here.select("current_value"), entries, SIMILARITY_CUTOFF).withColumnRenamed("text", "value")
        parts.append(found.select(F.struct(F.lit(column).alias("column"), "value").alias("_cell"), "match", "ratio"))
    if not parts:
        return None
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _joined_matches(findings: DataFrame, matches: DataFrame) -> DataFrame:
    """Findings with the match of their value; a value may hold any share of them."""
    findings = findings.withColumn("_cell", F.struct(F.col("column_name").alias("column"), F.col("current_value").alias("value")))
    counts = findings.groupBy("_cell").agg(F.count(F.lit(1)).alias("_n"))
    matches = cut_lineage(matches.join(counts, "_cell"), "matches")
    return join_keyed(findings, matches, "_cell", "_n", "left").drop("_cell", "_n")


def recommend_invalid(findings: DataFrame, spec: QualitySpec) -> DataFrame:
    """Suggestions for invalid findings: clip numbers, match categories.

    The edit distance to a short list is an expression: no distinct values, no
    join. Long lists, and the gestalt similarity, go by distinct values.
    """
    listed = {c: r.allowed_values for c, r in spec.rules.items() if r.dtype == "categorical" and r.allowed_values}
    inline = [c for c in listed if spec.similarity == "levenshtein" and len(listed[c]) <= INLINE_ENTRIES]
    matches = category_matches(findings, spec, [c for c in listed if c not in inline])
    if matches is None:
        joined = findings.withColumns({"match": F.lit(None).cast("string"), "ratio": F.lit(None).cast("double")})
    else:
        joined = _joined_matches(findings, matches)
    if inline:
        found = F.struct("match", "ratio")
        for column in inline:
            here = (F.col("column_name") == column) & (F.col("issue_type") == "invalid")
            found = F.when(here, nearest_allowed(F.col("current_value"), listed[column])).otherwise(found)
        joined = joined.withColumn("_found", found).select(
            *findings.columns, F.col("_found.match").alias("match"), F.col("_found.ratio").alias("ratio")
        )
    out = no_suggestion()
    for column, rule in spec.rules.items():
        if rule.dtype == "numeric":
            here = clip_suggestion(spec, column, F.col("current_num"))
        elif rule.dtype == "categorical" and rule.allowed_values:
            first = F.lit(str(rule.allowed_values[0]))
            here = _suggestion(
                F.coalesce(F.col("match"), first),
                F.lit(None),
                F.coalesce(F.col("ratio"), F.lit(FALLBACK_CONFIDENCE)),
            )
        else:
            continue
        out = F.when(F.col("column_name") == column, here).otherwise(out)
    return _apply(joined, out)


def suggest_from_table(rows: DataFrame, column: str, entries: DataFrame, kept: list[str] | None = None) -> DataFrame:
    """``rows`` whose text is no entry of a table, with ``suggested_value`` and ``confidence``.

    The allowed values are a table of one column, of any length. A text without
    a close entry gets the least one with the fallback confidence; null cells are
    no findings.
    """
    entries = entries.select(F.col(entries.columns[0]).cast("string").alias("entry")).distinct()
    packed = rows.select(F.col(f"`{column}`").cast("string").alias("text"), F.struct(*[f"`{c}`" for c in rows.columns]).alias("row"))
    values = packed.groupBy("text").agg(F.count(F.lit(1)).alias("n")).where("text is not null")
    odd = cut_lineage(values.join(entries, values["text"] == entries["entry"], "left_anti"), "invalid", kept)
    close = best_matches(odd.select("text"), entries, SIMILARITY_CUTOFF, kept)
    matched = cut_lineage(odd.join(close, "text", "left"), "matches", kept)
    least = F.broadcast(entries.agg(F.min("entry").alias("least")))
    return join_keyed(packed, matched, "text", "n").crossJoin(least).select(
        "row.*",
        F.coalesce("match", "least").alias("suggested_value"),
        F.coalesce("ratio", F.lit(FALLBACK_CONFIDENCE)).alias("confidence"),
    )


def _apply(findings: DataFrame, suggestion: Column) -> DataFrame:
    """Write a suggestion struct into the three result columns."""
    replaced = ("suggested_value", "suggested_num", "confidence", "match", "ratio")
    kept = [c for c in findings.columns if c not in replaced]
    return findings.withColumn("_s", suggestion).select(
        *kept,
        F.col("_s.text").alias("suggested_value"),
        F.col("_s.num").alias("suggested_num"),
        F.col("_s.confidence").alias("confidence"),
    )


def anomaly_severity(current: Column, suggested: Column, numeric: Column) -> Column:
    """Relative distance of cell and suggestion; 0.5 for texts, null for a gap."""
    distance = F.abs(current - suggested) / (F.abs(suggested) + 1)
    return F.when(~numeric | suggested.isNull(), F.lit(TEXT_SEVERITY_SCORE)).otherwise(distance)


def recommend_from_neighbours(rows: DataFrame, spec: QualitySpec, near: str = "neighbours") -> DataFrame:
    """Explode missing and anomaly findings with the suggestion of their neighbours.

    ``rows`` carry ``findings`` (with a confidence each) and the neighbour
    array of the row, so no finding has to look up its row again.
    """
    asked = [c for c, r in spec.rules.items() if c in rows.columns and r.dtype in ("numeric", "categorical")]
    if spec.respect_use_for_recommendation:
        asked = [c for c in asked if spec.rules[c].use_for_recommendation]
    # Statistics cost more than all else here, so only the finding's own column has any.
    flat = rows.select(
        F.col(spec.id_column).cast("string").alias("row_id"), F.col(near).alias("_near"), F.inline_outer("findings")
    ).filter(F.col("column_name").isNotNull())
    wide = with_neighbour_values(only_where(flat, "_near", {c: F.col("column_name") == c for c in asked}), spec, "_near", asked)
    suggestion = no_suggestion()
    for c in asked:
        suggestion = F.when(F.col("column_name") == c, neighbour_suggestion(spec, c)).otherwise(suggestion)
    out = wide.withColumn("_s", suggestion)
    numeric = F.col("column_name").isin([c for c in asked if spec.rules[c].dtype == "numeric"])
    is_anomaly = F.col("issue_type") == "anomaly"
    score = anomaly_severity(F.col("current_num"), F.col("_s.num"), numeric)
    out = out.withColumn("_score", score)
    return out.select(
        "row_id", "issue_seq", "column_name", "issue_type", "current_value", "current_num",
        F.when(is_anomaly, F.col("_score")).otherwise(F.col("severity_score")).alias("severity_score"),
        F.when(is_anomaly, cells.severity_of(F.col("_score"))).otherwise(F.col("severity")).alias("severity"),
        "reason", "source_method",
        F.when(is_anomaly, F.least(F.col("confidence"), F.col("_s.confidence")))
        .otherwise(F.col("_s.confidence")).alias("confidence"),
        F.col("_s.text").alias("suggested_value"),
        F.col("_s.num").alias("suggested_num"),
    )
