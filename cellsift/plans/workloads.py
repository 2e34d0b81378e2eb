"""Registered queries: every operator over whole driver tables.

Each takes a session and a folder of parquet tables and returns a DataFrame
whose columns carry the names of the matching check in ``checks``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellsift.functions import cells
from cellsift.operators import attribute, features, forest, normalize, recommend, repair, rules, seed
from cellsift.operators.neighbours import NeighbourIndex
from cellsift.plans import evaluate, pipeline, publish, report
from cellsift.plans import tables as t
from cellsift.sources.files import FileSink, FileSource, convert, text_schema
from cellsift.sources.quarantine import read_with_quarantine
from cellsift.sources.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
_registry: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _registry[fn.__name__] = fn
    return fn


def registered() -> dict[str, Query]:
    return dict(_registry)


ISSUE_VIEW = (
    "row_id", "column_name", "issue_type", "severity", "severity_score", "reason", "source_method",
    "confidence", "can_auto_fix",
)
NUMBERS = ("value", "transaction_count", "avg_transaction_value")
CELLS = ("domain", "location", *NUMBERS)


# Sources ---------------------------------------------------------------
@query
def csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    raw = t.raw_transactions(spark, d)
    path = FileSink(scratch_path(spark, "csv"), "csv").write(raw, "raw")
    return FileSource(path, "csv", schema=text_schema(raw.columns)).read(spark)


@query
def csv_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """Every line of a damaged file: as a row, or as text with the reason it is none."""
    lines = t.raw_lines(spark, d)
    path = scratch_path(spark, "lines")
    lines.select("record").write.text(path)
    schema = text_schema(t.raw_transactions(spark, d).columns)
    found = read_with_quarantine(spark, path, schema, {"header": "false"})
    return found.rows.unionByName(found.rejected.select("record", "reason"), allowMissingColumns=True)


@query
def format_convert(spark: SparkSession, d: str) -> DataFrame:
    """Parquet to ORC to JSON; the last step is read back with its schema."""
    folder = scratch_path(spark, "convert")
    source = FileSource(f"{d}/orders.parquet", "parquet")
    schema = source.read(spark).schema
    orc = convert(spark, source, FileSink(folder, "orc"), "orders_orc")
    js = convert(spark, FileSource(orc, "orc"), FileSink(folder, "json"), "orders_json")
    return FileSource(js, "json", schema=schema).read(spark)


# Normalisation -----------------------------------------------------------
@query
def blank_to_null(spark: SparkSession, d: str) -> DataFrame:
    return normalize.blanks_to_null(t.raw_transactions(spark, d))


@query
def numeric_coerce(spark: SparkSession, d: str) -> DataFrame:
    raw = t.raw_transactions(spark, d)
    return raw.select(
        "transaction_id", *[cells.to_number(F.col(c), raw.schema[c].dataType).alias(c.lower()) for c in ("VALUE", "TRANSACTION_COUNT")]
    )


@query
def canonicalize_category(spark: SparkSession, d: str) -> DataFrame:
    raw = normalize.rename_present(t.raw_transactions(spark, d), normalize.BANK_COLUMNS)
    return normalize.canonicalize(
        raw, upper=["domain"], trim=["location"], synonyms={"domain": normalize.BANK_SYNONYMS}
    ).select("transaction_id", "domain", "location")


@query
def date_parse_parts(spark: SparkSession, d: str) -> DataFrame:
    raw = t.raw_transactions(spark, d)
    dated = raw.select("transaction_id", cells.to_date(F.col("DATE"), raw.schema["DATE"].dataType, ("yyyy-MM-dd",)).alias("date"))
    return normalize.calendar_parts(dated)


@query
def ratio_feature(spark: SparkSession, d: str) -> DataFrame:
    bank = normalize.bank_features(normalize.blanks_to_null(t.raw_transactions(spark, d)))
    return bank.select("transaction_id", "value", "transaction_count", "avg_transaction_value")


@query
def surrogate_key(spark: SparkSession, d: str) -> DataFrame:
    orders = t.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return normalize.with_surrogate_key(orders, "transaction_id", [F.desc("o_totalprice"), "o_orderkey"])


# Rules -------------------------------------------------------------------
@query
def missing_issues(spark: SparkSession, d: str) -> DataFrame:
    return rules.rule_issues(t.dirty_transactions(spark, d), t.transactions_spec(), ("missing",)).select(*ISSUE_VIEW)


@query
def invalid_type_issues(spark: SparkSession, d: str) -> DataFrame:
    """Raw text against the rules: numbers and dates that cannot be read, values that are not allowed."""
    raw = normalize.rename_present(t.raw_transactions(spark, d), normalize.BANK_COLUMNS)
    issues = rules.rule_issues(raw, t.transactions_spec(), ("invalid",))
    return issues.select(*ISSUE_VIEW, "current_value")


@query
def invalid_min_issues(spark: SparkSession, d: str) -> DataFrame:
    issues = rules.rule_issues(t.accounts(spark, d), t.accounts_spec())
    return issues.select(*ISSUE_VIEW, "current_num")


@query
def invalid_max_and_category_issues(spark: SparkSession, d: str) -> DataFrame:
    issues = rules.rule_issues(t.table(spark, d, "events"), t.events_spec())
    return issues.select(*ISSUE_VIEW, "current_num")


@query
def invalid_category_issues(spark: SparkSession, d: str) -> DataFrame:
    return rules.rule_issues(t.typo_parts(spark, d), t.parts_spec()).select(*ISSUE_VIEW, "current_value")


@query
def cross_field_issues(spark: SparkSession, d: str) -> DataFrame:
    issues = rules.rule_issues(t.transactions(spark, d), t.transactions_spec(), ("cross_field",))
    return issues.select(*ISSUE_VIEW, "current_num")


@query
def all_rule_issues(spark: SparkSession, d: str) -> DataFrame:
    issues = rules.rule_issues(t.dirty_transactions(spark, d), t.transactions_spec())
    return issues.select(*ISSUE_VIEW, "current_num")


@query
def derived_findings_skipped(spark: SparkSession, d: str) -> DataFrame:
    spec = t.transactions_spec().with_options(skip_derived_findings=True, severity_scale="uniform")
    return rules.rule_issues(t.dirty_transactions(spark, d), spec).select(*ISSUE_VIEW)


@query
def clean_rows(spark: SparkSession, d: str) -> DataFrame:
    return rules.clean_rows(t.dirty_transactions(spark, d), t.transactions_spec())


@query
def clean_rows_shared_ids(spark: SparkSession, d: str) -> DataFrame:
    """Line items keyed by order: one bad line spoils every line of the order."""
    lines = t.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    clean = rules.clean_rows(lines, t.lines_spec())
    return clean.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity"))


# Reports -----------------------------------------------------------------
@query
def issue_summary(spark: SparkSession, d: str) -> DataFrame:
    return report.issue_summary(rules.rule_issues(t.dirty_transactions(spark, d), t.transactions_spec()))


@query
def recommendations_view(spark: SparkSession, d: str) -> DataFrame:
    dirty, spec = t.dirty_transactions(spark, d), _levenshtein_spec()
    issues = rules.as_issues(_invalid_suggestions(dirty, spec))
    return report.recommendations(issues).drop("issue_id", "current_value")


@query
def column_profile(spark: SparkSession, d: str) -> DataFrame:
    dirty = t.dirty_transactions(spark, d)
    return report.column_profile(dirty, rules.rule_issues(dirty, t.transactions_spec()))


# Sampling, seeding, evaluation ---------------------------------------------
@query
def exact_sample(spark: SparkSession, d: str) -> DataFrame:
    return seed.sample_exact(t.table(spark, d, "orders"), "o_orderkey", 10_000, seed=42)


@query
def seed_dirty_rows(spark: SparkSession, d: str) -> DataFrame:
    return t.seeded_transactions(spark, d)[0]


@query
def seed_labels(spark: SparkSession, d: str) -> DataFrame:
    _, labels = t.seeded_transactions(spark, d)
    return labels.select("row_id", "column_name", "issue_type", "original_num", "dirty_num")


@query
def evaluation_report(spark: SparkSession, d: str) -> DataFrame:
    issues = rules.rule_issues(t.dirty_transactions(spark, d), t.transactions_spec())
    return evaluate.evaluation_report(t.seed_labels(spark, d), issues)


@query
def eval_prediction(spark: SparkSession, d: str) -> DataFrame:
    """Long documents as a prediction of good quality."""
    labels, documents = t.table(spark, d, "labels"), t.table(spark, d, "documents")
    truth = labels.filter("quality = 1").select("doc_id")
    found = documents.filter("n_chars > 500").join(labels.select("doc_id"), "doc_id", "left_semi").select("doc_id")
    return evaluate.with_rates(evaluate.confusion(truth, found, ["doc_id"]))


# Features ------------------------------------------------------------------
def _clean(spark: SparkSession, d: str) -> DataFrame:
    """Clean rows, kept since fitting and indexing read them several times."""
    return rules.clean_rows(t.dirty_transactions(spark, d), t.transactions_spec()).persist()


@query
def feature_stats(spark: SparkSession, d: str) -> DataFrame:
    stats = features.fit_features(_clean(spark, d), t.transactions_spec()).stats_table(spark)
    return stats.withColumns({c: F.round(c, 4) for c in ("median", "mean", "std")})


@query
def feature_transform(spark: SparkSession, d: str) -> DataFrame:
    fitted = features.fit_features(_clean(spark, d), t.transactions_spec())
    dirty = t.dirty_transactions(spark, d)
    return dirty.select(
        "transaction_id", *[F.round(c, 6).alias(n) if n.startswith("z__") else c for n, c in zip(fitted.names, fitted.columns(dirty))]
    )


@query
def label_encode(spark: SparkSession, d: str) -> DataFrame:
    events = t.table(spark, d, "events").select("event_id", "event_type")
    return features.label_encode(events, "event_type", "code")


# Neighbours ----------------------------------------------------------------
def _index(clean: DataFrame, spec, without: set[str] = frozenset(), payload=()) -> NeighbourIndex:
    fitted = features.fit_features(clean, spec)
    return NeighbourIndex(clean, fitted.without(without), spec.id_column, payload, spec.knn_neighbors)


def _neighbour_rows(found: DataFrame) -> DataFrame:
    return found.select(F.col("transaction_id").alias("row_id"), F.posexplode("neighbours").alias("place", "n")).select(
        "row_id", (F.col("place") + 1).alias("place"), F.col("n.key").alias("neighbour_id"),
        F.round("n.dist2", 6).alias("dist2"),
    )


def _with_gaps(spark: SparkSession, d: str) -> DataFrame:
    rows = rules.with_findings(t.dirty_transactions(spark, d), t.transactions_spec(), ("missing",))
    return rows.filter("findings IS NOT NULL")


@query
def knn_of_rows_with_gaps(spark: SparkSession, d: str) -> DataFrame:
    index = _index(_clean(spark, d), t.transactions_spec())
    return _neighbour_rows(index.k_nearest(_with_gaps(spark, d)))


@query
def knn_exclude_self(spark: SparkSession, d: str) -> DataFrame:
    """Neighbours of every clean row among the other clean rows."""
    clean = _clean(spark, d)
    index = _index(clean, t.transactions_spec())
    return _neighbour_rows(index.k_nearest(clean, exclude_self="transaction_id"))


@query
def knn_leave_one_out(spark: SparkSession, d: str) -> DataFrame:
    """Neighbours for judging ``value``, found without it and the average."""
    clean, spec = _clean(spark, d), t.transactions_spec()
    index = _index(clean, spec, spec.related_columns("value"))
    return _neighbour_rows(index.k_nearest(_with_gaps(spark, d)))


# Suggestions -----------------------------------------------------------------
@query
def neighbor_suggestions(spark: SparkSession, d: str) -> DataFrame:
    """Median or mode of the neighbours for every missing cell."""
    spec = t.transactions_spec()
    index = _index(_clean(spark, d), spec, payload=CELLS)
    found = recommend.recommend_from_neighbours(
        index.k_nearest(
            _with_gaps(spark, d).withColumn(
                "findings", F.transform("findings", lambda f: f.withField("confidence", F.lit(1.0)))
            )
        ),
        spec,
    )
    text = F.when(F.col("suggested_num").isNull(), F.col("suggested_value"))
    return found.select("row_id", "column_name", "suggested_num", text.alias("suggested_text"), "confidence")


def _levenshtein_spec():
    return t.transactions_spec().with_options(similarity="levenshtein")


def _invalid_suggestions(dirty: DataFrame, spec) -> DataFrame:
    findings = rules.explode_findings(rules.with_findings(dirty, spec, ("invalid", "cross_field")), spec)
    return recommend.recommend_invalid(findings, spec)


@query
def clip_and_default_suggestions(spark: SparkSession, d: str) -> DataFrame:
    found = _invalid_suggestions(t.dirty_transactions(spark, d), _levenshtein_spec())
    return found.select(
        "row_id", "column_name", "source_method", "suggested_value", "suggested_num", "confidence"
    )


@query
def clip_both_bounds(spark: SparkSession, d: str) -> DataFrame:
    found = _invalid_suggestions(t.accounts(spark, d), t.accounts_spec())
    return found.select("row_id", "current_num", "suggested_num", "confidence")


@query
def fuzzy_suggest_levenshtein(spark: SparkSession, d: str) -> DataFrame:
    spec = t.parts_spec().with_options(similarity="levenshtein")
    return _invalid_suggestions(t.typo_parts(spark, d), spec).select(
        "row_id", "current_value", "suggested_value", "confidence"
    )


@query
def fuzzy_suggest_gestalt(spark: SparkSession, d: str) -> DataFrame:
    return _invalid_suggestions(t.typo_parts(spark, d), t.parts_spec().with_options(similarity="gestalt")).select(
        "row_id", "current_value", "suggested_value", "confidence"
    )


@query
def fuzzy_suggest_large_list(spark: SparkSession, d: str) -> DataFrame:
    """Labels of parts against a list of thousands."""
    parts = t.labelled_parts(spark, d)
    return recommend.suggest_from_table(parts, "label", t.part_labels(spark, d)).withColumnRenamed("label", "current_value")


@query
def severity_bands(spark: SparkSession, d: str) -> DataFrame:
    """Severity of each seeded anomaly against the value it had before."""
    labels = t.seed_labels(spark, d).filter("issue_type = 'anomaly'")
    score = recommend.anomaly_severity(F.col("dirty_num"), F.col("original_num"), F.lit(True))
    return labels.select("row_id", "column_name", F.round(score, 6).alias("severity_score"), cells.severity_of(score).alias("severity"))


# Anomalies ---------------------------------------------------------------------
@query
def score_threshold(spark: SparkSession, d: str) -> DataFrame:
    """The contamination cut, with the order price as score."""
    scores = t.table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("raw_score"))
    judged = forest.with_decision(scores, forest.score_offset(scores, 0.08))
    return judged.select("o_orderkey", F.round("decision_score", 4).alias("decision_score"), "is_anomaly")


def _suspects(near: DataFrame, spec) -> DataFrame:
    odd = attribute.suspicious_columns(near, spec)
    names = odd.select(F.col("transaction_id").alias("row_id"), F.explode_outer("suspects").alias("column_name"))
    return names.filter("column_name IS NOT NULL")


@query
def attribution_exclude_self(spark: SparkSession, d: str) -> DataFrame:
    """Columns of every clean row that stand out from its neighbours."""
    clean, spec = _clean(spark, d), t.transactions_spec()
    index = _index(clean, spec, payload=CELLS)
    return _suspects(index.k_nearest(clean, exclude_self="transaction_id"), spec)


@query
def attribution_reference(spark: SparkSession, d: str) -> DataFrame:
    """The same for rows with a gap, whose neighbours are found as they are."""
    clean, spec = _clean(spark, d), t.transactions_spec()
    index = _index(clean, spec, payload=CELLS)
    return _suspects(index.k_nearest(_with_gaps(spark, d)), spec)


@query
def iforest_scores(spark: SparkSession, d: str) -> DataFrame:
    judged, _, _ = pipeline.score_rows(t.dirty_transactions(spark, d), t.transactions_spec())
    return judged.select("transaction_id", "raw_score", "decision_score", "is_anomaly")


@query
def anomaly_issues(spark: SparkSession, d: str) -> DataFrame:
    run = pipeline.run_detection(t.dirty_transactions(spark, d), t.transactions_spec())
    return run.issues.filter("issue_type = 'anomaly'").drop("created_at")


@query
def anomaly_issues_leave_one_out(spark: SparkSession, d: str) -> DataFrame:
    spec = t.transactions_spec().with_options(neighbours="leave_one_feature_out")
    run = pipeline.run_detection(t.dirty_transactions(spark, d), spec)
    return run.issues.filter("issue_type = 'anomaly'").drop("created_at")


@query
def full_pipeline(spark: SparkSession, d: str) -> DataFrame:
    """Detect, recommend and evaluate; the evaluation is returned."""
    run = pipeline.run_detection(t.dirty_transactions(spark, d), t.transactions_spec())
    return evaluate.evaluation_report(t.seed_labels(spark, d), run.issues)


# Whole runs on given scores --------------------------------------------------------
def _run(spark: SparkSession, d: str, neighbours: str = "exclude_self") -> pipeline.DetectionRun:
    spec = t.transactions_spec().with_options(neighbours=neighbours)
    return pipeline.run_detection(t.dirty_transactions(spark, d), spec, given_score=t.GIVEN_SCORE)


def _run_view(issues: DataFrame) -> DataFrame:
    """Issues with their suggestions; numbers as numbers, other suggestions as text."""
    return issues.select(
        *[c for c in ISSUE_VIEW if c != "severity_score"], F.round("severity_score", 6).alias("severity_score"),
        "current_num", "suggested_num",
        F.when(F.col("suggested_num").isNull(), F.col("suggested_value")).alias("suggested_text"),
    )


@query
def run_scores(spark: SparkSession, d: str) -> DataFrame:
    """Every row with its decision, the anomalous ones with their values as well."""
    run = _run(spark, d)
    odd = run.table.withColumn("row_id", F.col("transaction_id")).select("row_id", "domain", "value", "transaction_count")
    kept = run.scores.select("row_id", F.round("decision_score", 6).alias("decision_score"), "is_anomaly")
    # The row of an anomaly is looked up by its id; other rows carry their score only.
    rows = kept.filter("is_anomaly = 1").join(odd, "row_id", "left")
    rest = kept.filter("is_anomaly = 0")
    return rows.unionByName(rest, allowMissingColumns=True)


@query
def run_issues(spark: SparkSession, d: str) -> DataFrame:
    """Missing, invalid and anomalous cells with the suggestion for each."""
    return _run_view(_run(spark, d).issues)


@query
def run_issues_reference(spark: SparkSession, d: str) -> DataFrame:
    """The same where a row counts among its own neighbours."""
    return _run_view(_run(spark, d, "reference").issues)


@query
def run_issues_left_out(spark: SparkSession, d: str) -> DataFrame:
    """The same where each column is judged by neighbours found without it."""
    return _run_view(_run(spark, d, "leave_one_feature_out").issues)


@query
def run_issue_order(spark: SparkSession, d: str) -> DataFrame:
    """The id of each issue, its cell as text, and its place among the issues of its row."""
    by_row = Window.partitionBy("row_id").orderBy("issue_seq")
    return _run(spark, d).issues.select(
        "row_id", "column_name", "issue_type", "current_value", "issue_id", F.row_number().over(by_row).alias("place")
    )


@query
def run_summary(spark: SparkSession, d: str) -> DataFrame:
    return _run(spark, d).summary()


@query
def run_profile(spark: SparkSession, d: str) -> DataFrame:
    return _run(spark, d).profile()


@query
def run_recommendations(spark: SparkSession, d: str) -> DataFrame:
    return _run(spark, d).recommendations().drop("issue_id", "current_value")


@query
def run_published(spark: SparkSession, d: str) -> DataFrame:
    """The recommendations as a reader of published runs finds them."""
    folder, run = scratch_path(spark, "published"), _run(spark, d)
    publish.publish_run(run, folder, "first")
    run.close()
    return publish.read_published(spark, folder, "recommendations").drop("issue_id", "current_value")


@query
def run_evaluation(spark: SparkSession, d: str) -> DataFrame:
    """All findings against the seeded faults."""
    return evaluate.evaluation_report(t.seed_labels(spark, d), _run(spark, d).issues)


@query
def fix_conservative_all(spark: SparkSession, d: str) -> DataFrame:
    """Sure suggestions for missing, invalid and anomalous cells, written back."""
    return _run(spark, d).fixed("conservative")


@query
def fix_auto_all(spark: SparkSession, d: str) -> DataFrame:
    """Every suggestion for missing, invalid and anomalous cells, written back."""
    return _run(spark, d).fixed("auto")


# Repair ------------------------------------------------------------------------
def _fixed(spark: SparkSession, d: str, mode: str, approvals=None) -> DataFrame:
    dirty, spec = t.dirty_transactions(spark, d), _levenshtein_spec()
    issues = rules.as_issues(_invalid_suggestions(dirty, spec))
    chosen = approvals(issues) if approvals else None
    return repair.apply_fixes(dirty, issues, spec, mode, chosen)


@query
def fix_conservative(spark: SparkSession, d: str) -> DataFrame:
    return _fixed(spark, d, "conservative")


@query
def fix_auto(spark: SparkSession, d: str) -> DataFrame:
    return _fixed(spark, d, "auto")


@query
def fix_in_place(spark: SparkSession, d: str) -> DataFrame:
    """The table stored by month; only months with a fix are replaced."""
    dirty, spec = t.dirty_transactions(spark, d), _levenshtein_spec()
    stored = dirty.withColumn("month", F.date_format("date", "yyyy-MM"))
    path = scratch_path(spark, "by_month")
    stored.hint("rebalance", "month").write.partitionBy("month").parquet(path)
    issues = rules.as_issues(_invalid_suggestions(dirty, spec))
    repair.repair_in_place(spark, path, ["month"], issues, spec, "auto", schema=stored.schema)
    return spark.read.schema(stored.schema).parquet(path).drop("month")


@query
def fix_approved(spark: SparkSession, d: str) -> DataFrame:
    """Fixes of ``value`` are approved, all others are declined."""
    return _fixed(
        spark, d, "approved", lambda i: i.select("issue_id", (F.col("column_name") == "value").alias("approved"))
    )


@query
def fix_last_wins_shared_ids(spark: SparkSession, d: str) -> DataFrame:
    """Line items keyed by order: the last suggestion reaches all lines of the order."""
    lines = t.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    spec = t.lines_spec().with_options(similarity="levenshtein")
    fixed = repair.apply_fixes(lines, rules.as_issues(_invalid_suggestions(lines, spec)), spec, "auto")
    return fixed.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("l_quantity").alias("quantity"),
        F.count_if(F.col("l_returnflag") == "A").alias("returned"),
    )
