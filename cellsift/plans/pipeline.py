"""The whole job: detect, score, attribute, recommend, report, repair."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from cellsift.operators import attribute, forest, recommend, repair, rules
from cellsift.operators.features import FittedFeatures, fit_features
from cellsift.operators.neighbours import NeighbourIndex
from cellsift.operators.normalize import coerce_types
from cellsift.plans import report
from cellsift.sources.scratch import cut_lineage, drop_written
from cellsift.spec import QualitySpec

_DISK = StorageLevel.MEMORY_AND_DISK


@dataclass
class DetectionRun:
    """Result of one run. Call ``close`` when its tables have been written."""

    table: DataFrame
    issues: DataFrame
    scores: DataFrame
    features: FittedFeatures
    model: forest.IsolationForest | None
    spec: QualitySpec
    _held: list[DataFrame] = field(default_factory=list)
    _kept: list[str] = field(default_factory=list)

    def summary(self) -> DataFrame:
        return report.issue_summary(self.issues)

    def recommendations(self) -> DataFrame:
        return report.recommendations(self.issues)

    def profile(self, approx_unique: bool = False) -> DataFrame:
        return report.column_profile(self.table, self.issues, approx_unique)

    def fixed(self, mode: str = "conservative", approvals: DataFrame | None = None) -> DataFrame:
        return repair.apply_fixes(self.table, self.issues, self.spec, mode, approvals)

    def public_issues(self) -> DataFrame:
        """Issues in their order, without the columns that only repairs need."""
        return rules.in_issue_order(self.issues).select(*rules.ISSUE_COLUMNS)

    def close(self) -> None:
        """Free caches and delete the stages of this run."""
        for df in self._held:
            df.unpersist()
        self._held.clear()
        drop_written(self.table.sparkSession, self._kept)


# Takes findings with suggestions and returns them with its own in place.
Recommender = Callable[[DataFrame, QualitySpec], DataFrame]


def run_detection(
    df: DataFrame, spec: QualitySpec, coerce: str = "before", recommenders: Sequence[Recommender] = (),
    given_score: str | None = None,
) -> DetectionRun:
    """Find every issue of a table and suggest a repair for each.

    ``coerce='before'`` turns unreadable numbers and dates into gaps before the
    rules look; ``'after'`` lets the rules see the raw text. ``recommenders``
    run after the built-in ones and may replace their suggestions.
    ``given_score``, a SQL expression over ruled columns, takes the place of the
    forest's score: lower is odder, and the cut is found in the same way.
    """
    if coerce not in ("before", "after"):
        raise ValueError("coerce must be 'before' or 'after'")
    spec.require_columns(df.columns)
    table = coerce_types(df, spec) if coerce == "before" else df
    kept: list[str] = []
    judged, features, model = score_rows(table, spec, kept, given_score)
    clean = judged.filter("is_clean")
    near, odd = _rows_with_neighbours(judged, clean, features, spec, kept)
    findings = _all_findings(judged, near, odd, spec)
    for recommender in recommenders:
        findings = recommender(findings, spec)
    issues = rules.as_issues(findings).persist(_DISK)
    scores = judged.select(
        F.col(spec.id_column).cast("string").alias("row_id"), "raw_score", "decision_score", "is_anomaly"
    )
    return DetectionRun(table, issues, scores, features, model, spec, [issues], kept)


def score_rows(
    table: DataFrame, spec: QualitySpec, kept: list[str] | None = None, given_score: str | None = None
) -> tuple[DataFrame, FittedFeatures, forest.IsolationForest | None]:
    """Ruled columns with findings, clean flag, scores and anomaly label of every row.

    Features and forest are fitted on the clean rows, or on all if none is clean.
    With ``given_score`` no forest is grown; rows whose score is null are no anomalies.
    """
    held: list = []
    # Findings and the clean flag are row facts; only ruled columns are kept.
    columns = [c for c in spec.ruled_columns if c in table.columns]
    marked = coerce_types(rules.mark_clean(table.select(*columns), spec, kept), spec)
    marked, total, clean_rows = _spread(marked.persist(_DISK), held)
    if not clean_rows:
        marked, clean_rows = marked.withColumn("is_clean", F.lit(True)), total
    clean = marked.filter("is_clean")

    features = fit_features(clean, spec)
    model = None if given_score else forest.fit_forest(clean, features, spec, clean_rows)
    raw = F.expr(given_score).cast("double") if given_score else model.raw_score(marked)
    # Scores are dear: they are written, so no lost executor makes them anew.
    scored = cut_lineage(marked.withColumn("raw_score", raw), "scored", kept)
    for df in held:
        df.unpersist()
    offset = forest.score_offset(scored.filter("is_clean").select("raw_score"), spec.contamination)
    return forest.with_decision(scored, offset), features, model and model.with_offset(offset)


# Below this many rows a table may sit in fewer partitions than there are cores.
SMALL_ROWS = 5_000_000


def _spread(marked: DataFrame, held: list) -> tuple[DataFrame, int, int]:
    """Count all and clean rows, and spread a small table over all cores.

    Scoring costs time, not bytes, so few bytes must not mean few tasks.
    """
    held.append(marked)
    seen = marked.agg(F.count(F.lit(1)), F.count_if("is_clean")).first()
    if seen[0] < SMALL_ROWS:
        marked = marked.repartition(marked.sparkSession.sparkContext.defaultParallelism).persist(_DISK)
        held.append(marked)
    return marked, seen[0], seen[1]


def _rows_with_neighbours(
    judged: DataFrame, clean: DataFrame, features: FittedFeatures, spec: QualitySpec, kept: list[str]
) -> tuple[DataFrame, DataFrame]:
    """Rows that need neighbours: anomalies, and rows with a missing cell."""
    has_gap = F.exists("findings", lambda f: f["issue_type"] == "missing")
    wanted = judged.filter((F.col("is_anomaly") == 1) | F.coalesce(has_gap, F.lit(False)))
    columns = [c for c, r in spec.rules.items() if r.dtype in ("numeric", "categorical")]
    index = NeighbourIndex(
        clean, features, spec.id_column, columns, spec.knn_neighbors, seed=spec.random_state
    )
    own = None if spec.neighbours == "reference" else spec.id_column
    near = cut_lineage(index.k_nearest(wanted, exclude_self=own), "neighbours", kept)
    index.close()
    anomalous = near.filter("is_anomaly = 1")
    if spec.neighbours == "leave_one_feature_out":
        return near, attribute.suspicious_columns_left_out(anomalous, clean, features, spec, kept)
    return near, attribute.suspicious_columns(anomalous, spec)


def _all_findings(judged: DataFrame, near: DataFrame, odd: DataFrame, spec: QualitySpec) -> DataFrame:
    """Rule findings and anomaly findings, each with its recommendation."""
    certain = F.lit(1.0)
    missing = near.withColumn(
        "findings",
        F.transform(
            F.filter("findings", lambda f: f["issue_type"] == "missing"),
            lambda f: f.withField("confidence", certain),
        ),
    )
    anomalies = odd.withColumn("findings", attribute.anomaly_findings(odd, spec))
    from_neighbours = recommend.recommend_from_neighbours(missing, spec).unionByName(
        recommend.recommend_from_neighbours(anomalies, spec)
    )
    invalid = rules.explode_findings(
        judged.withColumn("findings", F.filter("findings", lambda f: f["issue_type"] == "invalid")), spec
    )
    return from_neighbours.unionByName(recommend.recommend_invalid(invalid, spec))


def write_run(run: DetectionRun, sink, fix_mode: str | None = None) -> dict[str, str]:
    """Write all result tables of a run through one sink; returns their places."""
    places = {
        "detected_issues": sink.write(run.public_issues(), "detected_issues"),
        "recommendations": sink.write(run.recommendations(), "recommendations"),
        "final_report": sink.write(run.summary(), "final_report", small=True),
        "dataset_profile": sink.write(run.profile(), "dataset_profile", small=True),
    }
    if fix_mode:
        places["fixed_data"] = sink.write(run.fixed(fix_mode), "fixed_data")
    return places


def write_seeded(dirty: DataFrame, labels: DataFrame, sink) -> dict[str, str]:
    return {
        "seeded_dirty_data": sink.write(dirty, "seeded_dirty_data"),
        "seeded_dirty_labels": sink.write(labels, "seeded_dirty_labels"),
    }
