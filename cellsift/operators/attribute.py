"""Which cells of an anomalous row stand out from its neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellsift.functions import arrays, cells
from cellsift.operators.features import FittedFeatures, PreparedFeatures
from cellsift.operators.neighbours import NeighbourIndex
from cellsift.operators.rules import ANOMALY, ANOMALY_METHOD, issue_seq
from cellsift.sources.scratch import cut_lineage
from cellsift.spec import QualitySpec

# Score and confidence of an anomaly before a repair is known.
CONFIDENCE_PER_DECISION = 5
PLACEHOLDER_SEVERITY, PLACEHOLDER_SCORE = "medium", 0.5
# Views lie this far apart, so that the square of the gap is beyond any distance inside one.
VIEW_GAP = 1e100
HIDDEN = "\0hidden"


def attributable_columns(df: DataFrame, spec: QualitySpec) -> list[str]:
    return [c for c in spec.detection_columns if c in df.columns]


def with_neighbour_values(df: DataFrame, spec: QualitySpec, near: str = "neighbours", columns=None) -> DataFrame:
    """Add ``n__<column>``: the neighbours' values of a column, gaps dropped.

    Numbers also get mean and deviation, categories their mode.
    """
    columns = columns or attributable_columns(df, spec)
    numeric = [c for c in columns if spec.rules[c].dtype == "numeric"]
    df = df.withColumns({f"n__{c}": arrays.present(f"{near}.`{c}`") for c in columns})
    df = df.withColumns(
        {f"mean__{c}": arrays.mean(f"n__{c}") for c in numeric}
        | {f"mode__{c}": arrays.mode(f"n__{c}") for c in columns if c not in numeric}
    )
    spreads = {f"std__{c}": arrays.population_std(f"n__{c}", f"mean__{c}") for c in numeric}
    return df.withColumns(spreads) if spreads else df


def only_where(df: DataFrame, near: str, wanted: dict[str, Column]) -> DataFrame:
    """The neighbours' values of each column where they are wanted, null elsewhere.

    Statistics of a null array are null and cost next to nothing.
    """
    if not wanted:
        return df
    return df.withColumn(near, F.struct(*[F.when(here, F.col(f"{near}.`{c}`")).alias(c) for c, here in wanted.items()]))


def is_suspicious(df: DataFrame, spec: QualitySpec, c: str) -> Column:
    """Never null. Needs the columns of ``with_neighbour_values``."""
    dtype, value = df.schema[c].dataType, F.col(c)
    if spec.rules[c].dtype == "numeric":
        number = cells.to_number(value, dtype)
        mean, std = F.col(f"mean__{c}"), F.col(f"std__{c}")
        far = F.when(number.isNull(), True).when(std == 0, number != mean).otherwise(
            F.abs(F.try_divide(number - mean, std)) >= F.lit(float(spec.feature_z_threshold))
        )
        stands_out = (F.size(f"n__{c}") >= 2) & far
    elif spec.rules[c].dtype == "categorical":
        stands_out = value.cast("string") != F.col(f"mode__{c}")
    else:
        stands_out = F.lit(False)
    gap = cells.nan_to_null(value).isNull() if isinstance(dtype, cells.FLOAT_TYPES) else value.isNull()
    return gap | F.coalesce(stands_out, F.lit(False))


def suspicious_columns(df: DataFrame, spec: QualitySpec, near: str = "neighbours") -> DataFrame:
    """Add ``suspects``: names of the columns that stand out, in rule order."""
    wide = with_neighbour_values(df, spec, near)
    columns = attributable_columns(df, spec)
    names = F.array(*[F.when(is_suspicious(wide, spec, c), F.lit(c)) for c in columns])
    return wide.withColumn("suspects", F.array_compact(names)).select(*df.columns, "suspects")


def _views(df: DataFrame, features: FittedFeatures, hidden: dict[int, set[str]], axis: str) -> DataFrame:
    """A copy of each row for every view, with the features that the view hides made equal."""
    wide = features.transform(df).withColumn("_view", F.explode(F.array(*[F.lit(v) for v in hidden])))

    def shown(prefix: str, c: str, constant) -> Column:
        out_of = [v for v, columns in hidden.items() if c in columns]
        return F.when(F.col("_view").isin(out_of), constant).otherwise(F.col(f"{prefix}{c}"))

    return wide.withColumns(
        {f"z__{c}": shown("z__", c, F.lit(0.0)) for c in features.numeric}
        | {f"c__{c}": shown("c__", c, F.lit(HIDDEN)) for c in features.categorical}
        | {axis: F.col("_view") * F.lit(VIEW_GAP)}
    )


def odd_views(near: DataFrame, spec: QualitySpec, judged: dict[int, str]) -> DataFrame:
    """``_odd``, the views of a ``_row`` whose judged column stands out from ``_near``; no row without any."""
    own = only_where(near, "_near", {c: F.col("_view") == i for i, c in judged.items()})
    wide = with_neighbour_values(own, spec, "_near", list(judged.values()))
    odd = F.coalesce(*[F.when(F.col("_view") == i, is_suspicious(wide, spec, c)) for i, c in judged.items()])
    # A filter on the verdict itself would be moved below the statistics it names, and
    # each of them written out, with all it is made of, at every place that names it.
    # The verdict is exploded in the outer form, which filters do not pass.
    flat = wide.select("_row", F.explode_outer(F.when(odd, F.array("_view"))).alias("_odd"))
    # At most one entry per column.
    return flat.filter("_odd IS NOT NULL").groupBy("_row").agg(F.collect_set("_odd").alias("_odd"))


def suspicious_columns_left_out(
    df: DataFrame, reference: DataFrame, features: FittedFeatures, spec: QualitySpec,
    kept: list[str] | None = None,
) -> DataFrame:
    """Like ``suspicious_columns``, but a column is judged by neighbours found without it.

    The distance for a column leaves out the column itself and those derived
    from it or feeding it. All columns are searched in one index: each row is in
    it once for every column, with the features left out made equal and the
    copies of different columns too far apart to be neighbours. A column for
    which no feature is left stands out where it is missing.
    """
    columns = attributable_columns(df, spec)
    hidden = {i: spec.related_columns(c) for i, c in enumerate(columns)}
    searched = {i: left for i, left in hidden.items() if features.without(left).names}
    # The number joins a row with its verdicts, as ids may repeat.
    rows = cut_lineage(df.withColumn("_row", F.monotonically_increasing_id()), "to_judge", kept)
    found = F.array().cast("array<int>")
    if searched:
        axis = "z__view"
        while axis in features.names:
            axis += "_"
        prepared = PreparedFeatures([*features.z_names, axis], features.c_names)
        own = F.col(f"`{spec.id_column}`").alias("_id")
        # Of a copy only the judged column is carried along.
        payload = [F.when(F.col("_view") == i, F.col(columns[i])).alias(columns[i]) for i in searched]
        near_rows = _views(reference, features, searched, axis).select(*prepared.names, own, *payload)
        index = NeighbourIndex(
            near_rows, prepared, "_id", [columns[i] for i in searched], spec.knn_neighbors, seed=spec.random_state
        )
        asked = _views(rows, features, searched, axis).select(*prepared.names, own, "_row", "_view", *columns)
        near = index.k_nearest(asked, exclude_self="_id", name="_near")
        near = near.withColumn("_near", F.filter("_near", lambda n: n["dist2"] < VIEW_GAP))
        verdicts = odd_views(near, spec, {i: columns[i] for i in searched})
        rows, found = rows.join(verdicts, "_row", "left"), F.col("_odd")
    names = [
        F.when(F.array_contains(found, i) if i in searched else F.col(c).isNull(), F.lit(c))
        for i, c in enumerate(columns)
    ]
    out = cut_lineage(
        rows.withColumn("suspects", F.array_compact(F.array(*names))).select(*df.columns, "suspects"), "left_out", kept
    )
    if searched:
        index.close()
    return out


def anomaly_findings(df: DataFrame, spec: QualitySpec) -> Column:
    """Findings of the columns named in ``suspects``, with the anomaly's confidence."""
    types = {f.name: f.dataType for f in df.schema.fields}
    found = []
    confidence = cells.clamp(F.abs(F.col("decision_score")) * CONFIDENCE_PER_DECISION)
    for place, c in enumerate(attributable_columns(df, spec)):
        entry = F.struct(
            F.lit(issue_seq(ANOMALY, place)).cast("long").alias("issue_seq"),
            F.lit(c).alias("column_name"),
            F.lit("anomaly").alias("issue_type"),
            F.col(c).cast("string").alias("current_value"),
            cells.to_number(F.col(c), types[c]).alias("current_num"),
            F.lit(PLACEHOLDER_SCORE).alias("severity_score"),
            F.lit(PLACEHOLDER_SEVERITY).alias("severity"),
            F.lit(f"Column '{c}' deviates from similar normal records.").alias("reason"),
            F.lit(ANOMALY_METHOD).alias("source_method"),
            confidence.alias("confidence"),
        )
        found.append(F.when(F.array_contains("suspects", c), entry))
    return F.array_compact(F.array(*found))
