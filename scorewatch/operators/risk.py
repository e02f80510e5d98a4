"""Fusing the reports of a review: run decision, feature-risk matrix, findings, actions, health status.

Every input is a small report table (rows per feature or per run). `group_cols` tells reviews apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Thresholds
from ..functions.clean import level_order
from ..functions.text import choose, fixed, quote, sentence
from ..session import join_per_group, keyed_join, ordered


def _sql(group_cols) -> list[str]:
    return [f"`{g}`" for g in group_cols]


def _partition(group_cols) -> str:
    return ", ".join(_sql(group_cols)) or "1"


# ---------------------------------------------------------------- run decision


def risk_counts(
    quality: DataFrame, drift: DataFrame, score: DataFrame | None = None, cluster: DataFrame | None = None, group_cols=()
) -> DataFrame:
    """The figures the run decision looks at, one row per review."""
    counts = quality.groupBy(*group_cols).agg(
        F.expr("count_if(issue_level = 'High') AS high_issues"), F.expr("count_if(issue_level = 'Medium') AS medium_issues")
    )
    levels = drift.groupBy(*group_cols).agg(
        F.expr("count_if(drift_level = 'High') AS high_drift"),
        F.expr("count_if(drift_level = 'Medium') AS medium_drift"),
        F.expr("count_if(abs(missing_rate_change_pct_points) >= 5) AS material_missing"),
    )
    joined = join_per_group(counts, levels, group_cols)
    if score is not None:
        joined = join_per_group(joined, score.select(*group_cols, "prediction_drift_level"), group_cols)
    else:
        joined = joined.withColumn("prediction_drift_level", F.lit("Unknown"))
    if cluster is not None:
        shift = cluster.groupBy(*group_cols).agg(F.expr("max(abs(share_change_pct_points)) AS cluster_shift"))
        joined = join_per_group(joined, shift, group_cols)
    else:
        joined = joined.withColumn("cluster_shift", F.lit(0.0))
    return joined.fillna(
        {"high_drift": 0, "medium_drift": 0, "material_missing": 0, "cluster_shift": 0.0, "prediction_drift_level": "Unknown"}
    )


def run_risk_decision(counts: DataFrame, group_cols=(), thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Overall level, its first fired rule and all fired rules of that level."""
    t = thresholds

    def shift(which, limit):
        return (
            f"cluster_shift >= {limit}D",
            sentence(
                quote("Max cluster shift "), fixed("cluster_shift", 2), quote(f" pp crossed {which} threshold {limit:.2f} pp.")
            ),
        )

    high = [
        ("high_issues > 0", sentence("string(high_issues)", quote(" high-severity data-quality issue(s) detected."))),
        ("high_drift >= 2", sentence("string(high_drift)", quote(" high-drift feature(s) detected."))),
        shift("high", t.cluster_high_pp),
        ("prediction_drift_level = 'High'", quote("Prediction drift level is High.")),
    ]
    medium = [
        ("medium_issues > 0", sentence("string(medium_issues)", quote(" medium-severity data-quality issue(s) detected."))),
        ("high_drift = 1", quote("One high-drift feature detected.")),
        ("medium_drift >= 2", sentence("string(medium_drift)", quote(" medium-drift feature(s) detected."))),
        shift("medium", t.cluster_medium_pp),
        ("prediction_drift_level = 'Medium'", quote("Prediction drift level is Medium.")),
    ]

    def fired(rules):
        return "array_compact(array(" + ", ".join(f"CASE WHEN {c} THEN {text} END" for c, text in rules) + "))"

    return counts.selectExpr("*", f"{fired(high)} AS fired_high", f"{fired(medium)} AS fired_medium").selectExpr(
        *_sql(group_cols),
        "CASE WHEN size(fired_high) > 0 THEN 'High' WHEN size(fired_medium) > 0 THEN 'Medium' ELSE 'Low' END"
        " AS overall_risk_level",
        "coalesce(get(fired_high, 0), get(fired_medium, 0), 'No configured High or Medium risk rules fired.')"
        " AS primary_reason",
        "CASE WHEN size(fired_high) > 0 THEN fired_high ELSE fired_medium END AS triggered_rules",
    )


# The checks every review recommends, in order, and the conditional ones.
BASE_CHECKS = (
    "Review high-drift features for data pipeline or behavior-shift explanations.",
    "Compare prediction score distribution against the model training baseline when train predictions are available.",
    "Inspect cluster share movement for population-mix changes before high-impact business use.",
)
RESOLVE_FIRST = "Resolve high-severity data quality issues before interpreting model drift."
CHECK_MISSING = "Investigate features with material missing-rate changes."
CHECK_SCORES = "Review prediction score drift against decision thresholds and downstream actions."


def _checks_array() -> str:
    parts = [f"CASE WHEN high_issues > 0 THEN {quote(RESOLVE_FIRST)} END", *[quote(c) for c in BASE_CHECKS]]
    parts.append(f"CASE WHEN material_missing > 0 THEN {quote(CHECK_MISSING)} END")
    parts.append(f"CASE WHEN prediction_drift_level IN ('High', 'Medium') THEN {quote(CHECK_SCORES)} END")
    return f"array_compact(array({', '.join(parts)}))"


def recommended_checks(counts: DataFrame, group_cols=()) -> DataFrame:
    """Ordered checks of a review, one row each."""
    return counts.selectExpr(*_sql(group_cols), f"posexplode({_checks_array()}) AS (check_no, recommended_check)")


# ---------------------------------------------------------------- feature-risk matrix


def feature_risk_matrix(
    importance: DataFrame,
    drift: DataFrame,
    vif: DataFrame,
    metadata: DataFrame | None = None,
    group_cols=(),
) -> DataFrame:
    """Importance, drift, VIF and metadata per feature with the fused risk, riskiest and most important first."""
    keys = [*group_cols, "feature"]
    few = not group_cols  # one row per feature; with groups Spark picks the join from measured sizes
    m = importance.select(*keys, "mean_abs_shap", "shap_rank")
    m = keyed_join(
        m, drift.select(*keys, "psi", "ks_pvalue", "wasserstein_distance", "drift_level"), keys, "left", broadcast=few
    )
    m = keyed_join(m, vif.select(*keys, "vif", "vif_risk"), keys, "left", broadcast=few)
    for c, default in (("feature_group", "model_feature"), ("business_definition", "")):
        if metadata is not None and c in metadata.columns:
            m = keyed_join(m, metadata.select("feature", c), ["feature"], "left").fillna({c: default})
        else:
            m = m.withColumn(c, F.lit(default))
    m = m.fillna(
        {"psi": 0.0, "ks_pvalue": 1.0, "wasserstein_distance": 0.0, "drift_level": "Low", "vif": 1.0, "vif_risk": "Low"}
    )
    rules = [
        (
            "shap_rank <= 5 AND drift_level = 'High'",
            "High",
            "High because the feature is a top-5 SHAP driver with High drift.",
            "Review feature stability and consider recalibration before activation.",
        ),
        (
            "shap_rank <= 5 AND vif_risk = 'High'",
            "High",
            "High because the feature is a top-5 SHAP driver with High VIF risk.",
            "Review redundancy and consider combining or removing correlated features.",
        ),
        (
            "shap_rank <= 10 AND drift_level = 'Medium'",
            "Medium",
            "Medium because the feature is a top-10 SHAP driver with Medium drift.",
            "Monitor feature drift and validate stability in the next review window.",
        ),
        (
            "shap_rank > 5 AND drift_level = 'High'",
            "Medium",
            "Medium because the feature has High drift but is not a top-5 SHAP driver.",
            "Monitor feature drift; lower immediate model-risk impact.",
        ),
    ]
    fallback = ("Low", "Low because no configured feature-risk rule fired.", "No immediate action.")
    level, reason, action = (choose([(r[0], quote(r[i])) for r in rules], quote(fallback[i - 1])) for i in (1, 2, 3))
    matrix = m.selectExpr(
        *[f"`{k}`" for k in keys],
        "feature_group",
        "business_definition",
        "shap_rank",
        "mean_abs_shap",
        "mean_abs_shap AS mean_abs_shap_value",
        "psi",
        "ks_pvalue",
        "wasserstein_distance",
        "drift_level",
        "vif",
        "vif_risk",
        "vif_risk AS vif_warning",
        f"{level} AS final_risk",
        f"{level} AS combined_risk",
        f"{reason} AS reason",
        f"{reason} AS combined_risk_reason",
        f"{action} AS recommended_action",
    )
    return ordered(matrix, group_cols, level_order("final_risk"), "shap_rank")


def risk_scatter_frame(
    matrix: DataFrame,
    importance: DataFrame | None = None,
    drift: DataFrame | None = None,
    vif: DataFrame | None = None,
    group_cols=(),
) -> DataFrame:
    """Plot input: the matrix, missing columns merged from the other reports, defaults, marker size by VIF."""
    keys = [*group_cols, "feature"]
    frame = matrix
    for source, columns in (
        (importance, ["mean_abs_shap", "shap_rank"]),
        (drift, ["psi", "drift_level"]),
        (vif, ["vif", "vif_risk"]),
    ):
        wanted = [c for c in columns if c not in frame.columns]
        if source is not None and wanted:
            frame = keyed_join(frame, source.select(*keys, *wanted), keys, "left", broadcast=not group_cols)
    defaults = {
        "mean_abs_shap": 0.0,
        "shap_rank": 999,
        "psi": 0.0,
        "vif": 1.0,
        "final_risk": "Unknown",
        "drift_level": "Unknown",
        "vif_risk": "Unknown",
        "reason": "No saved risk explanation available.",
    }
    for c, default in defaults.items():
        if c not in frame.columns:
            frame = frame.withColumn(c, F.lit(default))
    size = "CASE WHEN vif IS NULL OR isnan(vif) OR abs(vif) = double('infinity') THEN 1.0D ELSE greatest(1.0D, least(25.0D, vif)) END"
    return frame.selectExpr(*[f"`{k}`" for k in keys], *defaults, f"{size} + 6.0D AS marker_size")


# ---------------------------------------------------------------- findings, actions, status


def key_findings(
    drift: DataFrame, matrix: DataFrame, score: DataFrame, vif: DataFrame, overfitting: DataFrame | None = None, group_cols=()
) -> DataFrame:
    """Ordered sentences without repeats."""
    keys, keep = [*group_cols, "feature"], _sql(group_cols)
    partition = _partition(group_cols)
    inside = matrix.select(*keys).withColumn("in_matrix", F.lit(True))
    high = keyed_join(drift.where("drift_level = 'High'"), inside, keys, "left", broadcast=not group_cols)
    parts = [
        high.selectExpr(
            *keep,
            "1 AS part",
            f"row_number() OVER (PARTITION BY {partition} ORDER BY psi DESC, feature) AS place",
            "concat(feature, ' is high drift', CASE WHEN in_matrix THEN ' and appears in the feature risk matrix' ELSE '' END,"
            " '.') AS finding",
        ),
        matrix.where("final_risk = 'High'").selectExpr(
            *keep,
            "2 AS part",
            "int(shap_rank) AS place",
            "concat(feature, ' is a high-risk feature because it is model-important and has ', lower(drift_level),"
            " ' drift.') AS finding",
        ),
        score.where("prediction_drift_level <> 'Unknown'").selectExpr(
            *keep,
            "3 AS part",
            "1 AS place",
            "concat('Prediction drift is ', prediction_drift_level,"
            " ' based on score distribution shift and KS p-value.') AS finding",
        ),
        vif.where("vif_risk = 'High'").selectExpr(
            *keep,
            "4 AS part",
            f"row_number() OVER (PARTITION BY {partition} ORDER BY vif DESC, feature) AS place",
            "concat('VIF risk is High for ', feature, '.') AS finding",
        ),
    ]
    if overfitting is not None:
        parts.append(
            overfitting.where("risk_level NOT IN ('Low', 'Not Available')").selectExpr(
                *keep,
                "5 AS part",
                "1 AS place",
                "concat('Train-validation AUC delta indicates ', lower(risk_level), ' overfitting risk.') AS finding",
            )
        )
    every = parts[0]
    for p in parts[1:]:
        every = every.unionAll(p)
    first = every.groupBy(*group_cols, "finding").agg(F.expr("min(struct(part, place)) AS at"))
    return first.selectExpr(
        *keep, f"row_number() OVER (PARTITION BY {partition} ORDER BY at, finding) AS finding_no", "finding"
    )


# Actions in order.
STABILITY = "Review high-risk feature stability and consider recalibration before activation."
VALIDATE = "Run validation before campaign or model activation because prediction drift is High."
PIPELINES = "Review upstream data pipelines for medium or high data-quality issues."
REDUNDANCY = "Review feature redundancy and consider consolidating high-VIF features."
REDUNDANCY_RECHECK = "Review redundancy and consider consolidating high-VIF features."


def recommended_actions(counts: DataFrame, matrix: DataFrame, vif: DataFrame, group_cols=()) -> DataFrame:
    """Ordered actions without repeats: the evidence rules, the checks, then the executive re-check."""
    features = matrix.groupBy(*group_cols).agg(
        F.expr("bool_or(final_risk = 'High') AS any_high_risk"),
        F.expr("bool_or(shap_rank <= 5 AND drift_level = 'High') AS top_high_drift"),
        F.expr("bool_or(vif_risk = 'High') AS matrix_high_vif"),
    )
    redundant = vif.groupBy(*group_cols).agg(F.expr("bool_or(vif_risk = 'High') AS any_high_vif"))
    joined = join_per_group(join_per_group(counts, features, group_cols), redundant, group_cols)

    def when(condition, text):
        return f"CASE WHEN {condition} THEN {quote(text)} END"

    quality, scores = "high_issues + medium_issues > 0", "prediction_drift_level = 'High'"
    before = ", ".join(
        [when("any_high_risk", STABILITY), when(scores, VALIDATE), when(quality, PIPELINES), when("any_high_vif", REDUNDANCY)]
    )
    after = ", ".join(
        [
            when("top_high_drift", STABILITY),
            when(scores, VALIDATE),
            when(quality, PIPELINES),
            when("matrix_high_vif", REDUNDANCY_RECHECK),
        ]
    )
    # array_distinct keeps the first occurrence
    actions = f"array_distinct(concat(array_compact(array({before})), {_checks_array()}, array_compact(array({after}))))"
    return joined.selectExpr(*_sql(group_cols), f"posexplode({actions}) AS (action_no, action)")


def model_health_status(decision: DataFrame, matrix: DataFrame, group_cols=()) -> DataFrame:
    features = matrix.groupBy(*group_cols).agg(
        F.expr("bool_or(final_risk = 'High' AND shap_rank <= 5 AND drift_level = 'High') AS top_high_drift"),
        F.expr("count_if(final_risk = 'Medium') AS medium_features"),
    )
    joined = join_per_group(decision.select(*group_cols, "overall_risk_level"), features, group_cols)
    return joined.selectExpr(
        *_sql(group_cols),
        "CASE WHEN overall_risk_level = 'High' OR coalesce(top_high_drift, false) THEN 'High Risk'"
        " WHEN overall_risk_level = 'Medium' OR coalesce(medium_features, 0) >= 2 THEN 'Medium Risk'"
        " ELSE 'Low Risk' END AS model_health_status",
    )


def top_drivers(importance: DataFrame, group_cols=(), k: int = 5, rank: str = "SHAP rank", measure: str = "mean |SHAP|") -> DataFrame:
    """One line per leading feature; `rank` and `measure` name what the importance is."""
    text = sentence(
        "feature", quote(f" is {rank} "), "string(shap_rank)", quote(f" with {measure} "), fixed("mean_abs_shap", 4), "'.'"
    )
    return importance.where(F.col("shap_rank") <= k).selectExpr(*_sql(group_cols), "shap_rank", f"{text} AS driver")


def high_risk_lines(matrix: DataFrame, group_cols=()) -> DataFrame:
    return matrix.where("final_risk = 'High'").selectExpr(
        *_sql(group_cols), "feature", "concat(feature, ': ', reason) AS line"
    )
