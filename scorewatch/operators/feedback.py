"""Analyst feedback: intake, summaries, repeat patterns and proposed threshold changes (never applied)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Thresholds
from ..functions.text import quote
from ..session import join_per_group, keyed_join

# Fixed values.
COLUMNS = (
    "timestamp",
    "run_id",
    "user_role",
    "finding_id",
    "feature",
    "feedback_type",
    "severity",
    "comment",
    "related_agent",
    "action_taken",
)
DEFAULTS = {"run_id": "unknown", "user_role": "unknown", "severity": "Not Set"}
ALLOWED_TYPES = (
    "helpful",
    "not_helpful",
    "false_alarm",
    "accepted_recommendation",
    "rejected_recommendation",
    "too_technical",
    "too_vague",
    "needs_more_detail",
    "wrong_audience",
    "requires_follow_up",
)
LEGACY_SIGNALS = {"useful": "helpful", "not useful": "not_helpful", "false positive": "false_alarm"}
READER_ROLES = ("executive", "client_safe", "client")


def _sql(columns) -> list[str]:
    return [f"`{c}`" for c in columns]


def _partition(group_cols) -> str:
    return ", ".join(_sql(group_cols)) or "1"


def _in(values) -> str:
    return "(" + ", ".join(quote(v) for v in values) + ")"


def legacy_feedback(signals: DataFrame) -> DataFrame:
    """Old (agent, signal, comment) events in the governed columns."""
    cases = " ".join(f"WHEN {quote(a)} THEN {quote(b)}" for a, b in LEGACY_SIGNALS.items())
    return signals.selectExpr(
        "*", f"CASE signal {cases} ELSE signal END AS feedback_type", "agent AS related_agent", "'analyst' AS user_role"
    ).drop("signal", "agent")


def with_contract(df: DataFrame) -> DataFrame:
    """The ten governed text columns; missing columns and NULLs become ''."""
    return df.selectExpr(*[f"coalesce(string(`{c}`), '') AS {c}" if c in df.columns else f"'' AS {c}" for c in COLUMNS])


def validate_events(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split new events into accepted and rejected ones; absent fields take their defaults.

    An unknown feedback type is rejected with a reason.
    """
    filled = []
    for c in COLUMNS:
        default = "string(current_timestamp())" if c == "timestamp" else quote(DEFAULTS.get(c, ""))
        value = f"coalesce(string(`{c}`), {default})" if c in events.columns else default
        if c in ("feedback_type", "comment"):
            value = f"trim({value})"
        filled.append(f"{value} AS {c}")
    rows = events.selectExpr(*filled)
    known = f"feedback_type IN {_in(ALLOWED_TYPES)}"
    rejected = rows.where(f"NOT ({known})").selectExpr(
        "*", "concat('Unsupported feedback_type `', feedback_type, '`.') AS reject_reason"
    )
    return rows.where(known), rejected


def feedback_summary(feedback: DataFrame, group_cols=()) -> DataFrame:
    """Event counts in total, by type, agent, role and non-blank feature, in one pass over the log."""
    dims = ("feedback_type", "related_agent", "user_role", "feature")
    kinds = {"feedback_type": "by_type", "related_agent": "by_agent", "user_role": "by_role", "feature": "by_feature"}
    # one map-side combined aggregate to the few distinct combinations; the sets are taken over those
    base = feedback.groupBy(*group_cols, *dims).agg(F.expr("count(*) AS n"))
    structs = ["struct('total' AS summary, '' AS item)"]
    structs += [f"struct({quote(kinds[d])} AS summary, `{d}` AS item)" for d in dims]
    rows = base.selectExpr(*_sql(group_cols), "n", f"inline(array({', '.join(structs)}))")
    kept = rows.where("summary <> 'by_feature' OR trim(item) <> ''").where("item IS NOT NULL")
    return kept.groupBy(*group_cols, "summary", "item").agg(F.expr("sum(n) AS events"))


def feedback_patterns(feedback: DataFrame, group_cols=(), thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Repeated feedback: false alarms and acceptances by feature, rejections by finding, 'too technical' by readers."""
    pattern = (
        "CASE WHEN feedback_type = 'false_alarm' THEN 'repeated_false_alarm'"
        " WHEN feedback_type = 'accepted_recommendation' THEN 'repeated_accepted_recommendation'"
        " WHEN feedback_type = 'rejected_recommendation' THEN 'repeated_rejected_recommendation'"
        f" WHEN feedback_type = 'too_technical' AND user_role IN {_in(READER_ROLES)} THEN 'executive_too_technical' END"
    )
    item = (
        "CASE feedback_type WHEN 'false_alarm' THEN feature WHEN 'accepted_recommendation' THEN feature"
        " WHEN 'rejected_recommendation' THEN finding_id ELSE '' END"
    )
    rows = feedback.selectExpr(*_sql(group_cols), f"{pattern} AS pattern", f"{item} AS item").where("pattern IS NOT NULL")
    counted = rows.groupBy(*group_cols, "pattern", "item").agg(F.expr("count(*) AS events"))
    return counted.where(
        f"events >= {thresholds.min_feedback_events} AND (item <> '' OR pattern = 'executive_too_technical')"
    )


SEASONAL, PRIORITY = "drift.known_seasonal_features", "drift.high_priority_features"
PROFILE, EVIDENCE = "report.report_profile", "feedback.recommendations_requiring_additional_evidence"
PROFILE_VALUE = '{"max_findings":5,"simplify_language":true,"hide_technical_appendix_by_default":true}'


def calibration_recommendations(
    patterns: DataFrame, group_cols=(), current_lists: dict[str, list[str]] | None = None, health: DataFrame | None = None,
    feedback: DataFrame | None = None, matrix: DataFrame | None = None,
) -> DataFrame:
    """One reviewable recommendation per pattern, numbered REC_001... per review; none is applied.

    `health` (one row per review with model_health_status) with `feedback` adds a human-review row for every review
    that has no feedback at all and is High Risk, or has a High row in `matrix`, the feature-risk matrix.
    """
    keep, lists = _sql(group_cols), current_lists or {}

    def appended(path):
        present = ", ".join(quote(v) for v in lists.get(path, []))
        current = f"CAST(array({present}) AS ARRAY<STRING>)"
        return f"to_json({current})", f"to_json(array_union({current}, array(item)))"

    kinds = [
        (
            "repeated_false_alarm",
            "seasonal_feature_tagging",
            SEASONAL,
            "concat('Repeated false-alarm feedback for ', item, '; review seasonal tagging before suppression.')",
            "false_alarm_count",
            "Medium",
        ),
        (
            "repeated_accepted_recommendation",
            "increase_monitoring_priority",
            PRIORITY,
            "concat('Repeated accepted recommendations for ', item, ' support continued monitoring priority.')",
            "accepted_recommendation_count",
            "High",
        ),
        (
            "executive_too_technical",
            "report_profile_adjustment",
            PROFILE,
            quote("Repeated executive or client-safe feedback indicates that report language is too technical."),
            "executive_too_technical_count",
            "Medium",
        ),
        (
            "repeated_rejected_recommendation",
            "require_more_evidence_before_escalation",
            EVIDENCE,
            "concat('Repeated rejection of ', item, ' indicates that escalation needs more supporting evidence.')",
            "rejected_recommendation_count",
            "Medium",
        ),
    ]

    def pick(values):
        return "CASE pattern " + " ".join(f"WHEN {quote(k[0])} THEN {v}" for k, v in zip(kinds, values)) + " END"

    old_new = [appended(k[2]) if k[2] != PROFILE else ("'[]'", quote(PROFILE_VALUE)) for k in kinds]
    rows = patterns.selectExpr(
        *keep,
        f"{pick([str(i) for i in range(4)])} AS kind_no",
        "events",
        "item",
        f"{pick([quote(k[1]) for k in kinds])} AS change_type",
        f"{pick([quote(k[2]) for k in kinds])} AS target_config_path",
        "item AS feature",
        f"{pick([o for o, _ in old_new])} AS current_value",
        f"{pick([n for _, n in old_new])} AS recommended_value",
        f"{pick([k[3] for k in kinds])} AS reason",
        f"array(concat('feedback_log:', {pick([quote(k[4]) for k in kinds])}, '=', events), 'evidence_packet:key_findings')"
        " AS evidence_used",
        f"{pick([quote(k[5]) for k in kinds])} AS confidence",
    )
    if health is not None and feedback is not None:
        risky = health.selectExpr(*keep, "model_health_status = 'High Risk' AS risky")
        if matrix is not None:
            rows_high = matrix.groupBy(*group_cols).agg(F.expr("bool_or(final_risk = 'High') AS high_row"))
            risky = join_per_group(risky, rows_high, group_cols).selectExpr(*keep, "risky OR coalesce(high_row, false) AS risky")
        risky = risky.where("risky")
        silent = (
            keyed_join(risky, feedback.select(*group_cols).distinct(), group_cols, "left_anti")
            if group_cols
            else join_per_group(risky, feedback.agg(F.expr("count(*) AS seen")), ()).where("seen = 0")
        )
        rows = rows.unionByName(
            silent.selectExpr(
                *keep,
                "4 AS kind_no",
                "0L AS events",
                "'' AS item",
                "'human_review' AS change_type",
                "CAST(NULL AS STRING) AS target_config_path",
                "'' AS feature",
                "CAST(NULL AS STRING) AS current_value",
                "CAST(NULL AS STRING) AS recommended_value",
                "'High-risk deterministic evidence exists, but no analyst feedback has been recorded.' AS reason",
                "array('evidence_packet:high_risk_features', 'health:model_health_status') AS evidence_used",
                "'High' AS confidence",
            )
        )
    # a handful of rows per review
    numbered = rows.withColumn(
        "no",
        F.expr(f"row_number() OVER (PARTITION BY {_partition(group_cols)} ORDER BY kind_no, events DESC, item)"),
    )
    return numbered.selectExpr(
        *keep,
        "format_string('REC_%03d', no) AS recommendation_id",
        "change_type",
        "target_config_path",
        "feature",
        "current_value",
        "recommended_value",
        "reason",
        "evidence_used",
        "confidence",
        "true AS requires_human_approval",
        "'recommended' AS status",
    )


def change_log(recommendations: DataFrame) -> DataFrame:
    """Pending log rows: nothing is approved or rejected by this job."""
    return recommendations.selectExpr(
        "*", "CAST(NULL AS TIMESTAMP) AS decided_at", "'No changes are applied automatically.' AS note"
    )


def proposed_config(
    active: DataFrame, recommendations: DataFrame, group_cols=(), reviews: DataFrame | None = None
) -> DataFrame:
    """Active (path, value) rows overridden by the last recommendation per path, plus new paths and the status.

    With groups one proposal per row of `reviews` (without it: per review that has recommendations); the active rows
    stay as they are.
    """
    keep, keys = _sql(group_cols), [*group_cols, "path"]
    changes = recommendations.where("target_config_path IS NOT NULL").groupBy(
        *group_cols, F.col("target_config_path").alias("path")
    ).agg(F.expr("max_by(recommended_value, int(substr(recommendation_id, 5))) AS proposed"))
    version = active.agg(F.expr("max(config_version) AS based_on"))
    rows = active.where("path <> 'config_version'").select("path", "value")
    if group_cols:
        named = recommendations if reviews is None else reviews
        reviews = named.select(*group_cols).distinct()
        # the active config is one fixed list of paths: carried as one array row, opened per review
        packed = rows.agg(F.expr("sort_array(collect_list(struct(path, value))) AS config"))
        opened = reviews.withColumn("one", F.lit(1)).join(F.broadcast(packed.withColumn("one", F.lit(1))), "one")
        rows = opened.selectExpr(*keep, "inline(config)")
    renamed = changes.withColumnsRenamed({k: f"__{k}" for k in keys})
    on = F.expr(" AND ".join(f"`{k}` <=> `__{k}`" for k in keys))
    merged = rows.join(renamed, on, "full_outer").selectExpr(
        *[f"coalesce(`{g}`, `__{g}`) AS `{g}`" for g in group_cols],
        "coalesce(path, __path) AS path",
        "coalesce(proposed, value) AS value",
        "proposed IS NOT NULL AS changed",
    )
    count = recommendations.groupBy(*group_cols).agg(F.expr("count(*) AS n"))
    if group_cols:
        count = keyed_join(reviews, count, group_cols, "left").fillna(0, ["n"])
    header = join_per_group(count, version, ()) if not group_cols else count.withColumn("one", F.lit(1)).join(
        F.broadcast(version.withColumn("one", F.lit(1))), "one"
    )
    head = header.selectExpr(
        *keep,
        "inline(array("
        "struct('config_version' AS path, 'v2_recommended' AS value),"
        "struct('version' AS path, 'v2_recommended' AS value),"
        "struct('generated_by' AS path, 'scorewatch' AS value),"
        "struct('based_on' AS path, based_on AS value),"
        "struct('approval_status' AS path, CASE WHEN n > 0 THEN 'pending_human_review'"
        " ELSE 'no_changes_recommended' END AS value)))",
    ).withColumn("changed", F.lit(False))
    return merged.unionByName(head)
