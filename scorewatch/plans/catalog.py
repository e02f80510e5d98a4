"""Every registered query: operators applied to the review views of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import PATHS, Thresholds, config_rows
from ..config import config_documents as config_documents_of
from ..operators import (
    boosting,
    calibration,
    cluster,
    collinearity,
    drift,
    evidence,
    explain,
    feedback,
    impute,
    lift,
    quality,
    risk,
    runs,
    segments,
    selection,
)
from ..session import shared_path, stored
from ..sources import readers, sinks
from ..sources import review_views as views
from . import oracles
from .review import Review

FEATURES = views.FEATURES
FLEET = ["model_id"]
T = Thresholds()
METADATA = {
    "model_name": "order_returns",
    "model_type": "classification",
    "target": "label",
    "entity_id": "entity_id",
    "prediction_column": "score",
    "business_use_case": "",
    "decision_supported": "return handling",
    "feature_columns": [*FEATURES, "loyalty_tier"],
}


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Chosen columns with doubles rounded to six places, for comparison with other engines."""
    names = columns or tuple(df.columns)
    kinds = dict(df.dtypes)
    return df.selectExpr(*[f"round(`{c}`, 6) AS `{c}`" if kinds[c] == "double" else f"`{c}`" for c in names])


def _window(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col("win") == name)


# ---------------------------------------------------------------- drift and quality


def contract_violations(spark, d):
    f, p = views.features(spark, d), views.predictions(spark, d)
    tables = {
        "train_features": _window(f, "train"),
        "current_features": _window(f, "current"),
        "current_predictions": _window(p, "current"),
    }
    return quality.contract_violations(spark, tables, METADATA, defined_features=FEATURES)


def _imputed(from_window):
    def query(spark, d):
        f = views.features(spark, d).select("entity_id", "win", *FEATURES)
        groups = [] if from_window else ["win"]
        return rounded(impute.median_imputed(f, FEATURES, groups, from_window), "entity_id", "win", *FEATURES)

    return query


def mean_shift(spark, d):
    return rounded(drift.feature_profile(views.features(spark, d), FEATURES), "feature", "train_mean", "current_mean", "mean_change_pct")


def _quality(spark, d, groups=()):
    return quality.data_quality_report(
        views.features(spark, d), views.predictions(spark, d), FEATURES, "entity_id", "score", "label", groups, T, views.BOUNDS
    )


def data_quality_report(spark, d):
    return rounded(_quality(spark, d), "check_type", "dataset", "feature", "current_value", "change_value", "issue_level", "message", "issue_reason")


def duplicate_entity_rate(spark, d):
    rates = quality.duplicate_entity_rate(views.lineitem(spark, d), ["l_orderkey", "l_linenumber"])
    with_distinct = rates.withColumn("distinct_rows", F.expr("row_count - duplicate_rows"))
    return rounded(with_distinct, "row_count", "distinct_rows", "duplicate_rows", "duplicate_rate")


def missing_rate_shift(spark, d):
    return rounded(drift.missing_rate_shift(drift.feature_profile(views.features(spark, d), FEATURES)))


def material_missing(spark, d):
    profile = drift.feature_profile(views.features(spark, d), FEATURES)
    return rounded(drift.material_missing(profile), "feature", "missing_rate_change_pct_points")


def boundary_violations(spark, d):
    return rounded(quality.boundary_violations(views.features(spark, d), FEATURES, views.BOUNDS))


def score_out_of_range(spark, d):
    return rounded(quality.score_out_of_range(views.predictions(spark, d)))


def quality_issue_counts(spark, d):
    return quality.issue_counts(_quality(spark, d, FLEET), FLEET)


def _distance(measure, column):
    def query(spark, d):
        return rounded(drift.distances(views.features(spark, d), FEATURES, measures=[measure]), "feature", column)

    return query


def feature_ks_pvalue(spark, d):
    ks = drift.with_ks_pvalue(drift.distances(views.features(spark, d), FEATURES, measures=["ks"]))
    return rounded(ks, "feature", "ks_statistic", "ks_pvalue")


DRIFT_COLUMNS = (
    "feature",
    "train_mean",
    "current_mean",
    "mean_change_pct",
    "train_missing_rate",
    "current_missing_rate",
    "missing_rate_change_pct_points",
    "psi",
    "ks_statistic",
    "ks_pvalue",
    "wasserstein_distance",
    "drift_level",
)


def _drift(spark, d, groups=()):
    return drift.feature_drift_report(views.features(spark, d), FEATURES, groups, T)


def full_drift_report(spark, d):
    """The flagship report with every column."""
    return _drift(spark, d)


def feature_drift_report(spark, d):
    # the p-value inside the sentence is printed to four digits; compared as "crossed"
    short = F.expr("regexp_replace(drift_level_reason, '(because KS p-value).*', '$1 crossed')")
    report = _drift(spark, d).withColumn("drift_level_reason", short)
    return rounded(report, *DRIFT_COLUMNS, "drift_level_reason", "recommended_action")


def fleet_feature_drift(spark, d):
    return rounded(_drift(spark, d, FLEET), *FLEET, *DRIFT_COLUMNS)


def top_drift_features(spark, d):
    return rounded(drift.top_drift(_drift(spark, d), 4), "feature", "psi")


def drift_levels(spark, d):
    return drift.drift_at_level(_drift(spark, d, FLEET), "High", "Medium").select(*FLEET, "feature", "drift_level")


def prediction_drift_summary(spark, d):
    summary = drift.prediction_drift_summary(views.predictions(spark, d), "score", (), T)
    hidden = ("available", "reference_available", "prediction_drift_reason", "recommended_action", "config_version")
    return rounded(summary, *[c for c in summary.columns if c not in hidden])


def label_mix_shift(spark, d):
    return rounded(drift.label_mix_shift(views.predictions(spark, d), FLEET))


def score_histogram(spark, d):
    return rounded(drift.score_histogram(views.predictions(spark, d)))


def cluster_share_shift(spark, d):
    return rounded(cluster.cluster_share_shift(views.features(spark, d), FEATURES, T, group_cols=FLEET).drop("config_version"))


# ---------------------------------------------------------------- calibration, lift, segments


def _current(spark, d):
    return _window(views.predictions(spark, d), "current")


def calibration_bins(spark, d):
    return rounded(calibration.calibration_bins(_current(spark, d)))


def brier_score(spark, d):
    return rounded(calibration.brier_score(_current(spark, d), group_cols=FLEET))


def expected_calibration_error(spark, d):
    return rounded(calibration.calibration_summary(_current(spark, d)), "expected_calibration_error")


def calibration_summary(spark, d):
    return rounded(calibration.calibration_summary(_current(spark, d), group_cols=FLEET).drop("reason"))


def score_deciles(spark, d):
    return rounded(lift.score_deciles(_current(spark, d)))


def lift_table(spark, d):
    return rounded(lift.lift_table(lift.score_deciles(_current(spark, d))))


def fleet_lift_table(spark, d):
    return rounded(lift.lift_table(lift.score_deciles(_current(spark, d), group_cols=FLEET), FLEET))


def lift_summary(spark, d):
    return rounded(lift.lift_summary(lift.lift_table(lift.score_deciles(_current(spark, d)))))


def _scored(spark, d, groups=()):
    return segments.scored_features(
        _window(views.features(spark, d), "current"), _current(spark, d), FEATURES, "entity_id", group_cols=list(groups)
    )


def scored_features(spark, d):
    return rounded(_scored(spark, d), "entity_id", *FEATURES, "score", "label")


def segment_performance(spark, d):
    return rounded(segments.segment_performance(_scored(spark, d), FEATURES).drop("risk_reason"))


def segment_equal_width(spark, d):
    """Prices with infinities planted: equal-width bins of the finite ones."""
    planted = "CASE entity_id % 31 WHEN 0 THEN double('infinity') WHEN 1 THEN double('-infinity') ELSE price END"
    report = segments.segment_performance(_scored(spark, d).withColumn("price", F.expr(planted)), ["price"])
    return rounded(report.drop("risk_reason"), "segment", "count", "count_share", "avg_score", "actual_rate", "brier_score")


def segment_summary(spark, d):
    report = segments.segment_performance(_scored(spark, d, FLEET), FEATURES, FLEET)
    return rounded(segments.segment_summary(report, FLEET))


def segment_heatmap(spark, d):
    return rounded(segments.segment_heatmap(segments.segment_performance(_scored(spark, d), FEATURES)))


def overfitting_delta(spark, d):
    return rounded(runs.overfitting_delta(views.runs(spark, d)).drop("reason"))


# ---------------------------------------------------------------- collinearity and explanations


def _vif(spark, d, groups=FLEET):
    return collinearity.feature_vif(_window(views.features(spark, d), "train"), FEATURES, groups)


def feature_vif(spark, d):
    return rounded(_vif(spark, d).drop("vif_risk_reason"))


def _importance(spark, d):
    return explain.label_correlation_importance(views.features(spark, d), FEATURES, "label", FLEET)


def importance_rank(spark, d):
    return rounded(_importance(spark, d).drop("mean_abs_shap_value"))


def _fitted(spark, d):
    """The stored features and the reviewing model of every model of the fleet."""
    f = stored(views.features(spark, d), "features")
    return f, boosting.fit(f, FEATURES, "label", FLEET, "entity_id")


def tree_attribution_importance(spark, d):
    f, reviewer = _fitted(spark, d)
    return explain.tree_attribution_importance(f, FEATURES, "label", model=reviewer, group_cols=FLEET)


def _attributed(spark, d):
    f, reviewer = _fitted(spark, d)
    current = impute.median_imputed(_window(f, "current"), FEATURES, FLEET)
    return current, reviewer, explain.attributed_rows(reviewer, current)


def row_attributions(spark, d):
    return explain.long_attributions(_attributed(spark, d)[2], FEATURES, [*FLEET, "entity_id"])


def attribution_check(spark, d):
    """Per model: rows explained, their feature values, and whether attributions and base add up to the margin everywhere."""
    current, reviewer, wide = _attributed(spark, d)
    total = "+".join(f"phi_{f}" for f in FEATURES)
    explained = reviewer.numbered(wide.withColumn("explained", F.expr(total)))
    found = explain.with_margins(reviewer, explained)
    gap = F.expr("abs(explained + attribution_base - margin)")
    return found.groupBy(*FLEET).agg(
        F.count("*").alias("explained_rows"),
        *[F.round(F.avg(f), 6).alias(f"mean_{f}") for f in FEATURES],
        (F.max(gap) < 1e-9).alias("adds_up"),
    )


def permutation_importance(spark, d):
    f, reviewer = _fitted(spark, d)
    return explain.permutation_importance(f, FEATURES, "label", reviewer, group_cols=FLEET)


def reliability_gate(spark, d):
    gate = explain.reliability_gate(_drift(spark, d, FLEET), FLEET, T)
    names = F.expr("array_join(transform(severe_drift_features, x -> x.feature), ',') AS severe_names")
    return gate.select(*FLEET, "status", "gate_mode", "should_skip", "severe_features", names)


# ---------------------------------------------------------------- fusion


def _review(spark, d) -> Review:
    """A review of every model of the fleet; importance is the label correlation, comparable in plain SQL."""
    # the inputs are joins over the raw tables: stored once, as a feature table would be
    features_df = stored(views.features(spark, d), "features")
    return Review(
        features_df,
        stored(views.predictions(spark, d), "predictions"),
        FEATURES,
        group_cols=FLEET,
        thresholds=T,
        bounds=views.BOUNDS,
        importance=explain.label_correlation_importance(features_df, FEATURES, "label", FLEET),
        model_runs=views.model_runs(spark, d),
    )


def run_risk_decision(spark, d):
    return _review(spark, d).decision.selectExpr(
        *FLEET,
        "overall_risk_level",
        "primary_reason",
        "size(triggered_rules) AS rules_fired",
        "nullif(array_join(triggered_rules, ' '), '') AS triggered_rules",
    )


def recommended_checks(spark, d):
    return _review(spark, d).checks


MATRIX_COLUMNS = (
    "model_id",
    "feature",
    "shap_rank",
    "mean_abs_shap",
    "psi",
    "ks_pvalue",
    "wasserstein_distance",
    "drift_level",
    "vif",
    "vif_risk",
    "final_risk",
)


def feature_risk_matrix(spark, d):
    return rounded(_review(spark, d).matrix, *MATRIX_COLUMNS)


def risk_scatter_frame(spark, d):
    return rounded(risk.risk_scatter_frame(_review(spark, d).matrix, group_cols=FLEET).drop("reason"))


def key_findings(spark, d):
    return _review(spark, d).findings


def recommended_actions(spark, d):
    return _review(spark, d).actions


def model_health_status(spark, d):
    return _review(spark, d).health


def top_drivers(spark, d):
    return risk.top_drivers(_importance(spark, d), FLEET, rank="label correlation rank", measure="|correlation|")


def tree_top_drivers(spark, d):
    """The lines of the fitted trees; `tree_risk_matrix` has the figures."""
    f, reviewer = _fitted(spark, d)
    return risk.top_drivers(explain.tree_attribution_importance(f, FEATURES, "label", model=reviewer, group_cols=FLEET), FLEET)


def tree_risk_matrix(spark, d):
    """The matrix of a whole fleet, fed by its own trees."""
    review = Review(
        stored(views.features(spark, d), "features"), views.predictions(spark, d), FEATURES, group_cols=FLEET, thresholds=T
    )
    return rounded(review.matrix, *MATRIX_COLUMNS)


def high_risk_lines(spark, d):
    return risk.high_risk_lines(_review(spark, d).matrix, FLEET)


def evidence_packet(spark, d):
    return _review(spark, d).packet()


def evidence_paths(spark, d):
    """The packet's values, section by section and path by path: how many, their sum, the least and the greatest text."""
    values = evidence.flattened(_review(spark, d).packet(), FLEET)
    wanted = spark.createDataFrame([(s, p) for s, (_, paths) in oracles.PACKET.items() for p in paths], "section string, path string")
    shown = F.when(F.col("number").isNull(), F.col("text"))
    return values.join(F.broadcast(wanted), ["section", "path"]).groupBy(*FLEET, "section", "path").agg(
        F.count("*").alias("records"),
        F.round(F.sum(F.round("number", 6)), 4).alias("total"),
        F.min(shown).alias("least"),
        F.max(shown).alias("greatest"),
    )


# ---------------------------------------------------------------- feedback


def feedback_summary(spark, d):
    return feedback.feedback_summary(views.feedback(spark, d), ["run_id"])


def feedback_patterns(spark, d):
    return feedback.feedback_patterns(views.feedback(spark, d), ["run_id"], T)


def _recommendations(spark, d):
    return feedback.calibration_recommendations(feedback.feedback_patterns(views.feedback(spark, d), ["run_id"], T), ["run_id"])


def calibration_recommendations(spark, d):
    return _recommendations(spark, d).select(
        "run_id", "recommendation_id", "change_type", "target_config_path", "feature", "recommended_value", "confidence"
    )


def proposed_config(spark, d):
    reviews = views.runs(spark, d).select("run_id")
    return feedback.proposed_config(config_rows(spark, T), _recommendations(spark, d), ["run_id"], reviews)


def human_review(spark, d):
    """Recommendations by model, with a human review where a risky model has no feedback."""
    review, events = _review(spark, d), views.model_feedback(spark, d)
    found = feedback.calibration_recommendations(
        feedback.feedback_patterns(events, FLEET, T), FLEET, health=review.health, feedback=events, matrix=review.matrix
    )
    return found.select(*FLEET, "recommendation_id", "change_type", "feature", "confidence")


def config_documents(spark, d):
    """The thresholds of every run's file; values as numbers where they are."""
    found = config_documents_of(views.configs(spark, d), "run_id", "config")
    number = F.expr("round(try_cast(value AS DOUBLE), 6)")
    return found.select("run_id", "field", number.alias("number"), F.when(number.isNull(), F.col("value")).alias("text"), "given")


def feature_selection(spark, d):
    """Columns chosen from the schemas of the views, with the known train cells of each chosen feature."""
    f, p = views.features(spark, d), views.predictions(spark, d)
    declared = ["price", "loyalty_tier", "win", "qty"]
    chosen = {
        "review_declared": selection.review_features(f, f, declared, "label", "entity_id"),
        "review_all": selection.review_features(f, f.drop("urgent"), (), "label", "entity_id"),
        "model_declared": selection.model_features(f, f, declared, "label", "entity_id"),
        "model_all": selection.model_features(f.join(p.drop("model_id", "win"), "entity_id"), f, (), "label", "entity_id", "model_id"),
    }
    known = _window(f, "train").agg(*[F.count(c).alias(c) for c in f.columns])
    known = known.unpivot([], f.columns, "feature", "known_cells")
    rows = [(kind, place, c) for kind, names in chosen.items() for place, c in enumerate(names)]
    return spark.createDataFrame(rows, "chosen_by string, place int, feature string").join(F.broadcast(known), "feature", "left")


def feedback_intake(spark, d):
    accepted, rejected = feedback.validate_events(views.feedback(spark, d))
    both = accepted.select(F.lit("accepted").alias("outcome"), "feedback_type").unionAll(
        rejected.select(F.lit("rejected").alias("outcome"), "feedback_type")
    )
    return both.groupBy("outcome", "feedback_type").agg(F.expr("count(*) AS events"))


def legacy_feedback(spark, d):
    signal = "CASE event_type WHEN 'view' THEN 'useful' WHEN 'click' THEN 'not useful' WHEN 'error' THEN 'false positive'"
    old = views.events(spark, d).selectExpr(
        "concat('agent_', string(user_id % 3)) AS agent", f"{signal} ELSE event_type END AS signal", "'' AS comment"
    )
    remapped = feedback.legacy_feedback(old)
    return remapped.groupBy("feedback_type", "related_agent", "user_role").agg(F.expr("count(*) AS events"))


def feedback_load(spark, d):
    loaded = feedback.with_contract(views.feedback(spark, d))
    return loaded.groupBy("run_id", "feedback_type", "feature", "severity").agg(F.expr("count(*) AS events"))


def change_log(spark, d):
    log = feedback.change_log(_recommendations(spark, d))
    return log.select("run_id", "recommendation_id", "reason", "status", "note", "requires_human_approval")


# ---------------------------------------------------------------- sources and sinks


def table_scan(spark, d):
    readers.require_paths(spark, [f"{d}/orders.parquet"])
    found = readers.read_table(spark, f"{d}/orders.parquet").groupBy("o_orderpriority").agg(F.expr("count(*) AS orders"))
    absent = readers.read_reference(spark, f"{d}/no_such_table.parquet") is None
    return found.withColumn("reference_absent", F.lit(absent))


def _window_counts(spark, d):
    return views.features(spark, d).groupBy("model_id", "win").agg(F.expr("count(*) AS n"))


def archived_reports(spark, d):
    """Two runs kept, the second written twice: a rerun replaces itself only."""
    path, report = shared_path(spark, "archive"), _window_counts(spark, d)
    sinks.write_report(report, path, "run_a")
    sinks.write_report(report, path, "run_b")
    sinks.write_report(report.withColumn("n", F.expr("n * 2")), path, "run_b", replace=True)
    return spark.read.parquet(path).select("run_id", "model_id", "win", "n")


def nested_reports(spark, d):
    path = shared_path(spark, "nested")
    packet = evidence.evidence_packet(
        views.features(spark, d).select("model_id").distinct(), {"windows": _window_counts(spark, d)}, FLEET
    )
    sinks.write_nested(packet, path, "run_a")
    kept = spark.read.schema("model_id long, windows array<struct<win: string, n: long>>, run_id string").json(path)
    return kept.selectExpr("run_id", "model_id", "inline(windows)")


def upserted_sections(spark, d):
    path, counts = shared_path(spark, "sections"), _window_counts(spark, d)
    sinks.upsert_section(counts.where("win = 'train'"), path, "run_a", "windows")
    sinks.upsert_section(counts, path, "run_a", "other")
    sinks.upsert_section(counts.where("win = 'current'"), path, "run_a", "windows")
    rows = spark.read.parquet(path).withColumn("r", F.from_json("payload", "model_id long, win string, n long"))
    return rows.select("section", "r.*")


def positional_scores(spark, d):
    f = _window(views.features(spark, d), "current").withColumnRenamed("entity_id", "row_no")
    p = _current(spark, d).withColumnRenamed("entity_id", "row_no")
    return rounded(segments.scored_features(f, p, FEATURES, None, position="row_no"), "row_no", *FEATURES, "score", "label")


def segment_order(spark, d):
    report = segments.segment_performance(_scored(spark, d), FEATURES)
    return report.select("feature", "segment", F.monotonically_increasing_id().alias("place"))


def same_run_records(spark, d):
    packet = views.runs(spark, d).where("validation_auc IS NOT NULL")
    same = evidence.same_run(packet, views.feedback(spark, d))
    return same.groupBy("run_id").agg(F.expr("count(*) AS records"))


def queries():
    named = [
        legacy_feedback,
        feedback_load,
        change_log,
        table_scan,
        archived_reports,
        nested_reports,
        upserted_sections,
        positional_scores,
        segment_order,
        same_run_records,
        contract_violations,
        mean_shift,
        data_quality_report,
        duplicate_entity_rate,
        missing_rate_shift,
        material_missing,
        boundary_violations,
        score_out_of_range,
        quality_issue_counts,
        feature_ks_pvalue,
        feature_drift_report,
        fleet_feature_drift,
        top_drift_features,
        drift_levels,
        prediction_drift_summary,
        label_mix_shift,
        score_histogram,
        cluster_share_shift,
        calibration_bins,
        brier_score,
        expected_calibration_error,
        calibration_summary,
        score_deciles,
        lift_table,
        fleet_lift_table,
        lift_summary,
        scored_features,
        segment_performance,
        segment_equal_width,
        segment_summary,
        segment_heatmap,
        overfitting_delta,
        feature_vif,
        importance_rank,
        tree_attribution_importance,
        row_attributions,
        attribution_check,
        permutation_importance,
        reliability_gate,
        run_risk_decision,
        recommended_checks,
        feature_risk_matrix,
        risk_scatter_frame,
        key_findings,
        recommended_actions,
        model_health_status,
        top_drivers,
        tree_top_drivers,
        tree_risk_matrix,
        high_risk_lines,
        evidence_packet,
        evidence_paths,
        feedback_summary,
        feedback_patterns,
        calibration_recommendations,
        proposed_config,
        feedback_intake,
        human_review,
        config_documents,
        feature_selection,
    ]
    found = {q.__name__: q for q in named}
    found["median_imputed"] = _imputed(None)
    found["train_median_imputed"] = _imputed("train")
    found["feature_psi"] = _distance("psi", "psi")
    found["feature_ks"] = _distance("ks", "ks_statistic")
    found["feature_wasserstein"] = _distance("wasserstein", "wasserstein_distance")
    return found


def oracle_sql():
    return oracles.oracle_sql([(path, str(getattr(T, field))) for path, field in PATHS.items()])
