"""A whole review: every report of one or many models, each computed once, then fused and saved."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Thresholds
from ..operators import (
    boosting,
    calibration,
    cluster,
    collinearity,
    drift,
    evidence,
    explain,
    lift,
    quality,
    rank,
    risk,
    runs,
    segments,
)
from ..functions.text import quote
from ..session import pin
from ..sources import sinks

MAX_SEGMENT_FEATURES = 5


class Review:
    """Reports over a features frame and a predictions frame, both holding the train and current window.

    Reports have one row per feature, bin, segment or finding; each is pinned when first used, so fused results
    read finished tables instead of planning the inputs again.
    """

    def __init__(
        self,
        features_df: DataFrame,
        preds: DataFrame,
        features,
        entity: str = "entity_id",
        score: str = "score",
        target: str = "label",
        label: str = "actual_label",
        group_cols=(),
        thresholds: Thresholds = Thresholds(),
        bounds: dict | None = None,
        columns: dict[str, list[str]] | None = None,
        metadata: DataFrame | None = None,
        model_runs: DataFrame | None = None,
        importance: DataFrame | None = None,
        vif_features=None,
        sources: dict[str, str] | None = None,
        feature_types: dict[str, str] | None = None,
        rows_per_bucket: int = rank.ROWS_PER_BUCKET,
    ):
        self.features_df, self.preds, self.features = features_df, preds, list(features)
        self.entity, self.score_col, self.target, self.label = entity, score, target, label
        self.groups, self.t, self.bounds, self.columns = list(group_cols), thresholds, bounds, columns
        self.metadata, self.model_runs, self.given_importance = metadata, model_runs, importance
        self.vif_features, self.sources, self.feature_types = vif_features or self.features, sources, feature_types
        self.rows_per_bucket = rows_per_bucket

    # ------------------------------------------------ drift side

    @cached_property
    def profile(self) -> DataFrame:
        return pin(drift.feature_profile(self.features_df, self.features, self.groups))

    @cached_property
    def quality(self) -> DataFrame:
        return pin(
            quality.data_quality_report(
                self.features_df,
                self.preds,
                self.features,
                self.entity,
                self.score_col,
                self.target,
                self.groups,
                self.t,
                self.bounds,
                self.columns,
                sources=self.sources,
                label=self.label,
                profile=self.profile,
            )
        )

    @cached_property
    def drift(self) -> DataFrame:
        return pin(
            drift.feature_drift_report(
                self.features_df,
                self.features,
                self.groups,
                self.t,
                self.feature_types,
                self.rows_per_bucket,
                profile=self.profile,
            )
        )

    @cached_property
    def score_drift(self) -> DataFrame:
        return pin(
            drift.prediction_drift_summary(
                self.preds,
                self.score_col,
                self.groups,
                self.t,
                actual=self.label,
                target=self.target,
                rows_per_bucket=self.rows_per_bucket,
            )
        )

    @cached_property
    def cluster_shift(self) -> DataFrame:
        return pin(
            cluster.cluster_share_shift(
                self.features_df, self.features, self.t, rows_per_bucket=self.rows_per_bucket, group_cols=self.groups
            )
        )

    @cached_property
    def counts(self) -> DataFrame:
        return pin(risk.risk_counts(self.quality, self.drift, self.score_drift, self.cluster_shift, self.groups))

    @cached_property
    def decision(self) -> DataFrame:
        return risk.run_risk_decision(self.counts, self.groups, self.t)

    # ------------------------------------------------ model side

    @cached_property
    def gate(self) -> DataFrame:
        return explain.reliability_gate(self.drift, self.groups, self.t)

    def _explained(self, report: DataFrame) -> DataFrame:
        """Drop the reviews whose gate says to skip explanations."""
        if self.t.drift_gate_mode != "skip":
            return report
        skipped = self.gate.where("should_skip")
        if self.groups:
            return report.join(skipped.select(*self.groups), self.groups, "left_anti")
        return report.where(F.lit(skipped.isEmpty()))

    @cached_property
    def reviewer(self) -> boosting.Reviewer:
        """The reviewing model of every reviewed model, fitted once."""
        return boosting.fit(self.features_df, self.features, self.target, self.groups, self.entity, self.rows_per_bucket)

    @cached_property
    def importance(self) -> DataFrame:
        if self.given_importance is not None:
            return pin(self._explained(self.given_importance))
        if not self.groups and self.t.drift_gate_mode == "skip" and not self.gate.where("should_skip").isEmpty():
            nothing = "'' AS feature, 0.0D AS mean_abs_shap, 0 AS shap_rank, 0.0D AS mean_abs_shap_value"
            return self.features_df.sparkSession.range(0).selectExpr(*nothing.split(", "))
        found = explain.tree_attribution_importance(
            self.features_df, self.features, self.target, self.entity, self.reviewer, self.rows_per_bucket, self.groups
        )
        return pin(self._explained(found))

    @cached_property
    def vif(self) -> DataFrame:
        train = self.features_df.where("win = 'train'")
        report = collinearity.feature_vif(train, self.vif_features, self.groups, self.t, self.rows_per_bucket)
        return pin(self._explained(report))

    @cached_property
    def matrix(self) -> DataFrame:
        return pin(risk.feature_risk_matrix(self.importance, self.drift, self.vif, self.metadata, self.groups))

    @cached_property
    def overfitting(self) -> DataFrame | None:
        return None if self.model_runs is None else runs.overfitting_delta(self.model_runs, self.t)

    @cached_property
    def current_scores(self) -> DataFrame:
        return self.preds.where("win = 'current'")

    @cached_property
    def calibration_bins(self) -> DataFrame:
        return calibration.calibration_bins(self.current_scores, self.score_col, self.label, group_cols=self.groups)

    @cached_property
    def calibration_summary(self) -> DataFrame:
        return calibration.calibration_summary(self.current_scores, self.score_col, self.label, group_cols=self.groups)

    @cached_property
    def lift(self) -> DataFrame:
        deciles = lift.score_deciles(
            self.current_scores,
            self.score_col,
            self.label,
            self.entity,
            group_cols=self.groups,
            rows_per_bucket=self.rows_per_bucket,
        )
        return pin(lift.lift_table(deciles, self.groups))

    @cached_property
    def lift_summary(self) -> DataFrame:
        return lift.lift_summary(self.lift, self.groups)

    @cached_property
    def segment_features(self) -> list[str]:
        """The most important features of the one reviewed model; of several models all features."""
        if self.groups:
            return self.features
        top = self.importance.orderBy("shap_rank").limit(MAX_SEGMENT_FEATURES).collect()
        return [r["feature"] for r in top] or self.features

    @cached_property
    def segments(self) -> DataFrame:
        scored = segments.scored_features(
            self.features_df.where("win = 'current'"),
            self.current_scores,
            self.segment_features,
            self.entity,
            self.score_col,
            self.label,
            self.groups,
        )
        return pin(
            segments.segment_performance(
                scored, self.segment_features, self.groups, self.t, rows_per_bucket=self.rows_per_bucket
            )
        )

    @cached_property
    def segment_summary(self) -> DataFrame:
        return segments.segment_summary(self.segments, self.groups)

    # ------------------------------------------------ fused

    @cached_property
    def findings(self) -> DataFrame:
        over = self.overfitting if self.overfitting is not None and set(self.groups) <= set(self.overfitting.columns) else None
        return risk.key_findings(self.drift, self.matrix, self.score_drift, self.vif, over, self.groups)

    @cached_property
    def checks(self) -> DataFrame:
        return risk.recommended_checks(self.counts, self.groups)

    @cached_property
    def actions(self) -> DataFrame:
        return risk.recommended_actions(self.counts, self.matrix, self.vif, self.groups)

    @cached_property
    def health(self) -> DataFrame:
        return risk.model_health_status(self.decision, self.matrix, self.groups)

    def reports(self) -> dict[str, DataFrame]:
        """Every report by name."""
        named = {
            "data_quality": self.quality,
            "feature_drift": self.drift,
            "missing_rates": drift.missing_rate_shift(self.profile, self.groups),
            "prediction_drift": self.score_drift,
            "cluster_shift": self.cluster_shift,
            "risk_decision": self.decision,
            "recommended_checks": self.checks,
            "importance": self.importance,
            "vif": self.vif,
            "reliability_gate": self.gate,
            "feature_risk_matrix": self.matrix,
            "calibration_bins": self.calibration_bins,
            "calibration_summary": self.calibration_summary,
            "lift": self.lift,
            "lift_summary": self.lift_summary,
            "segment_performance": self.segments,
            "segment_summary": self.segment_summary,
            "key_findings": self.findings,
            "recommended_actions": self.actions,
            "model_health": self.health,
        }
        if self.overfitting is not None:
            named["overfitting"] = self.overfitting
        return named

    def packet(self) -> DataFrame:
        """One nested row per reviewed model."""
        named = self.reports()
        named.pop("risk_decision")
        named |= {
            "issue_counts": quality.issue_counts(self.quality, self.groups),
            "high_drift_features": drift.drift_at_level(self.drift, "High").select(*self.groups, "feature", "psi", "ks_pvalue"),
            "medium_drift_features": drift.drift_at_level(self.drift, "Medium").select(*self.groups, "feature", "psi", "ks_pvalue"),
            "top_drivers": self.importance.where("shap_rank <= 5").select(*self.groups, "shap_rank", "feature", "mean_abs_shap"),
            "high_risk_features": risk.high_risk_lines(self.matrix, self.groups),
        }
        if self.metadata is not None and self.groups and set(self.groups) <= set(self.metadata.columns):
            named["model_metadata"] = self.metadata
        if self.groups:
            named = {n: r for n, r in named.items() if set(self.groups) <= set(r.columns)}
        versioned = self.decision.selectExpr("*", f"{quote(self.t.config_version)} AS config_version")
        return evidence.evidence_packet(versioned, named, self.groups)

    def save(self, path: str, run_id: str, replace: bool = True) -> None:
        """Write every report and the nested packet below `path`, partitioned by run."""
        for name, report in self.reports().items():
            sinks.write_report(report.drop("run_id"), f"{path}/{name}", run_id, replace)
        sinks.write_nested(self.packet(), f"{path}/evidence_packet", run_id, replace)
