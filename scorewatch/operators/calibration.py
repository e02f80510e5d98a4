"""Calibration of binary scores: bins, Brier score, expected calibration error."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import label_sql, number_sql
from .selection import label_column, score_column


def clean_scores(preds: DataFrame, score: str, label: str, keep=(), clip: bool = True) -> DataFrame:
    """Rows (keep..., score, label) with a numeric score and a 0/1 label; scores clipped to [0, 1] when asked."""
    s = f"greatest(0.0D, least(1.0D, {number_sql(score)}))" if clip else number_sql(score)
    known = f"{number_sql(score)} IS NOT NULL AND {label_sql(label)} IS NOT NULL"
    return preds.where(known).selectExpr(*[f"`{k}`" for k in keep], f"{s} AS score", f"{label_sql(label)} AS label")


def _bin_sums(preds: DataFrame, score: str, label: str, bins: int, group_cols=()) -> DataFrame:
    """Per right-closed equal-width bin `(a, b]` on [0, 1] (0 in the first): sums that every figure derives from."""
    clean = clean_scores(preds, score, label, group_cols)
    step = 1.0 / bins
    slot = " + ".join(["1", *[f"int(score > {i * step!r}D)" for i in range(1, bins)]])
    return clean.withColumn("slot", F.expr(slot)).groupBy(*group_cols, "slot").agg(
        F.expr("min(score) AS score_min"),
        F.expr("max(score) AS score_max"),
        F.expr("count(*) AS count"),
        F.expr("sum(score) AS score_sum"),
        F.expr("sum(label) AS positives"),
        F.expr("sum((score - label) * (score - label)) AS squared_error"),
    )


def _report(sums: DataFrame, group_cols=()) -> DataFrame:
    keep = [f"`{g}`" for g in group_cols]
    partition = ", ".join(keep) or "1"
    return sums.selectExpr(
        *keep,
        f"row_number() OVER (PARTITION BY {partition} ORDER BY slot) AS bin",  # at most `bins` rows per group
        "score_min",
        "score_max",
        "count",
        "score_sum / count AS avg_predicted_score",
        "positives / count AS actual_rate",
        "score_sum / count - positives / count AS calibration_gap",
        "abs(score_sum / count - positives / count) AS abs_calibration_gap",
    )


def calibration_bins(preds: DataFrame, score="score", label="actual_label", bins: int = 10, group_cols=()) -> DataFrame:
    """Non-empty bins renumbered from 1 with mean score, observed rate and gap."""
    return _report(_bin_sums(preds, score, label, bins, group_cols), group_cols)


def calibration_summary(
    preds: DataFrame, score=None, label=None, bins: int = 10, group_cols=()
) -> DataFrame:
    """Row count, Brier score, expected calibration error, mean score, positive rate: one pass over the rows.

    Score and label columns are resolved from the usual names; without them, or without a usable row,
    `available` is false.
    """
    keep = [f"`{g}`" for g in group_cols]
    score, label = score_column(preds, score), label_column(preds, label)
    reason = "Calibration diagnostics require prediction scores and binary actual labels."
    if not score or not label:
        empty = preds.groupBy(*group_cols).agg(F.expr("count(*) AS seen"))
        return empty.selectExpr(
            *keep,
            "false AS available",
            f"'{reason}' AS reason",
            "0L AS row_count",
            "CAST(NULL AS DOUBLE) AS brier_score",
            "CAST(NULL AS DOUBLE) AS expected_calibration_error",
            "CAST(NULL AS DOUBLE) AS mean_predicted_score",
            "CAST(NULL AS DOUBLE) AS actual_positive_rate",
        )
    sums = _bin_sums(preds, score, label, bins, group_cols)
    total = sums.groupBy(*group_cols).agg(
        F.expr("coalesce(sum(count), 0L) AS row_count"),
        F.expr("sum(squared_error) / sum(count) AS brier_score"),
        F.expr("sum(abs(score_sum / count - positives / count) * count) / sum(count) AS expected_calibration_error"),
        F.expr("sum(score_sum) / sum(count) AS mean_predicted_score"),
        F.expr("sum(positives) / sum(count) AS actual_positive_rate"),
    )
    return total.selectExpr(
        *keep,
        "row_count > 0 AS available",
        f"CASE WHEN row_count = 0 THEN '{reason}' END AS reason",
        "row_count",
        "brier_score",
        "expected_calibration_error",
        "mean_predicted_score",
        "actual_positive_rate",
    )


def brier_score(preds: DataFrame, score="score", label="actual_label", group_cols=()) -> DataFrame:
    clean = clean_scores(preds, score, label, group_cols)
    return clean.groupBy(*group_cols).agg(F.expr("avg((score - label) * (score - label)) AS brier_score"))
