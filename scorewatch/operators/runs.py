"""Checks over a table of model runs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..config import Thresholds
from ..functions.text import choose, fixed, quote, sentence


def overfitting_delta(runs: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Train minus validation AUC with its level and reason; Not Available when either is missing."""
    t = thresholds
    if "train_auc" not in runs.columns or "validation_auc" not in runs.columns:
        for c in ("train_auc", "validation_auc"):
            if c not in runs.columns:
                runs = runs.selectExpr("*", f"CAST(NULL AS DOUBLE) AS {c}")

    def side(level, limit, where):
        return sentence(
            quote(f"{level} because train-validation AUC delta "),
            fixed("delta", 4),
            quote(f" is {where} configured threshold {limit:.4f}."),
        )

    high, medium, missing = f"delta >= {t.overfit_high}D", f"delta >= {t.overfit_medium}D", "delta IS NULL"
    level = choose([(missing, "'Not Available'"), (high, "'High'"), (medium, "'Medium'")], "'Low'")
    reason = choose(
        [
            (missing, quote("Not Available because train_auc and validation_auc are both required.")),
            (high, side("High", t.overfit_high, "at or above")),
            (medium, side("Medium", t.overfit_medium, "at or above")),
        ],
        side("Low", t.overfit_medium, "below"),
    )
    return runs.selectExpr("*", "train_auc - validation_auc AS delta").selectExpr(
        "*", f"{level} AS risk_level", f"{reason} AS reason"
    )
