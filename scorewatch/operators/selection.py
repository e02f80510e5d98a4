"""Choosing columns from schemas: features, model inputs, score and label columns. No data is read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clean import CURRENT, TRAIN

# Columns that are model outputs, candidate score and label names.
OUTPUT_COLUMNS = (
    "prediction",
    "prediction_score",
    "predicted_label",
    "actual_label",
    "propensity_score",
    "y_true",
    "y_pred",
    "y_pred_proba",
)
OUTPUT_SUFFIXES = ("_label", "_score", "_prediction")
SCORE_NAMES = ("propensity_score", "prediction_score", "score", "y_pred_proba")
LABEL_NAMES = ("actual_label", "y_true", "target", "label")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def review_features(train: DataFrame, current: DataFrame, declared=(), target=None, entity=None) -> list[str]:
    """Declared features that are numeric in train and present in current; else every shared numeric column."""
    numeric = numeric_columns(train)
    chosen = [c for c in declared if c in numeric and c in current.columns]
    return chosen or [c for c in numeric if c in current.columns and c not in (target, entity)]


def model_features(train: DataFrame, current: DataFrame, declared=(), target=None, entity=None, time=None) -> list[str]:
    """Numeric model inputs: no ids, target, time or output columns; declared ones win when any qualifies."""
    blocked = {target, entity, time, *OUTPUT_COLUMNS}
    inputs = [c for c in numeric_columns(train) if c not in blocked and not c.lower().endswith(OUTPUT_SUFFIXES)]
    chosen = [c for c in declared if c in train.columns and c in current.columns and c in inputs] or inputs
    if not chosen:
        raise ValueError("no numeric model feature columns found")
    return chosen


def score_column(predictions: DataFrame, preferred: str | None = None) -> str | None:
    return next((c for c in (preferred, *SCORE_NAMES) if c and c in predictions.columns), None)


def label_column(predictions: DataFrame, preferred: str | None = None) -> str | None:
    return next((c for c in (preferred, *LABEL_NAMES) if c and c in predictions.columns), None)


def stack_windows(train: DataFrame | None, current: DataFrame) -> DataFrame:
    """Both windows as one frame with a `win` column; columns missing on one side become NULL.

    The columns that each window had travel in the metadata of `win` (see `window_columns`).
    """
    held = {CURRENT: current.columns} | ({} if train is None else {TRAIN: train.columns})
    both = current.withColumn("win", F.lit(CURRENT))
    if train is not None:
        both = train.withColumn("win", F.lit(TRAIN)).unionByName(both, allowMissingColumns=True)
    return both.withColumn("win", F.col("win").alias("win", metadata={"window_columns": held}))


def window_columns(df: DataFrame) -> dict[str, list[str]] | None:
    """Columns of each window before they were stacked; None for a frame stacked otherwise."""
    found = next((f.metadata.get("window_columns") for f in df.schema.fields if f.name == "win"), None)
    return {k: list(v) for k, v in found.items()} if found else None
