"""Cleaning expressions shared by every diagnostic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TRAIN, CURRENT = "train", "current"


def number_sql(c: str) -> str:
    """SQL text: column as double; text that is no number, NULL and NaN all become NULL."""
    return f"nanvl(try_cast(`{c}` AS DOUBLE), NULL)"


def finite_sql(c: str) -> str:
    """SQL text: `number_sql` with infinities removed too."""
    return f"CASE WHEN abs({number_sql(c)}) < double('infinity') THEN {number_sql(c)} END"


def label_sql(c: str) -> str:
    """SQL text: 0 or 1 as int; every other label becomes NULL."""
    return f"CASE WHEN try_cast(`{c}` AS DOUBLE) IN (0.0D, 1.0D) THEN int(try_cast(`{c}` AS DOUBLE)) END"


def mean_change_sql(train: str, current: str) -> str:
    """Percent change against |train|; a zero baseline gives 0 or +-100; a missing mean gives 0."""
    return (
        f"CASE WHEN {train} IS NULL OR {current} IS NULL OR isnan({train}) OR isnan({current}) THEN 0.0D"
        f" WHEN abs({train}) < 1E-12 THEN CASE WHEN abs({current}) < 1E-12 THEN 0.0D ELSE signum({current}) * 100.0D END"
        f" ELSE ({current} - {train}) / abs({train}) * 100.0D END"
    )


def lerp_sql(low: str, high: str, t: str) -> str:
    """Linear interpolation anchored at the nearer end, so equal ends give exactly that value."""
    return f"CASE WHEN {t} >= 0.5D THEN {high} - ({high} - {low}) * (1.0D - ({t})) ELSE {low} + ({high} - {low}) * ({t}) END"


def level_order(c: str) -> Column:
    """High, Medium, Low as 0, 1, 2."""
    return F.expr(f"CASE {c} WHEN 'High' THEN 0 WHEN 'Medium' THEN 1 ELSE 2 END")
