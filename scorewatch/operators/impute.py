"""Median imputation, from a window's own medians or from the train window's."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import number_sql
from ..functions.text import quote
from ..session import bounded, join_per_group, pin
from . import rank
from .drift import long_values


def sizes_and_gaps(df: DataFrame, columns, group_cols=(), window: str | None = None) -> tuple[DataFrame, list[str]]:
    """Rows per group (of one window, if named), and the columns with at least one missing value: one wide aggregate."""
    n = f"count_if(win = {quote(window)})" if window else "count(*)"
    found = df.groupBy(*group_cols).agg(
        F.expr(f"{n} AS n"), F.expr(f"array({', '.join(f'bool_or({number_sql(c)} IS NULL)' for c in columns)}) AS gaps")
    )
    found = pin(found)
    some = found.agg(*[F.expr(f"bool_or(gaps[{i}]) AS `{i}`") for i in range(len(columns))]).first()
    return found, [c for c, gap in zip(columns, some) if gap]


def medians(
    df: DataFrame, columns, group_cols=(), rows_per_bucket=rank.ROWS_PER_BUCKET, counts: DataFrame | None = None
) -> DataFrame:
    """One row per group with the exact median of every column (NULL when a column has no value)."""
    keys = [*group_cols, "feature"]
    values = long_values(df, columns, list(group_cols))
    spread = rank.measure(values, keys, "value", rows_per_bucket, df, group_cols, len(columns), counts)
    long = rank.exact_quantiles(values, keys, "value", {"median": (1, 2)}, spread)
    return long.groupBy(*group_cols).agg(
        *[F.expr(f"max(median) FILTER (WHERE feature = {quote(c)}) AS `{c}|median`") for c in columns]
    )


def median_imputed(
    df: DataFrame, columns, group_cols=(), from_window: str | None = None, rows_per_bucket=rank.ROWS_PER_BUCKET
) -> DataFrame:
    """Replace missing values by the column median, or 0 when it has none; other columns are kept.

    `from_window='train'` takes every median from the train window. Only columns with gaps are ranked; the scan that finds
    them counts the rows that the ranking is laid out by.
    """
    sizes, gaps = sizes_and_gaps(df, columns, group_cols, from_window)
    others = [f"`{c}`" for c in df.columns if c not in columns]
    if not gaps:
        return df.selectExpr(*others, *[f"{number_sql(c)} AS `{c}`" for c in columns])
    source = df.where(F.col("win") == from_window) if from_window else df
    values, small = bounded(medians(source, gaps, group_cols, rows_per_bucket, sizes), group_cols)
    filled = join_per_group(df, values, group_cols, broadcast=small)
    return filled.selectExpr(
        *others,
        *[
            f"coalesce({number_sql(c)}, `{c}|median`, 0.0D) AS `{c}`" if c in gaps else f"{number_sql(c)} AS `{c}`"
            for c in columns
        ],
    )
