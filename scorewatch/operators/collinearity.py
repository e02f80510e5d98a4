"""Variance inflation factors from pairwise moments.

Few features: all correlations are one wide aggregate. Many: tasks add up cross products of standardised rows, a block of
features by a block of features; blocks are summed by (review, block row, block column), and the matrix of a review is
solved in one task. The plan has an expression per feature, not per pair.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Thresholds
from ..functions.text import choose, fixed, quote, sentence
from ..session import BROADCAST_ROWS, join_per_group, keyed_join, ordered, pin
from . import rank
from .impute import median_imputed

cloudpickle.register_pickle_by_value(sys.modules[__name__])

INFINITE_FROM_R2 = 0.999999
# Up to so many features the correlations of all pairs are expressions of one aggregate.
WIDE = 24
BLOCK = 64
# Eigenvalues are taken for at least this: below it a combination of features is constant.
SMALLEST = 1e-14


def vif_from_correlation(corr: np.ndarray, constant: np.ndarray) -> np.ndarray:
    """1 / (1 - R2) of each column on the others; constants and exact combinations give infinity."""
    vif = np.full(len(constant), np.inf)
    live = np.flatnonzero(~constant)
    for j in live:
        others = live[live != j]
        if len(others) == 0:
            vif[j] = 1.0
            continue
        r = corr[others, j]
        r2 = float(r @ np.linalg.lstsq(corr[np.ix_(others, others)], r, rcond=1e-12)[0])
        vif[j] = np.inf if r2 >= INFINITE_FROM_R2 else 1.0 / (1.0 - r2)
    return vif


def vif_from_eigenvalues(corr: np.ndarray, constant: np.ndarray) -> np.ndarray:
    """The same for large matrices: the diagonal of the inverse, from one decomposition."""
    vif = np.full(len(constant), np.inf)
    live = np.flatnonzero(~constant)
    if len(live):
        values, vectors = np.linalg.eigh(corr[np.ix_(live, live)])
        found = (vectors**2 / np.maximum(values, SMALLEST)).sum(1)
        vif[live] = np.where(found >= 1 / (1 - INFINITE_FROM_R2), np.inf, np.maximum(found, 1.0))
    return vif


def _block_products(rows: DataFrame, features) -> DataFrame:
    """review_no, a, b, cells: cross products of standardised features, summed over all rows, blocks with a <= b."""
    p = len(features)
    starts = list(range(0, p, BLOCK))

    def blocks(review, products):
        for a, i in enumerate(starts):
            for b, j in enumerate(starts[a:], a):
                yield review, a, b, products[i : i + BLOCK, j : j + BLOCK].ravel().tolist()

    def multiply(batches):
        review, products = None, None  # rows come sorted by review: one matrix at a time
        for batch in batches:
            numbers, cells = batch["review_no"].to_numpy(), batch[features].to_numpy(dtype=float)
            for own in np.split(np.arange(len(batch)), np.flatnonzero(np.diff(numbers)) + 1):
                if not len(own):
                    continue
                if numbers[own[0]] != review:
                    if products is not None:
                        yield pd.DataFrame(list(blocks(review, products)), columns=names)
                    review, products = int(numbers[own[0]]), np.zeros((p, p))
                x = cells[own]
                products += x.T @ x
        if products is not None:
            yield pd.DataFrame(list(blocks(review, products)), columns=names)

    def add(batches):
        key, total = None, None  # parts come sorted by block: one block at a time
        for batch in batches:
            for review, a, b, cells in zip(*(batch[n] for n in names)):
                if (review, a, b) != key:
                    if total is not None:
                        yield pd.DataFrame([(*key, total.tolist())], columns=names)
                    key, total = (review, a, b), np.zeros(len(cells))
                total = total + np.asarray(cells)
        if total is not None:
            yield pd.DataFrame([(*key, total.tolist())], columns=names)

    names = ["review_no", "a", "b", "cells"]
    schema = "review_no int, a int, b int, cells array<double>"
    parts = rows.sortWithinPartitions("review_no").mapInPandas(multiply, schema)
    dealt = parts.repartition("review_no", "a", "b").sortWithinPartitions("review_no", "a", "b")
    return dealt.mapInPandas(add, schema)


def _vif_by_blocks(filled: DataFrame, features, group_cols) -> DataFrame:
    """Review keys, feature, vif."""
    p = len(features)
    moments = [f"{agg}(`{f}`) AS `{f}|{n}`" for f in features for agg, n in (("avg", "m"), ("stddev_pop", "s"))]
    varies = ", ".join(f"coalesce(max(`{f}`) > min(`{f}`), false)" for f in features)
    order = ", ".join(f"`{g}`" for g in group_cols) or "1"
    reviews = filled.groupBy(*group_cols).agg(F.count("*").alias("n"), *[F.expr(m) for m in moments], F.expr(f"array({varies}) AS varies"))
    reviews = pin(reviews.selectExpr("*", f"int(row_number() OVER (ORDER BY {order}) - 1) AS review_no"))
    few = not group_cols or reviews.count() <= BROADCAST_ROWS
    joined = join_per_group(filled, reviews, group_cols, "inner", broadcast=few)
    scaled = [f"CASE WHEN `{f}|s` > 0 THEN (`{f}` - `{f}|m`) / `{f}|s` ELSE 0.0D END AS `{f}`" for f in features]
    blocks = _block_products(joined.selectExpr("review_no", *scaled), features)
    # a review's matrix: its blocks, whose number is fixed by the features
    matrix = blocks.groupBy("review_no").agg(F.expr("collect_list(struct(a, b, cells)) AS blocks"))
    matrix = keyed_join(reviews.select(*group_cols, "review_no", "n", "varies"), matrix, ["review_no"], "left")

    @F.pandas_udf("array<double>")
    def solve(blocks: pd.Series, n: pd.Series, varies: pd.Series) -> pd.Series:
        out = []
        for parts, count, v in zip(blocks, n, varies):
            corr = np.zeros((p, p))
            for part in parts if parts is not None else ():
                i, j = part["a"] * BLOCK, part["b"] * BLOCK
                cells = np.asarray(part["cells"]).reshape(min(BLOCK, p - i), min(BLOCK, p - j)) / count
                corr[i : i + BLOCK, j : j + BLOCK] = cells
                corr[j : j + BLOCK, i : i + BLOCK] = cells.T
            np.fill_diagonal(corr, 1.0)
            out.append(vif_from_eigenvalues(corr, ~np.asarray(v, dtype=bool)))
        return pd.Series(out)

    names = ", ".join(quote(f) for f in features)
    return matrix.withColumn("vif", solve("blocks", "n", "varies")).selectExpr(
        *[f"`{g}`" for g in group_cols],
        f"inline(zip_with(array({names}), vif, (f, v) -> named_struct('feature', f, 'vif', v)))",
    )


def feature_vif(
    df: DataFrame,
    features,
    group_cols=(),
    thresholds: Thresholds = Thresholds(),
    rows_per_bucket: int = rank.ROWS_PER_BUCKET,
) -> DataFrame:
    """VIF, level and reason per feature after median imputation.

    All pairwise correlations are partial aggregates (one row per group moves, or its blocks); the matrix of a group is
    then solved in a task, p x p numbers at a time.
    """
    features, group_cols = list(features), list(group_cols)
    filled = median_imputed(df, features, group_cols, rows_per_bucket=rows_per_bucket).select(*group_cols, *features)
    wide = len(features) <= WIDE
    rows = _vif_by_pairs(filled, features, group_cols) if wide else _vif_by_blocks(filled, features, group_cols)
    t = thresholds
    high, medium = f"vif >= {t.vif_high}D", f"vif >= {t.vif_medium}D"
    shown = f"CASE WHEN vif = double('infinity') THEN 'inf' ELSE {fixed('vif', 2)} END"

    def side(level, limit, where):
        return sentence(quote(f"{level} because VIF "), shown, quote(f" is {where} configured threshold {limit:.2f}."))

    report = rows.selectExpr(
        "*",
        f"{choose([(high, quote('High')), (medium, quote('Medium'))], quote('Low'))} AS vif_risk",
        choose(
            [(high, side("High", t.vif_high, "at or above")), (medium, side("Medium", t.vif_medium, "at or above"))],
            side("Low", t.vif_medium, "below"),
        )
        + " AS vif_risk_reason",
    )
    return ordered(report, group_cols, F.desc("vif"), "feature")


def _vif_by_pairs(filled: DataFrame, features, group_cols) -> DataFrame:
    """Review keys, feature, vif."""
    p = len(features)
    pairs = [(i, j) for i in range(p) for j in range(i + 1, p)]
    spreads = ", ".join(f"max(`{f}`) > min(`{f}`)" for f in features)
    # corr() would divide by zero on a constant column
    cells = [
        f"try_divide(covar_pop(`{a}`, `{b}`), stddev_pop(`{a}`) * stddev_pop(`{b}`))"
        for a, b in ((features[i], features[j]) for i, j in pairs)
    ]
    matrix = filled.groupBy(*group_cols).agg(
        F.expr(f"array({spreads}) AS varies"), F.expr(f"CAST(array({', '.join(cells)}) AS ARRAY<DOUBLE>) AS r")
    )

    @F.pandas_udf("array<double>")
    def solve(varies: pd.Series, r: pd.Series) -> pd.Series:
        out = []
        for v, cells in zip(varies, r):
            corr = np.eye(p)
            for (i, j), c in zip(pairs, cells):
                corr[i, j] = corr[j, i] = 0.0 if c is None or np.isnan(c) else c
            out.append(vif_from_correlation(corr, ~np.asarray(v, dtype=bool)))
        return pd.Series(out)

    names = ", ".join(quote(f) for f in features)
    solved = matrix.withColumn("vif", solve("varies", "r"))
    return solved.selectExpr(
        *[f"`{g}`" for g in group_cols],
        f"inline(zip_with(array({names}), vif, (f, v) -> named_struct('feature', f, 'vif', v)))",
    )
