"""Score deciles, lift and cumulative gains.

Deciles need a global order by score. Rows are first collapsed to one row per distinct score with running
counts; only a score whose rows straddle a decile border (at most deciles - 1 of them) is opened up and ordered
by entity id. Heavy score ties therefore never sit in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import keyed_join, pin
from . import rank
from .calibration import clean_scores
from .selection import label_column, score_column


def _intervals(frame: DataFrame, deciles: int) -> DataFrame:
    """Decile of the first and last rank of the half-open rank interval [start, start + n)."""
    return frame.withColumn("k", F.expr(f"least({deciles}L, total)")).selectExpr(
        "*", "start * k div total + 1 AS first_decile", "(start + n - 1) * k div total + 1 AS last_decile"
    )


def score_deciles(
    preds: DataFrame,
    score="score",
    label="actual_label",
    entity="entity_id",
    deciles: int = 10,
    group_cols=(),
    rows_per_bucket: int = rank.ROWS_PER_BUCKET,
) -> DataFrame:
    """Per decile of the descending score order: count, score range and mean, positives.

    Row i of n falls in decile floor(i * k / n) + 1 with k = min(deciles, n). Equal scores are ordered by
    entity id, equal entities with positives first.
    """
    keys = [*group_cols, "scope"]
    key_sql = [f"`{k}`" for k in keys]
    rows = clean_scores(preds, score, label, [*group_cols, entity], clip=False).selectExpr(
        *[f"`{g}`" for g in group_cols], "'score' AS scope", f"`{entity}` AS entity", "-score AS descending", "label"
    )
    spread = rank.measure(rows, keys, "descending", rows_per_bucket, preds, group_cols)
    counts = {"n": "1L", "positives": "bigint(label)"}
    distinct = rank.value_counts(rows, keys, "descending", counts)
    running = rank.running_counts(distinct, keys, ["n"], spread, carry=["positives"])
    tiers = _intervals(
        running.selectExpr(*key_sql, "value", "n", "positives", "n_upto - n AS start", "n_all AS total"), deciles
    )

    whole = tiers.where("first_decile = last_decile").selectExpr(
        *key_sql, "first_decile AS decile", "n", "positives", "value"
    )
    few = not group_cols or spread.few_keys
    # at most deciles - 1 rows per group; pinned because its sizes are looked at
    split = pin(
        tiers.where("first_decile < last_decile").selectExpr(*key_sql, "value AS descending", "n AS tied", "start AS tier_start", "total")
    )
    largest = split.agg(F.max("tied")).first()[0]
    parts = whole
    if largest is not None:
        tied = keyed_join(rows, split, [*keys, "descending"], broadcast=few)
        tier_keys = [*keys, "descending"]
        layout = (
            rank.Spread(few, None)
            if largest <= rows_per_bucket
            else rank.measure(tied, tier_keys, "entity", rows_per_bucket)
        )
        per_entity = rank.value_counts(tied, tier_keys, "entity", counts)
        ordered = rank.running_counts(per_entity, tier_keys, ["n"], layout, carry=["positives"])
        placed = keyed_join(ordered, split, tier_keys, broadcast=few)
        entity_intervals = _intervals(
            placed.selectExpr(*key_sql, "descending", "n", "positives", "tier_start + n_upto - n AS start", "total"),
            deciles,
        )
        # decile j covers ranks [ceil((j - 1) * total / k), ceil(j * total / k))
        opened = entity_intervals.selectExpr("*", "explode(sequence(first_decile, last_decile)) AS decile").selectExpr(
            "*",
            "greatest(start, ((decile - 1) * total + k - 1) div k) AS lo",
            "least(start + n, (decile * total + k - 1) div k) AS hi",
        )
        parts = whole.unionByName(
            opened.selectExpr(
                *key_sql,
                "decile",
                "hi - lo AS n",
                "greatest(0L, least(start + positives, hi) - lo) AS positives",
                "descending AS value",
            )
        )
    return parts.groupBy(*group_cols, "decile").agg(
        F.expr("sum(n) AS count"),
        F.expr("min(0.0D - value) AS score_min"),
        F.expr("max(0.0D - value) AS score_max"),
        F.expr("sum((0.0D - value) * n) / sum(n) AS avg_score"),
        F.expr("sum(positives) AS positives"),
        F.expr("sum(positives) / sum(n) AS actual_rate"),
    )


def lift_table(deciles: DataFrame, group_cols=()) -> DataFrame:
    """Lift against the overall rate and cumulative gains; at most `deciles` rows per group."""
    partition = ", ".join(f"`{g}`" for g in group_cols) or "1"
    upto = f"(PARTITION BY {partition} ORDER BY decile ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    totals = deciles.selectExpr(
        "*",
        f"sum(positives) OVER {upto} AS cumulative_positives",
        f"sum(positives) OVER (PARTITION BY {partition}) AS total_positives",
        f"sum(count) OVER (PARTITION BY {partition}) AS total_rows",
        f"max(decile) OVER (PARTITION BY {partition}) AS k",
    )
    return totals.selectExpr(
        *deciles.columns,
        "try_divide(actual_rate, total_positives / total_rows) AS lift",
        "cumulative_positives",
        "try_divide(cumulative_positives, total_positives) AS cumulative_capture_rate",
        "try_divide(cumulative_positives, total_positives) / (decile / k) AS cumulative_lift",
    )


def lift_summary(lift: DataFrame, group_cols=()) -> DataFrame:
    """Rows, baseline rate and the top decile's lift, rate and capture; unavailable when there are no rows."""
    top = "FILTER (WHERE decile = 1)"
    return lift.groupBy(*group_cols).agg(
        F.expr("count(*) > 0 AS available"),
        F.expr("coalesce(sum(count), 0L) AS row_count"),
        F.expr("sum(positives) / sum(count) AS baseline_rate"),
        F.expr(f"max(lift) {top} AS top_decile_lift"),
        F.expr(f"max(actual_rate) {top} AS top_decile_actual_rate"),
        F.expr(f"max(cumulative_capture_rate) {top} AS top_decile_capture_rate"),
    )


def lift_report(preds: DataFrame, score=None, label=None, entity="entity_id", deciles: int = 10, group_cols=()) -> DataFrame | None:
    """Resolve the score and label columns and build the lift table; None when either is absent."""
    score, label = score_column(preds, score), label_column(preds, label)
    if not score or not label:
        return None
    return lift_table(score_deciles(preds, score, label, entity, deciles, group_cols), group_cols)
