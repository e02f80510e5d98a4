"""Performance per feature segment: quantile bins of the current window joined to its scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Thresholds
from ..functions.clean import finite_sql, level_order, number_sql
from ..functions.text import choose, fixed, quote, sentence, shortest
from ..session import keyed_join, ordered, stored
from . import rank
from .calibration import clean_scores


def scored_features(
    features_df: DataFrame,
    preds: DataFrame,
    features,
    entity: str | None,
    score="score",
    label="actual_label",
    group_cols=(),
    position: str | None = None,
) -> DataFrame:
    """Features joined to valid scores on the entity id (every matching pair is kept).

    Spark rows have no order: frames without a shared id need a `position` column that numbers them.
    """
    shared = entity and entity in features_df.columns and entity in preds.columns
    on = entity if shared else position
    if not on or on not in features_df.columns or on not in preds.columns:
        raise ValueError("scored_features needs a shared entity id or a position column in both frames")
    right = clean_scores(preds, score, label, [*group_cols, on])
    keep = [c for c in features_df.columns if c not in ("score", "label")]
    # plain equality lets Spark split a hot id across tasks (adaptive skew join)
    left = features_df.select(*keep) if set(features) <= set(keep) else features_df
    return left.join(right, [*group_cols, on], "inner")


def _round_sig(x: str, digits: str) -> str:
    """Round like interval labels do: `digits` decimals, or significant digits when |x| < 1."""
    scale = f"CASE WHEN abs({x}) < 1 THEN pow(10.0D, {digits} - 1 - floor(log10(abs({x})))) ELSE pow(10.0D, {digits}) END"
    return f"CASE WHEN {x} = 0 THEN 0.0D ELSE rint({x} * ({scale})) / ({scale}) END"


def segment_edges(values: DataFrame, keys, bins: int, spread: rank.Spread, unbounded: DataFrame) -> DataFrame:
    """Per key: distinct count, de-duplicated quantile edges, and the edges as rounded for labels.

    Quantiles fail where values are infinite: the keys that `unbounded` marks (a column `equal_width`) get edges at equal
    distances between their least and greatest finite value, the first a thousandth of the span lower.
    """
    distinct = rank.value_counts(values, keys, "value", {"n": "1L"}).withColumn("one", F.lit(1).cast("long"))
    running = rank.running_counts(distinct, keys, ["n", "one"], spread)
    q = f"least({bins}, one_all)"
    at = {f"e{i}": f"((n_all - 1) * {i} / {q})" for i in range(bins + 1)}
    picked = running.groupBy(*keys).agg(
        F.expr("max(n_all) AS n_all"),
        F.expr("max(one_all) AS one_all"),
        F.expr("min(value) AS low"),
        F.expr("max(value) AS high"),
        *rank.order_statistics("n", at),
    )
    edges = ", ".join(rank.interpolated(a, p) for a, p in at.items())

    def rounded(digits: str) -> str:
        return f"transform(edges, x -> {_round_sig('x', digits)})"

    quantiles = f"array_distinct(filter(array({edges}), x -> x IS NOT NULL))"
    steps = f"sequence(0, int({q}))"
    even = (
        f"transform({steps}, i -> CASE WHEN i = 0 THEN low - (high - low) * 0.001D WHEN i = {q} THEN high"
        f" ELSE low + i * ((high - low) / {q}) END)"
    )
    with_edges = keyed_join(picked, unbounded, keys, "left").selectExpr(
        *[f"`{k}`" for k in keys],
        "one_all AS distinct_values",
        "low",
        "high",
        "coalesce(equal_width, false) AS equal_width",
        f"CASE WHEN equal_width THEN {even} ELSE {quantiles} END AS edges",
    )
    # the smallest precision from 3 up that keeps the rounded edges apart
    precise = with_edges.withColumn(
        "digits",
        F.expr(f"get(filter(sequence(3, 19), p -> size(array_distinct({rounded('p')})) = size(edges)), 0)"),
    )
    return precise.withColumn("shown", F.expr(rounded("digits")))


def segment_performance(
    scored: DataFrame,
    features,
    group_cols=(),
    thresholds: Thresholds = Thresholds(),
    bins: int = 4,
    rows_per_bucket: int = rank.ROWS_PER_BUCKET,
) -> DataFrame:
    """Count, rates, calibration gap, lift, Brier score and risk per (feature, segment).

    Segments are quantile bins `(lo, hi]`; features with at most two values use the values themselves, features with
    infinite values equal-width bins of their finite ones (the infinite ones are in segment `nan`).
    """
    features = list(features)
    keys = [*group_cols, "feature"]
    key_sql = [f"`{k}`" for k in keys]
    cleaned = scored.selectExpr(
        *[f"`{g}`" for g in group_cols], "score", "label", *[f"{finite_sql(f)} AS `{f}`" for f in features]
    )
    # the joined rows are read for sizes, edges and sums: write the few columns once instead of joining three times
    narrow = stored(cleaned, "scored")
    long = narrow.unpivot([*group_cols, "score", "label"], features, "feature", "value")
    known = long.where("value IS NOT NULL").select(*keys, "value")
    spread = rank.measure(known, keys, "value", rows_per_bucket, narrow, group_cols, len(features))
    infinite = ", ".join(
        f"{quote(f)}, coalesce(bool_or(abs({number_sql(f)}) = double('infinity')), false)" for f in features
    )
    marks = scored.groupBy(*group_cols).agg(F.expr(f"map({infinite}) AS marks"))
    unbounded = marks.selectExpr(*[f"`{g}`" for g in group_cols], "explode(marks) AS (feature, equal_width)").where("equal_width")
    edges = segment_edges(known, keys, bins, spread, unbounded)
    few = not group_cols or spread.few_keys
    placed = keyed_join(long, edges, keys, "left", broadcast=few).withColumn(
        "slot",
        F.expr(
            "CASE WHEN value IS NULL THEN 0"
            " WHEN distinct_values <= 2 THEN CASE WHEN value = low OR coalesce(try_cast(low AS BIGINT) = try_cast(high AS BIGINT), false) THEN 1 ELSE 2 END"
            " ELSE greatest(1, least(size(edges) - 1, size(filter(edges, e -> e < value)))) END"
        ),
    )
    sums = placed.groupBy(*keys, "slot").agg(
        F.expr("count(*) AS count"),
        F.expr("sum(score) AS score_sum"),
        F.expr("sum(label) AS positives"),
        F.expr("sum((score - label) * (score - label)) AS squared_error"),
        *[F.expr(f"first({c}) AS {c}") for c in ("distinct_values", "low", "high", "shown", "digits", "equal_width")],
    )
    # at most bins + 1 rows per feature from here on; a NULL segment carries the edges of its feature too
    per_feature = f"(PARTITION BY {', '.join(key_sql)})"
    low_label = "concat('value=', coalesce(string(try_cast(low AS BIGINT)), string(low)))"
    high_label = "concat('value=', coalesce(string(try_cast(high AS BIGINT)), string(high)))"
    left = "CASE WHEN slot = 1 AND NOT equal_width THEN get(shown, 0) - pow(10.0D, -digits) ELSE get(shown, slot - 1) END"
    segment = (
        "CASE WHEN slot = 0 THEN CASE WHEN coalesce(distinct_values, 0) <= 2 THEN 'missing' ELSE 'nan' END"
        f" WHEN distinct_values <= 2 THEN CASE WHEN slot = 1 THEN {low_label} ELSE {high_label} END"
        f" ELSE concat('(', {shortest('lo_edge')}, ', ', {shortest('hi_edge')}, ']') END"
    )
    rates = sums.selectExpr(
        "*",
        f"{left} AS lo_edge",
        "get(shown, slot) AS hi_edge",
        f"sum(count) OVER {per_feature} AS total_rows",
        f"sum(positives) OVER {per_feature} AS total_positives",
    ).selectExpr(
        *key_sql,
        f"{segment} AS segment",
        "count",
        "count / total_rows AS count_share",
        "score_sum / count AS avg_score",
        "positives / count AS actual_rate",
        "score_sum / count - positives / count AS calibration_gap",
        "abs(score_sum / count - positives / count) AS abs_calibration_gap",
        "try_divide(positives / count, total_positives / total_rows) AS lift_vs_overall",
        "squared_error / count AS brier_score",
    )
    t, gap = thresholds, "abs_calibration_gap"
    small = f"count < {t.segment_min_count}"
    high, medium = f"{gap} >= {t.segment_gap_high}D", f"{gap} >= {t.segment_gap_medium}D"

    def crossed(level, limit):
        return sentence(
            quote(f"{level} because absolute calibration gap "), fixed(gap, 3), quote(f" is at or above {limit:.3f}.")
        )

    reason = choose(
        [
            (
                small,
                sentence(
                    quote("Low confidence because segment count "),
                    "string(count)",
                    quote(f" is below minimum {t.segment_min_count}."),
                ),
            ),
            (high, crossed("High", t.segment_gap_high)),
            (medium, crossed("Medium", t.segment_gap_medium)),
        ],
        quote("Low because segment calibration gap did not cross configured thresholds."),
    )
    report = rates.selectExpr(
        "*",
        f"{choose([(small, quote('Low')), (high, quote('High')), (medium, quote('Medium'))], quote('Low'))} AS risk_level",
        f"{reason} AS risk_reason",
    )
    return ordered(report, group_cols, level_order("risk_level"), F.desc(gap), "feature", "segment")


def segment_summary(report: DataFrame, group_cols=()) -> DataFrame:
    return report.groupBy(*group_cols).agg(
        F.expr("count(*) > 0 AS available"),
        F.expr("count(DISTINCT feature) AS features_evaluated"),
        F.expr("count_if(risk_level = 'High') AS high_risk_segments"),
        F.expr("count_if(risk_level = 'Medium') AS medium_risk_segments"),
        F.expr("coalesce(max(abs_calibration_gap), 0.0D) AS max_abs_calibration_gap"),
    )


def segment_heatmap(report: DataFrame, group_cols=(), bins: int = 4, top: int = 5) -> DataFrame:
    """Features with the largest gap x their segments in report order; missing cells are 0."""
    keys = [*group_cols, "feature"]
    partition = ", ".join(f"`{k}`" for k in keys)
    per_group = ", ".join(f"`{g}`" for g in group_cols) or "1"
    numbered = report.selectExpr(
        *[f"`{k}`" for k in keys],
        "abs_calibration_gap",
        f"max(abs_calibration_gap) OVER (PARTITION BY {partition}) AS worst",
        f"row_number() OVER (PARTITION BY {partition} ORDER BY CASE risk_level WHEN 'High' THEN 0 WHEN 'Medium' THEN 1"
        " ELSE 2 END, abs_calibration_gap DESC, segment) AS no",
    )
    ranked = numbered.selectExpr("*", f"dense_rank() OVER (PARTITION BY {per_group} ORDER BY worst DESC, feature) AS place")
    # one number: a report made with more bins has more cells
    most = numbered.agg(F.max("no")).first()[0] or 0
    slots = list(range(1, max(most, bins + 1) + 1))
    pivot = ranked.where(F.col("place") <= top).groupBy(*keys).pivot("no", slots).agg(F.expr("first(abs_calibration_gap)"))
    return pivot.fillna(0.0).withColumnsRenamed({str(i): f"S{i}" for i in slots})
