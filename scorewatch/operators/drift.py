"""Distribution drift between the train and current window.

Inputs are one frame holding both windows, told apart by `win` ('train' / 'current'). All distances of all
features come from one frame of distinct values with running counts (see `rank`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Thresholds, with_version
from ..functions.clean import finite_sql, lerp_sql, mean_change_sql, number_sql
from ..functions.kolmogorov import ks_pvalue
from ..functions.text import choose, fixed, general, quote, sentence
from ..session import join_per_group, keyed_join, ordered
from . import rank
from .selection import window_columns

BINS = 10
SHARE_FLOOR = "1E-6"
WINDOW_COUNTS = {
    "train": "CASE WHEN win = 'train' THEN 1L ELSE 0L END",
    "current": "CASE WHEN win = 'current' THEN 1L ELSE 0L END",
}
# Quantiles of scores that the summary reports: name suffix -> fraction.
SCORE_QUANTILES = {"p10": (1, 10), "p50": (5, 10), "p90": (9, 10)}


def long_values(df: DataFrame, features, keep=()) -> DataFrame:
    """Finite feature values as rows (keep..., feature, value).

    Written as an array of structs: Spark recognises two uses of it as one exchange, which it does not for unpivot.
    """
    cells = ", ".join(f"struct({quote(f)} AS feature, {finite_sql(f)} AS value)" for f in features)
    return df.selectExpr(*[f"`{k}`" for k in keep], f"inline(array({cells}))").where("value IS NOT NULL")


def distances(
    df: DataFrame,
    features,
    group_cols=(),
    measures=("psi", "ks", "wasserstein"),
    quantiles=False,
    rows_per_bucket: int = rank.ROWS_PER_BUCKET,
) -> DataFrame:
    """One row per (group, feature) with finite values: counts, PSI, KS statistic, Wasserstein-1, quantiles.

    PSI uses the train deciles as `[a, b)` buckets with open outer ends, or ten equal-width buckets over both
    windows when the deciles have at most two distinct values; shares are floored at 1e-6.
    """
    keys = [*group_cols, "feature"]
    values = long_values(df, features, [*group_cols, "win"])
    spread = rank.measure(values, keys, "value", rows_per_bucket, df, group_cols, len(features))
    distinct = rank.value_counts(values, keys, "value", WINDOW_COUNTS)
    running = rank.running_counts(distinct, keys, ["train", "current"], spread)

    gap = "abs(try_divide(train_upto, train_all) - try_divide(current_upto, current_all))"
    aggregates = [
        F.expr("max(train_all) AS n_train"),
        F.expr("max(current_all) AS n_current"),
        F.expr("min(value) AS low"),
        F.expr("max(value) AS high"),
        F.expr("count_if(train > 0) AS train_distinct"),
        F.expr("count_if(current > 0) AS current_distinct"),
    ]
    if "ks" in measures:
        aggregates.append(F.expr(f"coalesce(max({gap}), 0.0D) AS ks_statistic"))
    if "wasserstein" in measures:
        aggregates.append(F.expr(f"coalesce(sum({gap} * (next_value - value)), 0.0D) AS wasserstein_distance"))
    if "psi" in measures or quantiles:
        deciles = {f"train_q{i}": rank.position("train_all", i, BINS) for i in range(BINS + 1)}
        aggregates += rank.order_statistics("train", deciles)
    if quantiles:
        wanted = {f"current_{q}": rank.position("current_all", i, of) for q, (i, of) in SCORE_QUANTILES.items()}
        aggregates += rank.order_statistics("current", wanted)
    stats = running.groupBy(*keys).agg(*aggregates)

    columns = ["n_train", "n_current", "low", "high", "train_distinct", "current_distinct"]
    columns += [f"{m}_{n}" for m, n in (("ks", "statistic"), ("wasserstein", "distance")) if m in measures]
    picked = [f"`{c}`" for c in (*keys, *columns)]
    if quantiles:
        for q, (i, of) in SCORE_QUANTILES.items():
            picked.append(f"{rank.interpolated(f'train_q{i * BINS // of}', rank.position('n_train', i, of))} AS train_{q}")
            picked.append(f"{rank.interpolated(f'current_{q}', rank.position('n_current', i, of))} AS current_{q}")
            columns += [f"train_{q}", f"current_{q}"]
    if "psi" not in measures:
        return stats.selectExpr(*picked)
    bounded = not group_cols or spread.few_keys  # one row per feature, or a counted number of keys
    return _with_psi(distinct, stats.selectExpr(*picked, *_decile_ends()), keys, columns, bounded)


def _decile_ends() -> tuple[str, str]:
    lows = ", ".join(f"train_q{i}_lo" for i in range(BINS + 1))
    highs = ", ".join(f"train_q{i}_hi" for i in range(BINS + 1))
    return f"array({lows}) AS lows", f"array({highs}) AS highs"


def _with_psi(distinct: DataFrame, stats: DataFrame, keys, columns, bounded: bool) -> DataFrame:
    """Bin the distinct values by the cuts of their key and add the population stability index to `columns`.

    The statistics ride along with the cuts, so the running counts behind them are computed once.
    """
    at = rank.position("n_train", "i", BINS)
    key_sql = [f"`{k}`" for k in keys]
    deciles = stats.withColumn(
        "deciles",
        F.expr(f"array_distinct(transform(lows, (lo, i) -> {lerp_sql('lo', 'highs[i]', f'({at} - floor({at}))')}))"),
    )
    cuts = deciles.selectExpr(
        *key_sql,
        *columns,
        "CASE WHEN size(deciles) > 2 THEN slice(deciles, 2, size(deciles) - 2)"
        f" ELSE transform(sequence(1, {BINS - 1}), i -> double(i) * ((high - low) / {BINS}.0D) + low) END AS cuts",
    )
    binned = keyed_join(distinct, cuts, keys, broadcast=bounded).withColumn(
        "bin", F.expr("size(filter(cuts, e -> e <= value))")
    )
    summed = binned.groupBy(*keys).agg(
        *[F.expr(f"first({c}) AS {c}") for c in columns],
        *[F.expr(f"sum({w}) FILTER (WHERE bin = {b}) AS {w}_{b}") for w in WINDOW_COUNTS for b in range(BINS)],
    )

    def share(window, b):
        return f"greatest(coalesce({window}_{b}, 0) / n_{window}, double({SHARE_FLOOR}))"

    # a bin empty in both windows has equal floored shares and adds 0
    pairs = ", ".join(f"struct({share('train', b)} AS t, {share('current', b)} AS c)" for b in range(BINS))
    total = f"aggregate(array({pairs}), 0.0D, (acc, s) -> acc + (s.c - s.t) * ln(s.c / s.t))"
    # an empty window gives 0; a single value over both windows 0; one constant against another constant 1
    return summed.selectExpr(
        *key_sql,
        *columns,
        "CASE WHEN n_train = 0 OR n_current = 0 OR low = high THEN 0.0D"
        f" WHEN train_distinct = 1 AND current_distinct = 1 THEN 1.0D ELSE {total} END AS psi",
    )


def with_ks_pvalue(df: DataFrame) -> DataFrame:
    """Asymptotic two-sample p-value at the effective sample size; two different constants give exactly 0."""
    return df.withColumn("raw_p", ks_pvalue(F.col("ks_statistic"), F.col("n_train"), F.col("n_current"))).withColumn(
        "ks_pvalue",
        F.expr("CASE WHEN train_distinct = 1 AND current_distinct = 1 AND low < high THEN 0.0D ELSE raw_p END"),
    ).drop("raw_p")


PROFILE = ("train_mean", "current_mean", "train_missing_rate", "current_missing_rate", "train_min", "train_max")


def feature_profile(df: DataFrame, features, group_cols=()) -> DataFrame:
    """Rows, means, missing rates, train min and max per (group, feature): one wide aggregate, one scan."""
    keep = [f"`{g}`" for g in group_cols]
    clean = df.selectExpr(*keep, "win", *[f"{number_sql(f)} AS `{f}`" for f in features])
    train, current = "FILTER (WHERE win = 'train')", "FILTER (WHERE win = 'current')"
    aggregates = [F.expr(f"count(*) {train} AS train_rows"), F.expr(f"count(*) {current} AS current_rows")]
    for f in features:
        miss = f"avg(double(`{f}` IS NULL))"
        texts = (
            f"avg(`{f}`) {train}",
            f"avg(`{f}`) {current}",
            f"{miss} {train}",
            f"{miss} {current}",
            f"min(`{f}`) {train}",
            f"max(`{f}`) {train}",
        )
        aggregates += [F.expr(f"{t} AS `{f}|{n}`") for t, n in zip(texts, PROFILE)]
    wide = clean.groupBy(*group_cols).agg(*aggregates)
    structs = ", ".join(
        f"struct({i} AS feature_no, {quote(f)} AS feature, " + ", ".join(f"`{f}|{n}` AS {n}" for n in PROFILE) + ")"
        for i, f in enumerate(features)
    )
    return wide.selectExpr(*keep, "train_rows", "current_rows", f"inline(array({structs}))").selectExpr(
        "*",
        "(coalesce(current_missing_rate, 0.0D) - coalesce(train_missing_rate, 0.0D)) * 100.0D AS missing_rate_change_pct_points",
        f"{mean_change_sql('train_mean', 'current_mean')} AS mean_change_pct",
    )


def missing_rate_shift(profile: DataFrame, group_cols=()) -> DataFrame:
    return profile.select(
        *group_cols, "feature", "train_missing_rate", "current_missing_rate", "missing_rate_change_pct_points"
    )


def drift_level(psi: str, p: str, t: Thresholds) -> str:
    return choose(
        [
            (f"{psi} >= {t.psi_high}D OR {p} < {t.ks_pvalue_high}D", "'High'"),
            (f"{psi} >= {t.psi_medium}D OR {p} < {t.ks_pvalue_medium}D", "'Medium'"),
        ],
        "'Low'",
    )


def drift_reason(psi: str, p: str, t: Thresholds) -> str:
    """First rule that fired, PSI before the p-value."""

    def crossed(level, measure, value, side, which, limit):
        return sentence(
            quote(f"{level} because {measure} "), value, quote(f" is {side} configured {which} threshold {limit}.")
        )

    psi_text, p_text = fixed(psi, 4), general(p, 4)
    return choose(
        [
            (f"{psi} >= {t.psi_high}D", crossed("High", "PSI", psi_text, "at or above", "high", f"{t.psi_high:.4f}")),
            (f"{p} < {t.ks_pvalue_high}D", crossed("High", "KS p-value", p_text, "below", "high", f"{t.ks_pvalue_high:.4g}")),
            (f"{psi} >= {t.psi_medium}D", crossed("Medium", "PSI", psi_text, "at or above", "medium", f"{t.psi_medium:.4f}")),
            (
                f"{t.ks_pvalue_medium}D > 0 AND {p} < {t.ks_pvalue_medium}D",
                crossed("Medium", "KS p-value", p_text, "below", "medium", f"{t.ks_pvalue_medium:.4g}"),
            ),
        ],
        quote("Low because PSI and KS p-value did not cross configured drift thresholds."),
    )


DRIFT_ACTION = choose(
    [
        (
            "abs(missing_rate_change_pct_points) >= 5",
            quote("Investigate upstream data quality before interpreting drift."),
        ),
        (
            "drift_level = 'High'",
            quote("Review feature lineage and business context before relying on current-window scoring."),
        ),
        ("drift_level = 'Medium'", quote("Monitor in the next run and confirm whether the shift is expected.")),
    ],
    quote("No immediate action; continue routine monitoring."),
)


def feature_drift_report(
    df: DataFrame,
    features,
    group_cols=(),
    thresholds: Thresholds = Thresholds(),
    feature_types: dict[str, str] | None = None,
    rows_per_bucket: int = rank.ROWS_PER_BUCKET,
    profile: DataFrame | None = None,
) -> DataFrame:
    """Every drift figure, level, reason and action per feature, highest PSI first."""
    keys = [*group_cols, "feature"]
    profile = feature_profile(df, features, group_cols) if profile is None else profile
    stats = with_ks_pvalue(distances(df, features, group_cols, rows_per_bucket=rows_per_bucket))
    stats = stats.select(*keys, "psi", "ks_statistic", "ks_pvalue", "wasserstein_distance")
    # without groups both sides have one row per feature
    joined = keyed_join(profile, stats, keys, "left", broadcast=not group_cols)
    # a feature with no finite value in either window has no distance row
    filled = joined.fillna({"psi": 0.0, "ks_statistic": 0.0, "ks_pvalue": 1.0, "wasserstein_distance": 0.0})
    kinds = [(f"feature = {quote(f)}", quote(k)) for f, k in (feature_types or {}).items()]
    levelled = filled.selectExpr(
        "*",
        f"{choose(kinds, quote('numeric')) if kinds else quote('numeric')} AS feature_type",
        f"{drift_level('psi', 'ks_pvalue', thresholds)} AS drift_level",
        f"{drift_reason('psi', 'ks_pvalue', thresholds)} AS drift_level_reason",
    )
    report = levelled.selectExpr(
        f"{quote(thresholds.config_version)} AS config_version",
        *[f"`{k}`" for k in keys],
        "feature_type",
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
        "drift_level_reason",
        f"{DRIFT_ACTION} AS recommended_action",
    )
    return ordered(report, group_cols, F.desc("psi"), "feature")


def top_drift(report: DataFrame, k: int = 8) -> DataFrame:
    """The k features with the highest PSI."""
    return report.orderBy(F.desc("psi"), "feature").limit(k)


def drift_at_level(report: DataFrame, *levels: str) -> DataFrame:
    return report.where(F.col("drift_level").isin(*levels))


def material_missing(profile: DataFrame, points: float = 5.0) -> DataFrame:
    """Features whose missing rate moved by at least `points` percentage points."""
    return profile.where(F.abs("missing_rate_change_pct_points") >= points)


# ---------------------------------------------------------------- prediction scores


def _label_rates(preds: DataFrame, predicted: str, actual: str, target: str | None = None) -> list:
    """Aggregates: positive rate of the predicted and actual label per window; without labels the target stands in."""
    held = window_columns(preds)

    def rate(column, window):
        present = (held or {}).get(window, preds.columns)
        if column == actual and actual not in present and target:
            column = target
        if column not in present or column not in preds.columns:
            return "CAST(NULL AS DOUBLE)"
        return f"avg({number_sql(column)}) FILTER (WHERE win = '{window}')"

    return [
        F.expr(f"{rate(column, window)} AS {name}_{kind}_positive_rate")
        for column, kind in ((predicted, "predicted"), (actual, "actual"))
        for window, name in (("train", "reference"), ("current", "current"))
    ]


LABEL_CHANGES = (
    "(current_predicted_positive_rate - reference_predicted_positive_rate) * 100.0D AS predicted_positive_rate_change_pct_points",
    "(current_actual_positive_rate - reference_actual_positive_rate) * 100.0D AS actual_positive_rate_change_pct_points",
    "current_predicted_positive_rate - current_actual_positive_rate AS prediction_actual_rate_gap",
)


def label_mix_shift(
    preds: DataFrame, group_cols=(), predicted="predicted_label", actual="actual_label", target: str | None = None
) -> DataFrame:
    """Predicted and actual positive rates per window, their change, and the current predicted-actual gap."""
    return preds.groupBy(*group_cols).agg(*_label_rates(preds, predicted, actual, target)).selectExpr("*", *LABEL_CHANGES)


SCORE_ACTION = choose(
    [
        (
            "prediction_drift_level = 'High'",
            quote("Review score distribution movement before using current-window model decisions."),
        ),
        (
            "prediction_drift_level = 'Medium'",
            quote("Monitor score distribution and confirm whether decision mix shift is expected."),
        ),
        (
            "prediction_drift_level = 'Low'",
            quote("No immediate prediction drift action; continue routine monitoring."),
        ),
    ],
    "NULL",
)


def prediction_drift_summary(
    preds: DataFrame,
    score: str = "score",
    group_cols=(),
    thresholds: Thresholds = Thresholds(),
    predicted="predicted_label",
    actual="actual_label",
    rows_per_bucket: int = rank.ROWS_PER_BUCKET,
    target: str | None = None,
) -> DataFrame:
    """Score distributions of both windows, their drift and the label mix; level Unknown without reference scores."""
    group_cols = list(group_cols)
    keep = [f"`{g}`" for g in group_cols]
    if score not in preds.columns:
        groups = preds.groupBy(*group_cols).agg(F.expr("count(*) AS current_row_count"))
        return with_version(groups, thresholds).selectExpr(
            "config_version",
            *keep,
            "false AS available",
            "'Unknown' AS prediction_drift_level",
            "'Unknown because the configured prediction column is missing.' AS prediction_drift_reason",
            quote(f"Missing `{score}` in predictions file.") + " AS message",
        )
    aggregates = []
    for window, name in (("train", "reference"), ("current", "current")):
        s, only = number_sql(score), f"FILTER (WHERE win = '{window}')"
        aggregates.append(F.expr(f"count(*) {only} AS {name}_row_count"))
        for f, n in (("avg", "mean"), ("stddev_samp", "std"), ("min", "min"), ("max", "max")):
            aggregates.append(F.expr(f"{f}({s}) {only} AS {name}_score_{n}"))
    basics = preds.groupBy(*group_cols).agg(*aggregates, *_label_rates(preds, predicted, actual, target))
    basics = basics.selectExpr("*", *LABEL_CHANGES)
    stats = with_ks_pvalue(distances(preds, [score], group_cols, quantiles=True, rows_per_bucket=rows_per_bucket))
    stats = stats.selectExpr(
        *keep,
        *[f"train_{q} AS reference_score_{q}" for q in SCORE_QUANTILES],
        *[f"current_{q} AS current_score_{q}" for q in SCORE_QUANTILES],
        "psi",
        "ks_statistic",
        "ks_pvalue",
        "wasserstein_distance",
    )
    joined = join_per_group(basics, stats, group_cols)
    carried = [c for c in joined.columns if c not in (*group_cols, "psi", "ks_statistic", "ks_pvalue", "wasserstein_distance")]
    known = "reference_row_count > 0"
    drift = joined.selectExpr(
        *keep,
        "true AS available",
        f"{known} AS reference_available",
        *carried,
        f"CASE WHEN {known} THEN {mean_change_sql('reference_score_mean', 'current_score_mean')} END AS score_mean_change_pct",
        f"CASE WHEN {known} THEN coalesce(psi, 0.0D) END AS score_psi",
        f"CASE WHEN {known} THEN coalesce(ks_statistic, 0.0D) END AS score_ks_statistic",
        f"CASE WHEN {known} THEN coalesce(ks_pvalue, 1.0D) END AS score_ks_pvalue",
        f"CASE WHEN {known} THEN coalesce(wasserstein_distance, 0.0D) END AS score_wasserstein_distance",
    )
    unknown = quote("Unknown because reference prediction scores are unavailable.")
    levelled = drift.selectExpr(
        "*",
        f"CASE WHEN {known} THEN {drift_level('score_psi', 'score_ks_pvalue', thresholds)} ELSE 'Unknown' END"
        " AS prediction_drift_level",
        f"CASE WHEN {known} THEN {drift_reason('score_psi', 'score_ks_pvalue', thresholds)} ELSE {unknown} END"
        " AS prediction_drift_reason",
    )
    return with_version(levelled.withColumn("recommended_action", F.expr(SCORE_ACTION)), thresholds)


def score_histogram(preds: DataFrame, score: str = "score", group_cols=(), bins: int = 20) -> DataFrame:
    """Share of each window's scores per equal-width bin on [0, 1]; out-of-range scores go to the end bins."""
    keys = [*group_cols, "win"]
    clean = preds.selectExpr(*[f"`{k}`" for k in keys], f"{finite_sql(score)} AS s").where("s IS NOT NULL")
    slot = F.expr(f"greatest(1, least({bins}, int(floor(s * {bins})) + 1)) AS bin")
    counts = clean.groupBy(*keys, slot).agg(F.expr("count(*) AS count"))
    # at most `bins` rows per window of a group
    share = f"count / sum(count) OVER (PARTITION BY {', '.join(f'`{k}`' for k in keys)}) AS share"
    return counts.selectExpr("*", share)
