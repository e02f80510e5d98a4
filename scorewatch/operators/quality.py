"""Data-quality findings: contract, duplicates, missing-rate shift, bounds, score range, label availability."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Thresholds
from ..functions.clean import number_sql
from ..functions.text import choose, fixed, general, percent, quote, sentence
from ..session import bounded, join_per_group, keyed_join, ordered
from .drift import feature_profile
from .selection import window_columns

FINDING = (
    "config_version",
    "source_train_features",
    "source_current_features",
    "source_current_predictions",
    "check_type",
    "dataset",
    "feature",
    "train_value",
    "current_value",
    "change_value",
    "issue_level",
    "message",
    "issue_reason",
)
# Metadata fields that must be filled.
REQUIRED_METADATA = (
    "model_name",
    "model_type",
    "target",
    "entity_id",
    "prediction_column",
    "business_use_case",
    "decision_supported",
    "feature_columns",
)
DATASET = "CASE win WHEN 'train' THEN 'train_{0}' ELSE 'current_{0}' END"


# ---------------------------------------------------------------- input contract


def expected_columns(spark: SparkSession, metadata: dict) -> DataFrame:
    """Columns the input contract needs. The target is needed in train only."""
    entity, features = metadata["entity_id"], list(metadata["feature_columns"])
    need = {
        "train_features": [entity, metadata["target"], *features],
        "current_features": [entity, *features],
        "current_predictions": [entity, metadata["prediction_column"]],
    }
    rows = [(d, c) for d, columns in need.items() for c in dict.fromkeys(columns)]
    return spark.createDataFrame(rows, "dataset string, column string")


def actual_columns(tables: dict[str, DataFrame]) -> DataFrame:
    """Columns and row count of every table that was supplied."""
    frames = []
    for name, df in tables.items():
        names = ", ".join(quote(c) for c in df.columns)
        frames.append(
            df.agg(F.expr("count(*) AS dataset_rows")).selectExpr(
                f"{quote(name)} AS dataset", f"explode(array({names})) AS column", "dataset_rows"
            )
        )
    joined = frames[0]
    for f in frames[1:]:
        joined = joined.unionAll(f)
    return joined


def contract_violations(
    spark: SparkSession, tables: dict[str, DataFrame], metadata: dict, defined_features=None
) -> DataFrame:
    """One row per broken rule: empty metadata field, missing column, feature without a definition."""
    actual = actual_columns(tables)
    missing = keyed_join(expected_columns(spark, metadata), actual, ["dataset", "column"], "left_anti")
    sizes = actual.groupBy("dataset").agg(F.expr("max(dataset_rows) AS dataset_rows"))
    columns = keyed_join(missing, sizes, ["dataset"], "left").selectExpr(
        "dataset", "column", "'missing column' AS problem", "coalesce(dataset_rows, 0L) AS dataset_rows"
    )
    empty = [("model_metadata", k, "empty field", 0) for k in REQUIRED_METADATA if metadata.get(k) in (None, "", [])]
    undefined = [
        ("feature_metadata", f, "undefined feature", 0)
        for f in metadata.get("feature_columns") or []
        if defined_features is not None and f not in defined_features
    ]
    schema = "dataset string, column string, problem string, dataset_rows long"
    return columns.unionAll(spark.createDataFrame(empty + undefined, schema))


# ---------------------------------------------------------------- single checks


def duplicate_entity_rate(df: DataFrame, ids, group_cols=(), also=()) -> DataFrame:
    """Share of rows after the first of their id (a NULL id is one id). Counts per id are combined map-side.

    `also` holds (name, condition) pairs whose share of rows is taken in the same pass.
    """
    counts = [F.expr("count(*) AS n"), *[F.expr(f"count_if({condition}) AS `{name}`") for name, condition in also]]
    per_id = df.groupBy(*group_cols, *ids).agg(*counts)
    return per_id.groupBy(*group_cols).agg(
        F.expr("coalesce(sum(n), 0L) AS row_count"),
        F.expr("coalesce(sum(n - 1), 0L) AS duplicate_rows"),
        F.expr("coalesce(sum(n - 1) / sum(n), 0.0D) AS duplicate_rate"),
        *[F.expr(f"coalesce(sum(`{name}`) / sum(n), 0.0D) AS `{name}`") for name, _ in also],
    )


def feature_bounds(profile: DataFrame, bounds: dict | None) -> DataFrame:
    """Lower and upper bound per feature: declared ones, else the train minimum and maximum."""
    given = bounds or {}
    lows = [(f"feature = {quote(f)}", f"{float(lo)!r}D") for f, (lo, _) in given.items() if lo is not None]
    highs = [(f"feature = {quote(f)}", f"{float(hi)!r}D") for f, (_, hi) in given.items() if hi is not None]
    return profile.withColumn("lower_bound", F.expr(choose(lows, "train_min") if lows else "train_min")).withColumn(
        "upper_bound", F.expr(choose(highs, "train_max") if highs else "train_max")
    )


def boundary_violations(
    df: DataFrame, features, bounds: dict | None = None, group_cols=(), profile: DataFrame | None = None
) -> DataFrame:
    """Share of current rows outside the bounds of each feature; a missing value is no violation."""
    keys = [*group_cols, "feature"]
    profile = feature_profile(df, features, group_cols) if profile is None else profile
    limits = feature_bounds(profile, bounds).select(*keys, "lower_bound", "upper_bound", "current_rows")
    clean = df.where("win = 'current'").selectExpr(
        *[f"`{g}`" for g in group_cols], *[f"{number_sql(f)} AS `value_{i}`" for i, f in enumerate(features)]
    )
    limits, small = bounded(limits, group_cols)
    # one row of limits per group beside the wide rows: nothing is unpivoted
    sides = (("low", "lower_bound"), ("high", "upper_bound"))
    wide = limits.groupBy(*group_cols).agg(
        *[F.expr(f"max({c}) FILTER (WHERE feature = {quote(f)}) AS {n}_{i}") for i, f in enumerate(features) for n, c in sides]
    )
    sums = join_per_group(clean, wide, group_cols, "inner", broadcast=small).groupBy(*group_cols).agg(
        *[F.expr(f"count_if(value_{i} < low_{i} OR value_{i} > high_{i}) AS n_{i}") for i in range(len(features))]
    )
    pairs = ", ".join(f"named_struct('feature', {quote(f)}, 'violations', n_{i})" for i, f in enumerate(features))
    counted = sums.selectExpr(*[f"`{g}`" for g in group_cols], f"inline(array({pairs}))")
    joined = keyed_join(limits, counted, keys, "left", broadcast=small)
    return joined.where("lower_bound IS NOT NULL AND upper_bound IS NOT NULL").selectExpr(
        *[f"`{k}`" for k in keys],
        "lower_bound",
        "upper_bound",
        "coalesce(violations, 0L) AS violations",
        "coalesce(try_divide(violations, current_rows), 0.0D) AS violation_rate",
    )


def score_out_of_range(preds: DataFrame, score: str = "score", group_cols=()) -> DataFrame:
    """Share of scores outside [0, 1] per window."""
    s = number_sql(score)
    return preds.groupBy(*group_cols, "win").agg(
        F.expr("count(*) AS row_count"),
        F.expr(f"avg(double(coalesce({s} < 0 OR {s} > 1, false))) AS out_of_range_rate"),
    )


# ---------------------------------------------------------------- levels and the report


def _rate_reason(rate: str) -> str:
    return f"CASE WHEN {rate} > 0 THEN 'High because non-zero rate was observed.' ELSE 'Low because no issue was observed.' END"


def _missing_rules(v: str, t: Thresholds) -> tuple[str, str]:
    level = choose(
        [(f"abs({v}) >= {t.missing_high_pp}D", "'High'"), (f"abs({v}) >= {t.missing_medium_pp}D", "'Medium'")], "'Low'"
    )

    def crossed(which, limit):
        return sentence(
            quote(f"{which} because missing-rate shift "),
            fixed(v, 2, sign=True),
            quote(f" pp is at or above configured {which.lower()} threshold {limit:.2f} pp."),
        )

    reason = choose(
        [
            (f"abs({v}) >= {t.missing_high_pp}D", crossed("High", t.missing_high_pp)),
            (f"abs({v}) >= {t.missing_medium_pp}D", crossed("Medium", t.missing_medium_pp)),
        ],
        quote("Low because missing-rate shift did not cross configured thresholds."),
    )
    return level, reason


def _boundary_rules(v: str, t: Thresholds) -> tuple[str, str]:
    high, medium = f"{v} >= {t.boundary_high_rate}D", f"{v} > {t.boundary_medium_rate}D"

    def crossed(which, side, limit):
        return sentence(
            quote(f"{which} because boundary violation rate "),
            percent(v),
            quote(f" is {side} configured {which.lower()} threshold {limit:.2%}."),
        )

    reason = choose(
        [
            (high, crossed("High", "at or above", t.boundary_high_rate)),
            (medium, crossed("Medium", "above", t.boundary_medium_rate)),
        ],
        quote("Low because no boundary violations crossed configured thresholds."),
    )
    return choose([(high, "'High'"), (medium, "'Medium'")], "'Low'"), reason


def data_quality_report(
    features_df: DataFrame,
    preds: DataFrame,
    features,
    entity: str,
    score: str,
    target: str | None,
    group_cols=(),
    thresholds: Thresholds = Thresholds(),
    bounds: dict | None = None,
    columns: dict[str, list[str]] | None = None,
    declared_features=None,
    sources: dict[str, str] | None = None,
    label: str = "actual_label",
    profile: DataFrame | None = None,
) -> DataFrame:
    """All findings of a review in one table of 13 columns (after the group columns).

    `columns` holds the column names of each dataset before the windows were stacked; train_predictions is
    left out when there is no reference log.
    """
    t, keep = thresholds, [f"`{g}`" for g in group_cols]
    profile = feature_profile(features_df, features, group_cols) if profile is None else profile
    if columns is None:
        both = {"train", "current"}
        held = {k: window_columns(df) or dict.fromkeys(both, df.columns) for k, df in (("features", features_df), ("predictions", preds))}
        columns = {f"{w}_{k}": held[k][w] for k in held for w in ("train", "current") if w in held[k]}
    has_reference = "train_predictions" in columns
    src = sources or {}
    blank = "CAST(NULL AS STRING)"

    def rows(frame, check, dataset, feature, train, current, change, level, message, reason, order):
        named = {
            "config_version": quote(t.config_version),
            "source_train_features": quote(src["train_features"]) if "train_features" in src else blank,
            "source_current_features": quote(src["current_features"]) if "current_features" in src else blank,
            "source_current_predictions": quote(src["current_predictions"]) if "current_predictions" in src else blank,
            "check_type": quote(check),
            "dataset": dataset,
            "feature": feature,
            "train_value": f"CAST({train} AS STRING)",
            "current_value": f"CAST({current} AS DOUBLE)",
            "change_value": f"CAST({change} AS DOUBLE)",
            "issue_level": level,
            "message": message,
            "issue_reason": reason,
        }
        return frame.selectExpr(*keep, *[f"{v} AS {k}" for k, v in named.items()], f"{order} AS finding_no")

    # per group, findings that only need the schemas
    groups = profile.where("feature_no = 0").select(*group_cols)
    wanted = {d: [entity, target, *(declared_features or features)] for d in ("train_features", "current_features")}
    wanted |= {d: [entity, score] for d in ("current_predictions", "train_predictions")}
    structs = []
    for i, (dataset, present) in enumerate((d, columns[d]) for d in wanted if d in columns):
        absent = [c for c in wanted[dataset] if c and c not in present]
        text = "Missing required columns: " + ", ".join(absent) if absent else "All required columns are present."
        structs.append(f"struct({quote(dataset)} AS dataset, {len(absent)} AS absent, {quote(text)} AS text, {i} AS i)")
    contract = groups.selectExpr(*keep, f"inline(array({', '.join(structs)}))")
    parts = [
        rows(
            contract,
            "required_columns_present",
            "dataset",
            blank,
            "NULL",
            "NULL",
            "absent",
            "CASE WHEN absent > 0 THEN 'High' ELSE 'Low' END",
            "text",
            "CASE WHEN absent > 0 THEN 'High because required columns are missing.'"
            " ELSE 'Low because all required columns are present.' END",
            "i",
        )
    ]

    # duplicates of both tables and both windows; the score range comes from the same pass over the predictions
    scored = score in preds.columns
    outside = [("out_of_range_rate", f"{number_sql(score)} < 0 OR {number_sql(score)} > 1")] if scored else []
    scores = None
    for kind, df, base in (("features", features_df, 10), ("predictions", preds, 12)):
        if entity not in df.columns:
            continue
        dup = duplicate_entity_rate(df, [entity], [*group_cols, "win"], outside if kind == "predictions" else ())
        windows = [w for w in ("train", "current") if kind == "features" or w == "current" or has_reference]
        # a window without rows has a rate of 0, not a missing finding
        due = groups.selectExpr(*keep, f"explode(array({', '.join(quote(w) for w in windows)})) AS win")
        dup = keyed_join(due, dup, [*group_cols, "win"], "left").fillna(0)
        scores = dup if kind == "predictions" else scores
        in_train = f"win = 'train' AND {str(kind == 'predictions').lower()}"
        parts.append(
            rows(
                dup,
                "duplicate_entity_rate",
                DATASET.format(kind),
                quote(entity),
                f"CASE WHEN {in_train} THEN duplicate_rate END",
                f"CASE WHEN NOT ({in_train}) THEN duplicate_rate END",
                "duplicate_rate",
                "CASE WHEN duplicate_rate > 0 THEN 'High' ELSE 'Low' END",
                sentence(quote("Duplicate entity rate is "), percent("duplicate_rate"), quote(".")),
                _rate_reason("duplicate_rate"),
                f"{base} + CASE WHEN win = 'train' THEN 0 ELSE 1 END",
            )
        )

    v = "missing_rate_change_pct_points"
    level, reason = _missing_rules(v, t)
    parts.append(
        rows(
            profile,
            "missing_rate_change_pct_points",
            quote("current_features"),
            "feature",
            "coalesce(train_missing_rate, 0.0D)",
            "coalesce(current_missing_rate, 0.0D)",
            v,
            level,
            sentence(quote("Missing rate changed by "), fixed(v, 2, sign=True), quote(" percentage points.")),
            reason,
            "100 + 2 * feature_no",
        )
    )
    numbered = ", ".join(f"{quote(f)}, {i}" for i, f in enumerate(features))
    violations = boundary_violations(features_df, features, bounds, group_cols, profile)
    level, reason = _boundary_rules("violation_rate", t)
    parts.append(
        rows(
            violations,
            "boundary_violation_rate",
            quote("current_features"),
            "feature",
            sentence(quote("["), general("lower_bound", 6), quote(", "), general("upper_bound", 6), quote("]")),
            "violation_rate",
            "violation_rate",
            level,
            sentence(quote("Current values outside training/metadata bounds: "), percent("violation_rate"), quote(".")),
            reason,
            f"101 + 2 * map({numbered})[feature]",
        )
    )
    if scored:
        scores = score_out_of_range(preds, score, group_cols) if scores is None else scores
        parts.append(
            rows(
                scores,
                "prediction_score_out_of_range_rate",
                DATASET.format("predictions"),
                quote(score),
                "CASE WHEN win = 'train' THEN string(out_of_range_rate) ELSE '[0, 1]' END",
                "CASE WHEN win = 'current' THEN out_of_range_rate END",
                "out_of_range_rate",
                "CASE WHEN out_of_range_rate > 0 THEN 'High' ELSE 'Low' END",
                sentence(quote("Prediction scores outside [0, 1]: "), percent("out_of_range_rate"), quote(".")),
                _rate_reason("out_of_range_rate"),
                "100000 + CASE WHEN win = 'train' THEN 1 ELSE 0 END",
            )
        )
    labelled = bool({label, target} & set(columns["current_predictions"])) or target in columns["current_features"]
    parts.append(
        rows(
            groups,
            "label_availability",
            quote("current_predictions"),
            quote(target) if target else blank,
            "NULL",
            "1" if labelled else "0",
            "NULL",
            quote("Low" if labelled else "Medium"),
            quote("Current labels are available." if labelled else "Current labels are unavailable."),
            quote(
                "Low because current labels are available."
                if labelled
                else "Medium because current labels are unavailable for outcome validation."
            ),
            "200000",
        )
    )
    report = parts[0]
    for p in parts[1:]:
        report = report.unionAll(p)
    if not has_reference:
        report = report.where("dataset <> 'train_predictions'")
    return ordered(report, group_cols, "finding_no").select(*group_cols, *FINDING)


def issue_counts(report: DataFrame, group_cols=()) -> DataFrame:
    return report.groupBy(*group_cols, "issue_level").agg(F.expr("count(*) AS issue_count"))
