"""Review thresholds: defaults, JSON files, flat rows."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Thresholds:
    """Every rule threshold of a review. Fixed default values."""

    config_version: str = "v1"
    psi_medium: float = 0.10
    psi_high: float = 0.25
    ks_pvalue_medium: float = 0.05
    ks_pvalue_high: float = 0.01
    missing_medium_pp: float = 5.0
    missing_high_pp: float = 20.0
    boundary_medium_rate: float = 0.0
    boundary_high_rate: float = 0.05
    cluster_medium_pp: float = 5.0
    cluster_high_pp: float = 10.0
    severe_psi: float = 0.50
    severe_ks_pvalue: float = 0.001
    drift_gate_mode: str = "flag"
    vif_medium: float = 5.0
    vif_high: float = 10.0
    overfit_medium: float = 0.03
    overfit_high: float = 0.07
    segment_min_count: int = 10
    segment_gap_medium: float = 0.10
    segment_gap_high: float = 0.20
    min_feedback_events: int = 2

    def override(self, **values) -> "Thresholds":
        return replace(self, **values)


# Dotted path in a threshold file -> field. Later paths win, so the nested spelling overrides the flat one.
# Fixed values.
PATHS = {
    "config_version": "config_version",
    "drift.psi_medium": "psi_medium",
    "drift.psi_high": "psi_high",
    "drift.ks_pvalue_medium": "ks_pvalue_medium",
    "drift.ks_pvalue_high": "ks_pvalue_high",
    "drift.missing_rate_change_pct_points": "missing_medium_pp",
    "drift.missing_rate_high_pct_points": "missing_high_pp",
    "drift.boundary_violation_medium_rate": "boundary_medium_rate",
    "drift.boundary_violation_high_rate": "boundary_high_rate",
    "drift.cluster_shift_medium_pct_points": "cluster_medium_pp",
    "drift.cluster_shift_high_pct_points": "cluster_high_pp",
    "diagnostics.severe_psi_threshold": "severe_psi",
    "diagnostics.severe_ks_pvalue_threshold": "severe_ks_pvalue",
    "diagnostics.drift_gate_mode": "drift_gate_mode",
    "diagnostics.vif_medium": "vif_medium",
    "diagnostics.vif_high": "vif_high",
    "diagnostics.vif_thresholds.medium": "vif_medium",
    "diagnostics.vif_thresholds.high": "vif_high",
    "diagnostics.overfit_delta_medium": "overfit_medium",
    "diagnostics.overfit_delta_high": "overfit_high",
    "diagnostics.overfitting_delta_thresholds.medium": "overfit_medium",
    "diagnostics.overfitting_delta_thresholds.high": "overfit_high",
    "diagnostics.segment_performance_thresholds.minimum_segment_count": "segment_min_count",
    "diagnostics.segment_performance_thresholds.calibration_gap_medium": "segment_gap_medium",
    "diagnostics.segment_performance_thresholds.calibration_gap_high": "segment_gap_high",
    "feedback.false_positive_threshold_for_review": "min_feedback_events",
    "feedback.minimum_feedback_events_for_recommendation": "min_feedback_events",
}


def flatten(tree: dict, prefix: str = "") -> dict:
    """Nested objects as {dotted path: leaf}."""
    flat = {}
    for key, value in tree.items():
        path = f"{prefix}{key}"
        flat.update(flatten(value, path + ".") if isinstance(value, dict) else {path: value})
    return flat


def thresholds_from(tree: dict) -> Thresholds:
    """Defaults overridden by the known paths of a nested threshold object."""
    flat = flatten(tree)
    kinds = {f.name: type(f.default) for f in fields(Thresholds)}
    given = {field: kinds[field](flat[path]) for path, field in PATHS.items() if flat.get(path) is not None}
    return Thresholds(**given)


def read_thresholds(spark: SparkSession, path: str, sections: dict[str, str] | None = None) -> Thresholds:
    """Load a JSON threshold file; the defaults apply when it does not exist.

    `sections` renames the file's top-level objects onto drift / diagnostics / report / feedback.
    """
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path):
        return Thresholds(config_version="fallback_defaults")
    text = spark.read.text(path, wholetext=True).first()[0]
    tree = json.loads(text)
    return thresholds_from({(sections or {}).get(k, k): v for k, v in tree.items()})


def config_rows(spark: SparkSession, t: Thresholds) -> DataFrame:
    """Active thresholds as rows (config_version, path, value)."""
    rows = [(t.config_version, path, str(getattr(t, field))) for path, field in PATHS.items()]
    return spark.createDataFrame(rows, "config_version string, path string, value string")


DEPTH = 5


def config_documents(documents: DataFrame, key: str, config: str) -> DataFrame:
    """Active thresholds of many threshold files: rows (key, field, value, given), a row per field of every file.

    `documents` holds a key and the file's text. Nested objects are flattened to dotted paths (at most `DEPTH` deep); of
    two spellings of a field the later path of PATHS wins; a null value counts as not given. A missing file (null text)
    has the defaults under the version `fallback_defaults`.
    """
    spark = documents.sparkSession
    level = documents.select(F.col(key).alias("k"), F.parse_json(config).alias("v"), F.lit("").alias("prefix")).where("v IS NOT NULL")
    flat = None
    for _ in range(DEPTH):
        found = spark.sql(
            "SELECT k, concat(prefix, e.key) AS path, e.value AS v, schema_of_variant(e.value) AS kind"
            " FROM {level}, LATERAL variant_explode(v) e",
            level=level,
        )
        leaves = found.where("kind NOT LIKE 'OBJECT%' AND kind <> 'VOID'").selectExpr("k", "path", "CAST(v AS STRING) AS value")
        flat = leaves if flat is None else flat.unionAll(leaves)
        level = found.where("kind LIKE 'OBJECT%'").selectExpr("k", "v", "concat(path, '.') AS prefix")
    # fixed by the module: a row per path, a row per field
    paths = spark.createDataFrame([(p, f, i) for i, (p, f) in enumerate(PATHS.items())], "path string, field string, place int")
    given = flat.join(F.broadcast(paths), "path").groupBy("k", "field").agg(F.expr("max_by(value, place) AS value"))
    defaults = spark.createDataFrame([(f.name, str(f.default)) for f in fields(Thresholds)], "field string, fallback string")
    every = documents.select(F.col(key).alias("k"), F.col(config).isNull().alias("missing")).crossJoin(F.broadcast(defaults))
    version = "CASE WHEN missing AND field = 'config_version' THEN 'fallback_defaults' ELSE fallback END"
    return every.join(given, ["k", "field"], "left").selectExpr(
        f"k AS `{key}`", "field", f"coalesce(value, {version}) AS value", "value IS NOT NULL AS given"
    )


def with_version(df: DataFrame, t: Thresholds) -> DataFrame:
    return df.withColumn("config_version", F.lit(t.config_version))
