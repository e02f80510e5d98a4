from scorewatch.config import Thresholds
from scorewatch.operators import impute, quality
from scorewatch.operators.selection import (
    label_column,
    model_features,
    review_features,
    score_column,
    stack_windows,
)

ROWS = "win string, id string, x double, y double, target int"


def tables(spark):
    f = spark.createDataFrame(
        [
            ("train", "a", 1.0, 1.0, 0),
            ("train", "b", 3.0, None, 1),
            ("train", "b", 2.0, 5.0, 1),
            ("train", None, 2.0, 5.0, 1),
            ("train", None, 2.0, 5.0, 1),
            ("current", "a", 9.0, None, 0),
            ("current", "c", 2.0, None, 0),
            ("current", "d", None, float("nan"), 0),
            ("current", "e", 0.5, 4.0, 0),
        ],
        ROWS,
    )
    p = spark.createDataFrame(
        [("current", "a", 1.5, 1), ("current", "c", 0.5, 0), ("train", "a", 0.1, 0)], "win string, id string, score double, actual_label int"
    )
    return f, p


def test_report_levels_and_text(spark):
    f, p = tables(spark)
    report = quality.data_quality_report(f, p, ["x", "y"], "id", "score", "target", bounds={"y": (0.0, 10.0)})
    assert report.columns == list(quality.FINDING)
    rows = {(r["check_type"], r["dataset"], r["feature"]): r for r in report.collect()}
    dup = rows[("duplicate_entity_rate", "train_features", "id")]
    assert dup["change_value"] == 0.4 and dup["issue_level"] == "High" and dup["message"] == "Duplicate entity rate is 40.00%."
    assert rows[("duplicate_entity_rate", "current_features", "id")]["issue_level"] == "Low"
    miss = rows[("missing_rate_change_pct_points", "current_features", "y")]
    assert abs(miss["change_value"] - 55) < 1e-9 and miss["issue_level"] == "High"
    assert miss["issue_reason"] == "High because missing-rate shift +55.00 pp is at or above configured high threshold 20.00 pp."
    bound = rows[("boundary_violation_rate", "current_features", "x")]
    assert bound["train_value"] == "[1, 3]" and bound["change_value"] == 0.5 and bound["issue_level"] == "High"
    assert rows[("boundary_violation_rate", "current_features", "y")]["train_value"] == "[0, 10]"
    assert rows[("prediction_score_out_of_range_rate", "current_predictions", "score")]["change_value"] == 0.5
    assert rows[("label_availability", "current_predictions", "target")]["issue_level"] == "Low"
    counts = {r["issue_level"]: r["issue_count"] for r in quality.issue_counts(report).collect()}
    assert counts["High"] == 5


def test_missing_columns_and_no_reference(spark):
    f, p = tables(spark)
    columns = {
        "train_features": ["id", "x", "target"],
        "current_features": ["id", "x"],
        "current_predictions": ["id", "score"],
    }
    report = quality.data_quality_report(
        f, p.where("win = 'current'"), ["x"], "id", "score", "target", columns=columns, declared_features=["x", "y"]
    ).collect()
    required = {r["dataset"]: r for r in report if r["check_type"] == "required_columns_present"}
    assert set(required) == set(columns)
    assert required["current_features"]["change_value"] == 2.0 and required["current_features"]["issue_level"] == "High"
    assert required["current_features"]["message"] == "Missing required columns: target, y"
    assert not any(r["dataset"] == "train_predictions" for r in report)
    label = [r for r in report if r["check_type"] == "label_availability"][0]
    assert label["issue_level"] == "Medium" and label["current_value"] == 0.0


def test_threshold_sensitivity(spark):
    f, p = tables(spark)
    calm = Thresholds(missing_medium_pp=90, missing_high_pp=95, boundary_high_rate=0.9, boundary_medium_rate=0.8)
    report = quality.data_quality_report(f, p, ["x", "y"], "id", "score", "target", thresholds=calm)
    kinds = ("missing_rate_change_pct_points", "boundary_violation_rate")
    assert all(r["issue_level"] == "Low" for r in report.collect() if r["check_type"] in kinds)


def test_contract(spark):
    f, p = tables(spark)
    metadata = {
        "model_name": "m",
        "model_type": "classification",
        "target": "target",
        "entity_id": "id",
        "prediction_column": "probability",
        "business_use_case": "b",
        "decision_supported": "",
        "feature_columns": ["x", "z"],
    }
    found = quality.contract_violations(
        spark,
        {"train_features": f, "current_features": f.drop("target"), "current_predictions": p},
        metadata,
        defined_features={"x"},
    )
    assert {(r["dataset"], r["column"], r["problem"]) for r in found.collect()} == {
        ("train_features", "z", "missing column"),
        ("current_features", "z", "missing column"),
        ("current_predictions", "probability", "missing column"),
        ("model_metadata", "decision_supported", "empty field"),
        ("feature_metadata", "z", "undefined feature"),
    }


def test_imputation(spark):
    f, _ = tables(spark)
    for size in (10**6, 1):
        own = impute.median_imputed(f, ["x", "y"], ["win"], rows_per_bucket=size)
        assert sorted(r["y"] for r in own.where("win = 'current'").collect()) == [4.0] * 4
        cross = impute.median_imputed(f, ["x", "y"], from_window="train", rows_per_bucket=size)
        assert sorted(r["y"] for r in cross.where("win = 'current'").collect()) == [4.0, 5.0, 5.0, 5.0]
    empty = spark.createDataFrame([(None,), (None,)], "z double")
    assert [r["z"] for r in impute.median_imputed(empty, ["z"]).collect()] == [0.0, 0.0]


def test_column_choices(spark):
    train = spark.createDataFrame([("a", 1, 2.0, 0.5, 1)], "id string, x int, y double, risk_score double, target int")
    current = train.drop("y")
    assert review_features(train, current, ["x", "y", "id"], "target", "id") == ["x"]
    assert review_features(train, current, [], "target", "id") == ["x", "risk_score"]
    assert model_features(train, train, [], "target", "id") == ["x", "y"]
    assert model_features(train, current, ["x", "y"], "target", "id") == ["x"]
    assert score_column(train.withColumnRenamed("y", "y_pred_proba")) == "y_pred_proba"
    assert label_column(train) == "target" and label_column(train.drop("target")) is None
    assert stack_windows(None, current).first()["win"] == "current"
    assert stack_windows(train, current).where("win = 'current'").first()["y"] is None
