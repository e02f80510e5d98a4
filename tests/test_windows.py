"""Frames whose windows differ: columns, labels, empty windows, values beyond integers, reviews without feedback."""

from scorewatch.config import Thresholds, config_rows
from scorewatch.operators import drift, feedback, quality, segments
from scorewatch.operators.selection import stack_windows, window_columns


def frames(spark):
    train = spark.createDataFrame([(1, 1.0, 2.0, 1), (2, 3.0, 4.0, 0)], "id long, x double, y double, target int")
    now = spark.createDataFrame([(5, 1.0), (6, 2.0)], "id long, x double")
    scores = spark.createDataFrame([(5, 0.4), (6, 0.6)], "id long, score double")
    return stack_windows(train, now), stack_windows(None, scores)


def test_columns_of_each_window(spark):
    f, p = frames(spark)
    assert window_columns(f) == {"train": ["id", "x", "y", "target"], "current": ["id", "x"]}
    assert window_columns(p) == {"current": ["id", "score"]}
    report = quality.data_quality_report(f, p, ["x"], "id", "score", "target", declared_features=["x", "y"]).collect()
    required = {r["dataset"]: r for r in report if r["check_type"] == "required_columns_present"}
    assert set(required) == {"train_features", "current_features", "current_predictions"}
    assert required["current_features"]["message"] == "Missing required columns: target, y"
    assert required["current_features"]["issue_level"] == "High" and required["train_features"]["issue_level"] == "Low"
    assert [r["issue_level"] for r in report if r["check_type"] == "label_availability"] == ["Medium"]
    assert not any(r["dataset"] == "train_predictions" for r in report)


def test_empty_window_keeps_its_findings(spark):
    f, p = frames(spark)
    f = f.where("win = 'train'")
    report = quality.data_quality_report(f, p.where("id < 0"), ["x"], "id", "score", "target").collect()
    found = {(r["check_type"], r["dataset"]): r for r in report}
    for key in (
        ("duplicate_entity_rate", "current_features"),
        ("duplicate_entity_rate", "current_predictions"),
        ("prediction_score_out_of_range_rate", "current_predictions"),
    ):
        assert found[key]["current_value"] == 0.0 and found[key]["issue_level"] == "Low"


def test_target_stands_in_for_the_label(spark):
    train = spark.createDataFrame([(0.2, 1), (0.3, 0)], "score double, bought int")
    now = spark.createDataFrame([(0.2, 1), (0.3, 1)], "score double, bought int")
    row = drift.label_mix_shift(stack_windows(train, now), target="bought").first()
    assert (row["reference_actual_positive_rate"], row["current_actual_positive_rate"]) == (0.5, 1.0)
    # only the side without the label falls back
    row = drift.label_mix_shift(stack_windows(train, now.withColumnRenamed("bought", "actual_label")), target="bought").first()
    assert (row["reference_actual_positive_rate"], row["current_actual_positive_rate"]) == (0.5, 1.0)


def test_two_values_beyond_integers(spark):
    rows = [(i, v, 0.5, i % 2) for i, v in enumerate([3e9, 4e9, 3e9, 4e9, 1e300, 1e300])]
    scored = spark.createDataFrame(rows[:4], "id long, x double, score double, label int")
    got = {r["segment"] for r in segments.segment_performance(scored, ["x"]).collect()}
    assert got == {"value=3000000000", "value=4000000000"}
    scored = spark.createDataFrame(rows[1:2] + rows[4:], "id long, x double, score double, label int")
    assert segments.segment_performance(scored, ["x"]).count() == 2


def test_heatmap_keeps_all_segments(spark):
    scored = spark.createDataFrame([(float(i), i / 80, i % 2) for i in range(80)], "x double, score double, label int")
    report = segments.segment_performance(scored, ["x"], bins=8)
    wide = segments.segment_heatmap(report)
    assert [c for c in wide.columns if c != "feature"] == [f"S{i}" for i in range(1, 9)]


def test_human_review_and_proposals(spark):
    health = spark.createDataFrame([("a", "Medium Risk"), ("b", "Medium Risk"), ("c", "High Risk")], "run_id string, model_health_status string")
    matrix = spark.createDataFrame([("a", "High"), ("b", "Low"), ("c", "Low")], "run_id string, final_risk string")
    none = spark.createDataFrame([], "run_id string, pattern string, item string, events long")
    said = spark.createDataFrame([], "run_id string")
    found = feedback.calibration_recommendations(none, ["run_id"], health=health, feedback=said, matrix=matrix)
    assert {r["run_id"] for r in found.collect()} == {"a", "c"}
    reviews = health.select("run_id")
    rows = feedback.proposed_config(config_rows(spark, Thresholds()), found, ["run_id"], reviews).collect()
    status = {r["run_id"]: r["value"] for r in rows if r["path"] == "approval_status"}
    assert status == {"a": "pending_human_review", "b": "no_changes_recommended", "c": "pending_human_review"}
    assert {r["path"] for r in rows} >= {"version", "generated_by", "config_version", "based_on"}
