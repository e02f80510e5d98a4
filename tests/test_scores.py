import random

import pytest
from brute import deciles

from scorewatch.config import Thresholds
from scorewatch.operators import calibration, lift, runs, segments


def preds(spark, scores, labels, entity=None):
    rows = [(entity[i] if entity else i, None if s is None else float(s), y) for i, (s, y) in enumerate(zip(scores, labels))]
    return spark.createDataFrame(rows, "entity_id long, score double, actual_label int")


def test_calibration_small(spark):
    p = preds(spark, [0.05, 0.15, 0.45, 0.55, 0.85, 0.95], [0, 0, 1, 0, 1, 1])
    bins = calibration.calibration_bins(p, bins=5).collect()
    assert [r["bin"] for r in bins] == [1, 2, 3]
    assert [r["count"] for r in bins] == [2, 2, 2]
    s = calibration.calibration_summary(p, bins=5).first()
    assert s["available"] and s["row_count"] == 6 and s["brier_score"] > 0
    assert s["brier_score"] == pytest.approx(calibration.brier_score(p).first()[0])


def test_calibration_borders_and_cleaning(spark):
    scores = [0.0, 0.1, 0.3, 0.30000000000000004, 1.0, 1.7, -2.0, None, 0.5]
    labels = [0, 0, 0, 0, 1, 1, 0, 1, 2]
    bins = calibration.calibration_bins(preds(spark, scores, labels)).collect()
    # 0, 0.1 and the clipped -2 share the first bin; both spellings of 0.3 end the third; 1 and the clipped 1.7 the last
    assert [r["count"] for r in bins] == [3, 2, 2]
    assert bins[2]["score_max"] == 1.0


def test_no_label(spark):
    p = spark.createDataFrame([(1, 0.1), (2, 0.2), (3, 0.3)], "entity_id long, score double")
    s = calibration.calibration_summary(p).first()
    assert s["available"] is False and s["row_count"] == 0
    assert lift.lift_report(p) is None
    none_left = calibration.calibration_summary(preds(spark, [0.1], [7])).first()
    assert none_left["available"] is False and none_left["expected_calibration_error"] is None


def test_lift_small(spark):
    p = preds(spark, [0.95, 0.90, 0.80, 0.70, 0.40, 0.30, 0.20, 0.10], [1, 1, 1, 0, 0, 0, 0, 0])
    table = lift.lift_report(p, deciles=4)
    rows = sorted(table.collect(), key=lambda r: r["decile"])
    assert [r["count"] for r in rows] == [2, 2, 2, 2] and rows[0]["lift"] > 1
    assert rows[0]["cumulative_capture_rate"] == pytest.approx(2 / 3) and rows[3]["cumulative_lift"] == pytest.approx(1.0)
    s = lift.lift_summary(table).first()
    assert s["baseline_rate"] == pytest.approx(3 / 8) and s["top_decile_lift"] == pytest.approx(8 / 3)


@pytest.mark.parametrize("n,levels", [(7, 100), (25, 3), (103, 7), (60, 1)])
@pytest.mark.parametrize("rows_per_bucket", [10**6, 4])
def test_deciles_with_ties(spark, n, levels, rows_per_bucket):
    rng = random.Random(n)
    rows = [(rng.randrange(levels) / 100, rng.randrange(max(2, n // 2)), rng.randrange(2)) for _ in range(n)]
    p = preds(spark, [r[0] for r in rows], [r[2] for r in rows], [r[1] for r in rows])
    got = lift.score_deciles(p, rows_per_bucket=rows_per_bucket).collect()
    assert {r["decile"]: (r["count"], r["positives"]) for r in got} == deciles(rows)


def test_deciles_no_positives_and_string_ids(spark):
    p = spark.createDataFrame([(f"id{i:03d}", 0.5, 0) for i in range(30)], "entity_id string, score double, actual_label int")
    table = lift.lift_table(lift.score_deciles(p, rows_per_bucket=5)).collect()
    assert len(table) == 10 and all(r["count"] == 3 for r in table)
    assert all(r["lift"] is None and r["cumulative_capture_rate"] is None for r in table)


def seg8(spark):
    f = spark.createDataFrame([(c, float(i + 1)) for i, c in enumerate("abcdefgh")], "entity_id string, x double")
    scores = [0.95, 0.90, 0.85, 0.80, 0.20, 0.15, 0.10, 0.05]
    p = spark.createDataFrame(
        [(c, s, int(i >= 4)) for i, (c, s) in enumerate(zip("abcdefgh", scores))], "entity_id string, score double, actual_label int"
    )
    return segments.scored_features(f, p, ["x"], "entity_id")


def test_segment_thresholds(spark):
    sensitive = Thresholds(segment_min_count=1, segment_gap_medium=0.05, segment_gap_high=0.1)
    tolerant = Thresholds(segment_min_count=1, segment_gap_medium=0.95, segment_gap_high=0.99)
    high = segments.segment_performance(seg8(spark), ["x"], thresholds=sensitive, bins=2).collect()
    assert [r["segment"] for r in high] == ["(0.999, 4.5]", "(4.5, 8.0]"] and high[0]["risk_level"] == "High"
    low = segments.segment_performance(seg8(spark), ["x"], thresholds=tolerant, bins=2)
    assert {r["risk_level"] for r in low.collect()} == {"Low"}
    few = segments.segment_performance(seg8(spark), ["x"], bins=2).first()
    assert few["risk_reason"] == "Low confidence because segment count 4 is below minimum 10."
    s = segments.segment_summary(segments.segment_performance(seg8(spark), ["x"], thresholds=sensitive, bins=2)).first()
    assert (s["features_evaluated"], s["high_risk_segments"]) == (1, 2)


def test_segment_labels(spark):
    rows = [(i, float(i % 2), None if i % 5 == 0 else 0.01 * i, None, 1.0e8 + i, 0.5, i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "entity_id int, flag double, small double, gone double, big double, score double, label int")
    for size in (10**6, 3):
        report = segments.segment_performance(df, ["flag", "small", "gone", "big"], rows_per_bucket=size).collect()
        names = {f: {r["segment"] for r in report if r["feature"] == f} for f in ("flag", "small", "gone", "big")}
        assert names["flag"] == {"value=0", "value=1"} and names["gone"] == {"missing"}
        assert "nan" in names["small"] and len(names["small"]) == 5
        assert "(99999999.999, 100000009.75]" in names["big"]
        assert sum(r["count_share"] for r in report if r["feature"] == "small") == pytest.approx(1.0)


def test_heatmap_shape(spark):
    report = segments.segment_performance(seg8(spark), ["x"], bins=2)
    h = segments.segment_heatmap(report, bins=2)
    assert h.columns == ["feature", "S1", "S2", "S3"]
    r = h.first()
    assert r["S1"] >= r["S2"] > 0 and r["S3"] == 0.0


def test_join_needs_a_key(spark):
    f = spark.createDataFrame([(1, 2.0)], "row_no int, x double")
    p = spark.createDataFrame([(1, 0.5, 1)], "row_no int, score double, actual_label int")
    with pytest.raises(ValueError):
        segments.scored_features(f, p, ["x"], "entity_id")
    assert segments.scored_features(f, p, ["x"], "entity_id", position="row_no").count() == 1


def test_overfitting(spark):
    r = spark.createDataFrame([("a", 0.82, 0.77), ("b", 0.9, None)], "run_id string, train_auc double, validation_auc double")

    def level(**kw):
        return {x["run_id"]: x for x in runs.overfitting_delta(r, Thresholds(**kw)).collect()}

    assert level(overfit_medium=0.08, overfit_high=0.12)["a"]["risk_level"] == "Low"
    assert level(overfit_medium=0.01, overfit_high=0.04)["a"]["risk_level"] == "High"
    assert level()["b"]["risk_level"] == "Not Available"
    assert runs.overfitting_delta(r.drop("validation_auc")).first()["risk_level"] == "Not Available"
