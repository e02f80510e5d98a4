import json

import pytest

from scorewatch.config import Thresholds, config_rows, read_thresholds, thresholds_from
from scorewatch.operators import feedback, risk, runs
from scorewatch.operators.evidence import same_run
from scorewatch.plans.review import Review
from scorewatch.sources import readers, sinks

COUNTS = "high_issues long, medium_issues long, high_drift long, medium_drift long, material_missing long, prediction_drift_level string, cluster_shift double"


@pytest.mark.parametrize(
    "row,level,reason,rules",
    [
        ((1, 0, 0, 0, 0, "Low", 0.0), "High", "1 high-severity data-quality issue(s) detected.", 1),
        ((0, 3, 2, 0, 0, "High", 12.0), "High", "2 high-drift feature(s) detected.", 3),
        ((0, 0, 0, 0, 0, "Low", 10.0), "High", "Max cluster shift 10.00 pp crossed high threshold 10.00 pp.", 1),
        ((0, 2, 1, 2, 0, "Medium", 6.0), "Medium", "2 medium-severity data-quality issue(s) detected.", 5),
        ((0, 0, 1, 1, 0, "Low", 0.0), "Medium", "One high-drift feature detected.", 1),
        ((0, 0, 0, 1, 0, "Unknown", 4.9), "Low", "No configured High or Medium risk rules fired.", 0),
    ],
)
def test_run_decision(spark, row, level, reason, rules):
    r = risk.run_risk_decision(spark.createDataFrame([row], COUNTS)).first()
    assert (r["overall_risk_level"], r["primary_reason"], len(r["triggered_rules"])) == (level, reason, rules)


def test_recommended_checks_order(spark):
    full = risk.recommended_checks(spark.createDataFrame([(1, 0, 0, 0, 2, "High", 0.0)], COUNTS)).orderBy("check_no").collect()
    assert full[0]["recommended_check"] == risk.RESOLVE_FIRST and len(full) == 6
    assert [r["recommended_check"] for r in full[-2:]] == [risk.CHECK_MISSING, risk.CHECK_SCORES]
    plain = risk.recommended_checks(spark.createDataFrame([(0, 0, 0, 0, 0, "Low", 0.0)], COUNTS))
    assert plain.count() == 3


@pytest.fixture(scope="module")
def reports(spark):
    importance = spark.createDataFrame([(f"f{i}", 1.0 / i, i) for i in range(1, 12)], "feature string, mean_abs_shap double, shap_rank int")
    drift = spark.createDataFrame(
        [("f1", 0.5, 0.0, 1.0, "High"), ("f2", 0.15, 0.2, 1.0, "Medium"), ("f7", 0.4, 0.0, 1.0, "High"), ("f11", 0.2, 0.2, 1.0, "Medium")],
        "feature string, psi double, ks_pvalue double, wasserstein_distance double, drift_level string",
    )
    vif = spark.createDataFrame([("f3", 40.0, "High"), ("f8", float("inf"), "High")], "feature string, vif double, vif_risk string")
    return importance, drift, vif


def test_matrix_rules(spark, reports):
    metadata = readers.feature_metadata(spark, [{"name": "f1", "business_definition": "first", "feature_group": "g"}, {"type": "numeric"}])
    matrix = risk.feature_risk_matrix(*reports, metadata=metadata).collect()
    got = {r["feature"]: r for r in matrix}
    assert [r["feature"] for r in matrix[:4]] == ["f1", "f3", "f2", "f7"]
    assert [got[f]["final_risk"] for f in ("f1", "f3", "f2", "f7", "f11", "f8")] == ["High", "High", "Medium", "Medium", "Low", "Low"]
    assert got["f1"]["business_definition"] == "first" and got["f2"]["feature_group"] == "model_feature"
    assert (got["f4"]["psi"], got["f4"]["ks_pvalue"], got["f4"]["vif"], got["f4"]["vif_risk"]) == (0.0, 1.0, 1.0, "Low")


def test_scatter_defaults(spark, reports):
    importance, drift, vif = reports
    got = {r["feature"]: r for r in risk.risk_scatter_frame(importance, None, drift, vif).collect()}
    assert got["f3"]["marker_size"] == 31.0 and got["f8"]["marker_size"] == 7.0 and got["f4"]["marker_size"] == 7.0
    assert got["f1"]["final_risk"] == "Unknown" and got["f1"]["psi"] == 0.5


def test_findings_actions_health(spark, reports):
    matrix = risk.feature_risk_matrix(*reports)
    score = spark.createDataFrame([("High",)], "prediction_drift_level string")
    over = runs.overfitting_delta(spark.createDataFrame([(0.9, 0.8)], "train_auc double, validation_auc double"))
    found = [r["finding"] for r in risk.key_findings(reports[1], matrix, score, reports[2], over).orderBy("finding_no").collect()]
    assert found == [
        "f1 is high drift and appears in the feature risk matrix.",
        "f7 is high drift and appears in the feature risk matrix.",
        "f1 is a high-risk feature because it is model-important and has high drift.",
        "f3 is a high-risk feature because it is model-important and has low drift.",
        "Prediction drift is High based on score distribution shift and KS p-value.",
        "VIF risk is High for f8.",
        "VIF risk is High for f3.",
        "Train-validation AUC delta indicates high overfitting risk.",
    ]
    counts = spark.createDataFrame([(0, 1, 2, 2, 0, "High", 0.0)], COUNTS)
    actions = [r["action"] for r in risk.recommended_actions(counts, matrix, reports[2]).orderBy("action_no").collect()]
    assert actions[:4] == [risk.STABILITY, risk.VALIDATE, risk.PIPELINES, risk.REDUNDANCY]
    assert actions[-1] == risk.REDUNDANCY_RECHECK and len(actions) == len(set(actions)) == 9
    calm = spark.createDataFrame([("Low",)], "overall_risk_level string")
    assert risk.model_health_status(calm, matrix).first()[0] == "High Risk"
    assert risk.model_health_status(calm, matrix.where("final_risk <> 'High'")).first()[0] == "Medium Risk"
    assert risk.model_health_status(calm, matrix.where("final_risk = 'Low'")).first()[0] == "Low Risk"
    assert risk.top_drivers(reports[0]).count() == 5
    assert "f1: High because" in risk.high_risk_lines(matrix).orderBy("feature").first()["line"]


# ---------------------------------------------------------------- feedback


def events(spark, rows):
    return feedback.with_contract(
        spark.createDataFrame(rows, "run_id string, user_role string, finding_id string, feature string, feedback_type string, related_agent string")
    )


def test_feedback_intake(spark):
    new = spark.createDataFrame(
        [("r1", " false_alarm ", None), ("r1", "nonsense", "x"), (None, "helpful", " ok ")], "run_id string, feedback_type string, comment string"
    )
    accepted, rejected = feedback.validate_events(new)
    rows = {r["feedback_type"]: r for r in accepted.collect()}
    assert set(rows) == {"false_alarm", "helpful"} and accepted.columns == list(feedback.COLUMNS)
    assert rows["helpful"]["run_id"] == "unknown" and rows["helpful"]["comment"] == "ok" and rows["helpful"]["severity"] == "Not Set"
    assert rejected.first()["reject_reason"] == "Unsupported feedback_type `nonsense`."
    old = feedback.legacy_feedback(spark.createDataFrame([("drift", "false positive", "c"), ("drift", "too_vague", "c")], "agent string, signal string, comment string"))
    assert {r["feedback_type"] for r in old.collect()} == {"false_alarm", "too_vague"}


def test_patterns_recommendations_and_proposal(spark):
    log = events(
        spark,
        [
            ("r", "model_analyst", "F1", "fuel", "false_alarm", "drift"),
            ("r", "model_analyst", "F1", "fuel", "false_alarm", "drift"),
            ("r", "model_analyst", "F1", "", "false_alarm", "drift"),
            ("r", "model_analyst", "F1", "", "false_alarm", "drift"),
            ("r", "model_analyst", "F2", "spend", "false_alarm", "drift"),
            ("r", "model_analyst", "F2", "spend", "false_alarm", "drift"),
            ("r", "executive", "F3", "", "too_technical", "summary"),
            ("r", "client", "F3", "", "too_technical", "summary"),
            ("r", "data_scientist", "F3", "", "rejected_recommendation", "summary"),
        ],
    )
    patterns = feedback.feedback_patterns(log)
    assert {(r["pattern"], r["item"], r["events"]) for r in patterns.collect()} == {
        ("repeated_false_alarm", "fuel", 2),
        ("repeated_false_alarm", "spend", 2),
        ("executive_too_technical", "", 2),
    }
    recs = feedback.calibration_recommendations(patterns, current_lists={feedback.SEASONAL: ["fuel", "gas"]})
    rows = {r["recommendation_id"]: r for r in recs.collect()}
    assert rows["REC_001"]["recommended_value"] == '["fuel","gas"]' and rows["REC_002"]["recommended_value"] == '["fuel","gas","spend"]'
    assert rows["REC_003"]["change_type"] == "report_profile_adjustment"
    active = config_rows(spark, Thresholds())
    proposal = {r["path"]: r for r in feedback.proposed_config(active, recs).collect()}
    assert proposal[feedback.SEASONAL]["value"] == '["fuel","gas","spend"]' and proposal[feedback.SEASONAL]["changed"]
    assert proposal["drift.psi_high"]["value"] == "0.25" and proposal["approval_status"]["value"] == "pending_human_review"
    assert proposal["based_on"]["value"] == "v1" and active.where("path = 'drift.psi_high'").first()["value"] == "0.25"
    logged = feedback.change_log(recs).first()
    assert logged["status"] == "recommended" and logged["decided_at"] is None
    summary = {(r["summary"], r["item"]): r["events"] for r in feedback.feedback_summary(log).collect()}
    assert summary[("total", "")] == 9 and summary[("by_feature", "fuel")] == 2 and ("by_feature", "") not in summary
    assert summary[("by_role", "executive")] == 1 and summary[("by_agent", "drift")] == 6


def test_silent_high_risk_reviews(spark):
    none = events(spark, []).where("false")
    empty = feedback.feedback_patterns(none)
    high = spark.createDataFrame([("High Risk",)], "model_health_status string")
    low = spark.createDataFrame([("Low Risk",)], "model_health_status string")
    recs = feedback.calibration_recommendations(empty, health=high, feedback=none)
    assert [r["change_type"] for r in recs.collect()] == ["human_review"]
    assert feedback.calibration_recommendations(empty, health=low, feedback=none).count() == 0
    unchanged = {r["path"]: r["value"] for r in feedback.proposed_config(config_rows(spark, Thresholds()), recs.where("false")).collect()}
    assert unchanged["approval_status"] == "no_changes_recommended"
    fleet = spark.createDataFrame([("a", "High Risk"), ("b", "High Risk"), ("c", "Low Risk")], "run_id string, model_health_status string")
    some = events(spark, [("a", "x", "", "", "helpful", "drift")])
    recs = feedback.calibration_recommendations(feedback.feedback_patterns(some, ["run_id"]), ["run_id"], health=fleet, feedback=some)
    assert [(r["run_id"], r["change_type"]) for r in recs.collect()] == [("b", "human_review")]


# ---------------------------------------------------------------- config, readers, sinks


def test_thresholds_file(spark, tmp_path):
    path = tmp_path / "thresholds.json"
    path.write_text(json.dumps({"config_version": "v7", "checks": {"psi_high": 0.4}, "diagnostics": {"vif_high": 8, "vif_thresholds": {"high": 9}}}))
    t = read_thresholds(spark, str(path), {"checks": "drift"})
    assert (t.config_version, t.psi_high, t.vif_high, t.psi_medium) == ("v7", 0.4, 9.0, 0.10)
    assert read_thresholds(spark, str(tmp_path / "none.json")).config_version == "fallback_defaults"
    assert thresholds_from({}) == Thresholds()


def test_readers(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"target": "y", "feature_columns": ["a"]}')
    assert readers.read_object(spark, str(tmp_path / "m.json"))["target"] == "y"
    with pytest.raises(FileNotFoundError) as error:
        readers.require_paths(spark, [str(tmp_path / "x"), str(tmp_path / "m.json"), str(tmp_path / "z")])
    assert "x" in str(error.value) and "z" in str(error.value) and "m.json" not in str(error.value)
    assert readers.read_reference(spark, str(tmp_path / "x")) is None
    (tmp_path / "t.csv").write_text("id,v\na,1\nb,\n")
    assert readers.read_table(spark, str(tmp_path / "t.csv"), "id string, v double").count() == 2
    assert readers.declared_bounds([{"name": "a", "expected_min": 0}]) == {"a": (0, None)}


def test_run_partitions(spark, tmp_path):
    path = str(tmp_path / "report")
    df = spark.createDataFrame([("f", 1.0)], "feature string, psi double")
    sinks.write_report(df, path, "r1")
    sinks.write_report(df, path, "r2")
    sinks.write_report(df.selectExpr("feature", "2.0D AS psi"), path, "r2", replace=True)
    assert {(r["run_id"], r["psi"]) for r in spark.read.parquet(path).collect()} == {("r1", 1.0), ("r2", 2.0)}
    store = str(tmp_path / "evidence")
    sinks.upsert_section(df, store, "r1", "drift")
    sinks.upsert_section(df, store, "r1", "vif")
    sinks.upsert_section(df.selectExpr("feature", "3.0D AS psi"), store, "r1", "drift")
    rows = {r["section"]: r["payload"] for r in spark.read.parquet(store).collect()}
    assert json.loads(rows["drift"])["psi"] == 3.0 and json.loads(rows["vif"])["psi"] == 1.0
    packet = spark.createDataFrame([("r1",)], "run_id string")
    visuals = spark.createDataFrame([("r1", "a"), ("r9", "b")], "run_id string, name string")
    assert [r["name"] for r in same_run(packet, visuals).collect()] == ["a"]


def test_whole_review_is_saved(spark, tmp_path):
    rows = [(i, "train" if i < 60 else "current", float(i % 7), float(i % 5) + (i >= 60), int(i % 7 > 3)) for i in range(120)]
    f = spark.createDataFrame(rows, "entity_id int, win string, a double, b double, label int")
    p = f.selectExpr("entity_id", "win", "(a + b) / 12 AS score", "int(a > 3) AS predicted_label", "label AS actual_label")
    importance = spark.createDataFrame([("a", 0.5, 1), ("b", 0.1, 2)], "feature string, mean_abs_shap double, shap_rank int")
    review = Review(f, p, ["a", "b"], importance=importance, model_runs=spark.createDataFrame([(0.9, 0.85)], "train_auc double, validation_auc double"))
    review.save(str(tmp_path), "run_1")
    review.save(str(tmp_path), "run_1")
    packet = spark.read.json(str(tmp_path / "evidence_packet"))
    assert packet.count() == 1
    r = packet.first()
    assert r["overall_risk_level"] == "High" and len(r["feature_drift"]) == 2 and len(r["cluster_shift"]) == 3
    assert len(r["lift"]) == 10 and r["run_id"] == "run_1"
    assert spark.read.parquet(str(tmp_path / "feature_risk_matrix")).count() == 2
    skip = Review(f, p, ["a", "b"], importance=importance, thresholds=Thresholds(drift_gate_mode="skip", severe_psi=0.0))
    assert skip.importance.count() == 0 and skip.vif.count() == 0 and skip.segment_features == ["a", "b"]


def test_config_documents(spark):
    """Nested files to active thresholds: two spellings, nulls, lists, an empty and a missing file."""
    from scorewatch.config import config_documents

    docs = spark.createDataFrame(
        [
            ("a", '{"config_version": "v9", "drift": {"psi_high": 0.3, "known_seasonal_features": ["x"]}, "diagnostics": '
             '{"vif_high": 11, "vif_thresholds": {"high": 12}, "segment_performance_thresholds": {"minimum_segment_count": 5}}}'),
            ("b", '{"drift": {"psi_high": null}}'),
            ("c", None),
            ("d", "{}"),
        ],
        "file string, body string",
    )
    got = {(r["file"], r["field"]): (r["value"], r["given"]) for r in config_documents(docs, "file", "body").collect()}
    fields = {f for _, f in got}
    assert len(got) == 4 * len(fields)
    assert got["a", "psi_high"] == ("0.3", True) and got["a", "vif_high"] == ("12", True) and got["a", "config_version"] == ("v9", True)
    assert got["a", "segment_min_count"] == ("5", True) and got["a", "psi_medium"] == ("0.1", False)
    assert got["b", "psi_high"] == ("0.25", False) and got["b", "config_version"] == ("v1", False)
    assert got["c", "config_version"] == ("fallback_defaults", False) and got["d", "config_version"] == ("v1", False)
