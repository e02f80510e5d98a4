import math

import numpy as np
import pytest
from brute import ks_and_wasserstein, psi
from pyspark.sql import functions as F

from scorewatch.config import Thresholds
from scorewatch.operators import drift, rank


def frame(spark, columns, groups=None):
    """columns: {name: (train values, current values)}; None marks a missing cell."""
    names = list(columns)
    rows = []
    for w, side in ((0, "train"), (1, "current")):
        n = max(len(columns[c][w]) for c in names)
        for i in range(n):
            cells = [columns[c][w][i] if i < len(columns[c][w]) else None for c in names]
            rows.append((side, groups[w][i] if groups else 0, *[None if v is None else float(v) for v in cells]))
    schema = "win string, g int, " + ", ".join(f"`{c}` double" for c in names)
    return spark.createDataFrame(rows, schema)


def by_feature(df):
    return {r["feature"]: r for r in df.collect()}


@pytest.fixture(scope="module")
def samples():
    rng = np.random.default_rng(7)
    return {
        "smooth": (rng.normal(0, 1, 400), rng.normal(0.4, 1.2, 300)),
        "ties": (rng.integers(0, 6, 400), rng.integers(1, 8, 300)),
        "two": (rng.integers(0, 2, 400), rng.integers(0, 2, 300)),
        "heavy": (np.where(rng.random(400) < 0.6, 3.0, rng.random(400)), np.where(rng.random(300) < 0.3, 3.0, rng.random(300))),
        "negative": (-rng.exponential(1, 400), -rng.exponential(2, 300)),
    }


@pytest.mark.parametrize("rows_per_bucket", [10**6, 37, 1])
def test_distances_match_brute_force_for_any_bucketing(spark, samples, rows_per_bucket):
    df = frame(spark, samples)
    found = by_feature(drift.distances(df, list(samples), rows_per_bucket=rows_per_bucket))
    for name, (t, c) in samples.items():
        ks, w1 = ks_and_wasserstein(np.asarray(t, float), np.asarray(c, float))
        assert found[name]["psi"] == pytest.approx(psi(t, c), rel=1e-9)
        assert found[name]["ks_statistic"] == pytest.approx(ks, rel=1e-12)
        assert found[name]["wasserstein_distance"] == pytest.approx(w1, rel=1e-9)
        assert (found[name]["n_train"], found[name]["n_current"]) == (400, 300)


def test_groups_equal_single_runs(spark, samples):
    rng = np.random.default_rng(3)
    groups = (list(rng.integers(0, 3, 400)), list(rng.integers(0, 3, 300)))
    df = frame(spark, samples, [[int(x) for x in g] for g in groups]).repartition(5)
    together = {(r["g"], r["feature"]): r for r in drift.distances(df, list(samples), ["g"], rows_per_bucket=40).collect()}
    for g in range(3):
        alone = by_feature(drift.distances(df.where(f"g = {g}"), list(samples)))
        for name, r in alone.items():
            for c in ("psi", "ks_statistic", "wasserstein_distance"):
                assert together[(g, name)][c] == pytest.approx(r[c], rel=1e-9)


def test_null_groups_are_kept(spark):
    df = spark.createDataFrame(
        [("train", None, 1.0), ("train", None, 2.0), ("current", None, 3.0), ("current", None, 4.0)], "win string, g int, x double"
    )
    for size in (10**6, 1):
        r = drift.distances(df, ["x"], ["g"], rows_per_bucket=size).collect()
        assert len(r) == 1 and r[0]["g"] is None and r[0]["ks_statistic"] == 1.0


def test_edge_features(spark):
    df = frame(
        spark,
        {
            "empty_current": ([1, 2, 3], [None, None]),
            "all_missing": ([None] * 3, [None] * 2),
            "same_constant": ([5, 5, 5], [5, 5]),
            "other_constant": ([5, 5, 5], [6, 6]),
            "constant_then_spread": ([5, 5, 5], [1, 9]),
        },
    )
    report = by_feature(drift.feature_drift_report(df, [c for c in df.columns if c not in ("win", "g")]))
    assert len(report) == 5
    for name in ("empty_current", "all_missing", "same_constant"):
        assert (report[name]["psi"], report[name]["ks_statistic"], report[name]["ks_pvalue"]) == (0.0, 0.0, 1.0)
    assert (report["other_constant"]["psi"], report["other_constant"]["ks_statistic"]) == (1.0, 1.0)
    assert report["other_constant"]["ks_pvalue"] == 0.0 and report["other_constant"]["drift_level"] == "High"
    assert report["constant_then_spread"]["psi"] == pytest.approx(psi([5, 5, 5], [1, 9]))
    assert report["all_missing"]["train_mean"] is None and report["all_missing"]["mean_change_pct"] == 0.0
    assert report["empty_current"]["missing_rate_change_pct_points"] == 100.0


def test_nan_text_and_infinity(spark):
    rows = [("train", "1"), ("train", "2"), ("train", "oops"), ("train", "NaN"), ("current", "Infinity"), ("current", "2")]
    df = spark.createDataFrame(rows, "win string, x string")
    r = drift.feature_profile(df, ["x"]).first()
    assert r["train_missing_rate"] == 0.5 and r["current_missing_rate"] == 0.0 and math.isinf(r["current_mean"])
    d = drift.distances(df, ["x"]).first()
    assert (d["n_train"], d["n_current"]) == (2, 1)


def test_thresholds_flip_levels(spark):
    row = spark.createDataFrame([(0.20, 1.0)], "psi double, p double")

    def level(t):
        return row.selectExpr(drift.drift_level("psi", "p", t), drift.drift_reason("psi", "p", t)).first()

    strict = Thresholds(psi_medium=0.3, psi_high=0.5, ks_pvalue_high=0.0, ks_pvalue_medium=0.0)
    sensitive = Thresholds(psi_medium=0.05, psi_high=0.1)
    assert level(strict)[0] == "Low"
    assert tuple(level(sensitive)) == ("High", "High because PSI 0.2000 is at or above configured high threshold 0.1000.")
    assert level(Thresholds())[0] == "Medium"
    p = spark.createDataFrame([(0.0, 0.00756811)], "psi double, p double")
    text = p.selectExpr(drift.drift_reason("psi", "p", Thresholds())).first()[0]
    assert text == "High because KS p-value 0.007568 is below configured high threshold 0.01."
    tiny = spark.createDataFrame([(0.0, 1.88192e-6)], "psi double, p double")
    assert "1.882e-06" in tiny.selectExpr(drift.drift_reason("psi", "p", Thresholds())).first()[0]


def test_mean_change_rules(spark):
    df = frame(spark, {"zero_up": ([0, 0], [2, 2]), "zero_down": ([0, 0], [-1, -1]), "zero": ([0], [0]), "neg": ([-2, -2], [-1, -1])})
    got = {r["feature"]: r["mean_change_pct"] for r in drift.feature_profile(df, ["zero_up", "zero_down", "zero", "neg"]).collect()}
    assert got == {"zero_up": 100.0, "zero_down": -100.0, "zero": 0.0, "neg": 50.0}


def test_prediction_summary_without_reference_or_column(spark):
    current = spark.createDataFrame([("current", 0.2, 1, 0), ("current", 0.8, 1, 1)], "win string, score double, predicted_label int, actual_label int")
    r = drift.prediction_drift_summary(current).first()
    assert r["prediction_drift_level"] == "Unknown" and not r["reference_available"] and r["recommended_action"] is None
    assert r["current_score_p50"] == pytest.approx(0.5) and r["prediction_actual_rate_gap"] == 0.5
    missing = drift.prediction_drift_summary(current.drop("score")).first()
    assert missing["available"] is False and missing["prediction_drift_level"] == "Unknown"


def test_score_quantiles_and_histogram(spark):
    rng = np.random.default_rng(1)
    t, c = rng.random(101), rng.random(57)
    df = frame(spark, {"score": (t, c)})
    r = drift.prediction_drift_summary(df, rows_per_bucket=9).first()
    for q in (10, 50, 90):
        assert r[f"reference_score_p{q}"] == pytest.approx(np.quantile(t, q / 100))
        assert r[f"current_score_p{q}"] == pytest.approx(np.quantile(c, q / 100))
    assert r["reference_score_std"] == pytest.approx(np.std(t, ddof=1))
    shares = drift.score_histogram(df).groupBy("win").sum("share").collect()
    assert all(s[1] == pytest.approx(1.0) for s in shares)


def test_quantiles_any_bucketing(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=500), 1)
    rows = spark.createDataFrame([("k", float(v)) for v in x], "k string, value double")
    for size in (10**6, 50, 3):
        spread = rank.measure(rows, ["k"], "value", size)
        assert (spread.borders is None) == (size > 500)
        r = rank.exact_quantiles(rows, ["k"], "value", {"a": (1, 4), "b": (1, 2), "c": (9, 10)}, spread).first()
        assert [r["a"], r["b"], r["c"]] == pytest.approx(list(np.quantile(x, [0.25, 0.5, 0.9])))


def test_every_hot_key_is_cut(spark):
    """Forty groups with fifty features each, all over the bucket size: every key has borders, and no bucket is large."""
    features = [f"f{i}" for i in range(50)]
    wide = ", ".join(f"double(pmod(xxhash64(id, {i}), 997)) AS f{i}" for i in range(50))
    df = spark.range(40 * 300).selectExpr("id % 40 AS g", wide.split(", double")[0], *["double" + w for w in wide.split(", double")[1:]])
    values = drift.long_values(df, features, ["g"])
    for limit in (rank.BROADCAST_ROWS, 100):  # borders broadcast, and joined by key
        spread = rank.measure(values, ["g", "feature"], "value", 40, df, ["g"], 50)
        spread = rank.Spread(limit > 100 and spread.few_keys, spread.borders, limit > 100 and spread.few_buckets)
        assert spread.borders.count() == 40 * 50
        sizes = rank.with_bucket(values, ["g", "feature"], "value", spread).groupBy("g", "feature", "bucket").count()
        assert sizes.agg({"count": "max"}).first()[0] < 150 and sizes.count() > 40 * 50 * 5
        got = rank.exact_quantiles(values, ["g", "feature"], "value", {"m": (1, 2)}, spread)
        want = values.groupBy("g", "feature").agg(F.expr("percentile(value, 0.5) AS want"))
        assert got.join(want, ["g", "feature"]).where("abs(m - want) > 1e-9").count() == 0 and got.count() == 2000


def test_border_search_is_exact(spark):
    """Arrays of every size up to seventy against a count of the borders at or below the value."""
    rows = [(n, float(v), [float(2 * i) for i in range(n)]) for n in range(1, 71) for v in (-1, 0, 1, n, 2 * n - 2, 2 * n - 1, 2 * n)]
    df = spark.createDataFrame(rows, "k int, value double, cuts array<double>")
    steps = "transform(sequence(int(length(bin(size(cuts))) - 1), 0, -1), e -> shiftleft(1, e)) AS steps"
    borders = df.select("k", "cuts").distinct().selectExpr("*", steps)
    got = rank.with_bucket(df.select("k", "value"), ["k"], "value", rank.Spread(True, borders)).collect()
    assert all(r["bucket"] == sum(2 * i <= r["value"] for i in range(r["k"])) for r in got) and len(got) == len(rows)
