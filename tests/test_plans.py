"""Shape of the physical plans: what scales and what does not."""

import re

import pytest

from scorewatch.operators import calibration, drift, quality
from scorewatch.plans import catalog
from scorewatch.sources import review_views as views

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_distances_stay_in_the_jvm_and_share_the_counts(spark):
    x = drift.distances(views.features(spark, SF), views.FEATURES)
    x.collect()
    text = plan(x)
    assert "ArrowEvalPython" not in text and "MapInPandas" not in text
    assert "ReusedExchange" in text, "distinct values must be aggregated once"
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert not re.search(r"Window.*windowspecdefinition\((value|specifiedwindowframe)", text), "window without keys"


def test_only_needed_columns_are_read(spark):
    text = plan(calibration.calibration_summary(views.predictions(spark, SF).where("win = 'current'")))
    read = " ".join(re.findall(r"ReadSchema: struct<([^>]*)>", text))
    assert "o_orderkey" in read and "o_comment" not in read and "l_extendedprice" not in read


def test_window_filter_reaches_the_scan(spark):
    text = plan(quality.duplicate_entity_rate(views.predictions(spark, SF).where("win = 'train'"), ["entity_id"]))
    assert "o_orderdate" in text and "1998-05-01" in text


@pytest.mark.parametrize("name", ["score_deciles", "segment_performance", "feature_drift_report", "feature_risk_matrix", "run_risk_decision"])
def test_no_cross_joins(spark, name):
    text = plan(catalog.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_partition_count_does_not_matter(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    rows = []
    for n in ("1", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        rows.append(sorted(map(str, catalog.rounded(catalog._drift(spark, SF), *catalog.DRIFT_COLUMNS).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert rows[0] == rows[1]
