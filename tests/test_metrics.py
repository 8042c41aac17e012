import datetime as dt
import math

import pytest

from forecourt.operators.decisions import check_prediction_sanity, check_thresholds, combine, Thresholds
from forecourt.plans.training import decide_on_scores
from forecourt.operators.regression import monitor_metrics, prediction_sanity, regression_metrics, sliced_profile


def pairs(spark, rows):
    return spark.createDataFrame(rows, "price double, predicted_price double")


def metrics(spark, rows):
    return regression_metrics(pairs(spark, rows)).first()


def test_values(spark):
    m = metrics(spark, [(100.0, 110.0), (200.0, 180.0)])
    assert (m.mae, m.rmse, m.mape) == (15, pytest.approx(math.sqrt(250)), pytest.approx(0.1))
    assert m.r2 == pytest.approx(1 - 500 / 5000)


def test_zero_truth_is_left_out_of_mape(spark):
    m = metrics(spark, [(0.0, 10.0), (100.0, 90.0)])
    assert (m.mape, m.mae) == (pytest.approx(0.1), 10)


def test_r2_of_constant_and_single_rows(spark):
    assert metrics(spark, [(5.0, 5.0), (5.0, 5.0)]).r2 == 1
    assert metrics(spark, [(5.0, 5.0), (5.0, 6.0)]).r2 == 0
    assert math.isnan(metrics(spark, [(5.0, 5.0)]).r2)
    assert metrics(spark, [(1.0, 2.0), (2.0, 4.0), (3.0, 6.0)]).r2 == pytest.approx(-6.0)


def test_empty_input_fails(spark):
    with pytest.raises(Exception, match="empty input"):
        regression_metrics(pairs(spark, [])).collect()
    with pytest.raises(Exception, match="empty input"):
        regression_metrics(pairs(spark, [(None, 1.0)])).collect()


@pytest.mark.parametrize("bad", [None, float("nan"), float("inf")])
def test_a_labelled_row_without_a_prediction_spoils_the_metrics(spark, bad):
    rows = [(80.0, 90.0), (60.0, 55.0), (70.0, bad), (None, 1.0)]
    m = metrics(spark, rows)
    assert m.n_rows == 3 and all(math.isnan(m[c]) for c in ("mae", "rmse", "mape", "r2"))
    assert math.isnan(monitor_metrics(pairs(spark, rows)).first().mae)
    versions = spark.createDataFrame(
        [("1", *r) for r in [(80.0, 95.0), (60.0, 40.0)]] + [("2", *r) for r in rows],
        "model_version string, price double, predicted_price double",
    )
    decided = decide_on_scores(versions, "2", "1").first()
    assert not decided.promote and decided.reason == "1 predictions missing or not finite"
    assert not decide_on_scores(versions, "2").first().promote
    assert decide_on_scores(versions, "1", "2").first().promote is False  # the champion's value is unknown


def test_one_pass_over_all_versions(spark):
    df = spark.createDataFrame(
        [("1", 100.0, 110.0), ("2", 100.0, 101.0)], "model_version string, price double, predicted_price double"
    )
    found = {r.model_version: r.mae for r in regression_metrics(df, by=["model_version"]).collect()}
    assert found == {"1": 10, "2": 1}


def test_monitor_metrics_counts_open_labels(spark):
    df = spark.createDataFrame(
        [("1", 100.0, 110.0), ("1", None, 50.0), ("2", 100.0, 999.0)],
        "model_version string, price double, predicted_price double",
    )
    row = monitor_metrics(df, "1").first()
    assert (row.labeled_rows, row.scored_rows, row.mae) == (1, 2, 10)
    assert monitor_metrics(df, "9").first().mape is None


def test_profile_has_a_row_per_slice(spark):
    at = dt.datetime(2026, 5, 1, 12)
    df = spark.createDataFrame(
        [("1", at, "A", "suv", "west", 100.0, 110.0), ("1", at, "B", "suv", None, 200.0, 190.0)],
        "model_version string, scored_at timestamp, make string, body_type string, region string, "
        "price double, predicted_price double",
    )
    got = {(r.slice_name, r.slice_value): (r.n_rows, r.mae) for r in sliced_profile(df).collect()}
    assert got == {
        ("all", None): (2, 10),
        ("make", "A"): (1, 10),
        ("make", "B"): (1, 10),
        ("body_type", "suv"): (2, 10),
        ("region", "west"): (1, 10),
        ("region", None): (1, 10),
    }


def sanity(spark, values):
    return check_prediction_sanity(
        prediction_sanity(spark.createDataFrame([(v,) for v in values], "predicted_price double"))
    ).first()


def test_prediction_sanity(spark):
    assert sanity(spark, [1.0, 2.0]).sanity_failures == []
    assert sanity(spark, []).sanity_failures == ["nothing was scored"]
    assert sanity(spark, [1.0, float("inf"), float("nan")]).sanity_failures == ["2 predictions missing or not finite"]
    assert sanity(spark, [1.0, -3.0]).sanity_failures == ["1 predictions at or below zero"]


def checked(spark, mape, mae, r2, thresholds=Thresholds()):
    df = spark.createDataFrame([(mape, mae, r2)], "mape double, mae double, r2 double")
    return combine(check_thresholds(df, thresholds), "threshold_failures").first()


def test_thresholds(spark):
    limits = Thresholds(max_mape=0.1, max_mae=1000, min_r2=0.9)
    assert checked(spark, 0.05, 500.0, 0.95, limits).passed
    row = checked(spark, 0.2, 500.0, 0.5, limits)
    assert not row.passed and row.failures == ["mape 0.2000 > 0.1", "r2 0.5000 < 0.9"]
    assert row.failure_text == "mape 0.2000 > 0.1; r2 0.5000 < 0.9"


def test_unknown_metrics_fail(spark):
    assert not checked(spark, float("nan"), 1.0, 1.0).passed
    assert not checked(spark, 0.1, 1.0, float("nan")).passed
    assert not checked(spark, None, 1.0, 1.0).passed
