import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from forecourt.operators.psi import (
    categorical_psi,
    compute_drift,
    drift_summary,
    exact_quantiles,
    frequency,
    number_rows,
    numeric_psi,
    quantile_edges,
)

rng = np.random.default_rng(0)


def frame(spark, **columns):
    names = list(columns)
    types = ["string" if isinstance(columns[c][0], str) else "double" for c in names]
    rows = [tuple(None if v is None else (v if isinstance(v, str) else float(v)) for v in r) for r in zip(*columns.values())]
    return spark.createDataFrame(rows, ", ".join(f"{c} {t}" for c, t in zip(names, types)))


def psi_of(df):
    return {r.feature: r.psi for r in df.collect()}


def brute_numeric_psi(ref, cur, bins=10):
    edges = np.unique(np.quantile(ref, np.linspace(0, 1, bins + 1)))
    r = np.bincount(np.searchsorted(edges[1:-1], ref, side="right"), minlength=len(edges) - 1) / len(ref)
    c = np.bincount(np.searchsorted(edges[1:-1], cur, side="right"), minlength=len(edges) - 1) / len(cur)
    r, c = np.maximum(r, 1e-4), np.maximum(c, 1e-4)
    return float(((c - r) * np.log(c / r)).sum())


def test_stable_and_shifted(spark):
    ref, same, moved = rng.normal(0, 1, 3000), rng.normal(0, 1, 3000), rng.normal(1, 1, 3000)
    got = psi_of(numeric_psi(frame(spark, a=ref, b=ref), frame(spark, a=same, b=moved), ["a", "b"]))
    assert got["a"] < 0.02 and got["b"] > 0.25
    assert got == pytest.approx({"a": brute_numeric_psi(ref, same), "b": brute_numeric_psi(ref, moved)}, abs=1e-12)


SHAPES = {
    "lognormal": np.exp(rng.normal(0, 8, 500)),
    "around zero": rng.normal(0, 1e-9, 500),
    "narrow": 1e6 + rng.random(500) * 1e-3,
    "whole": rng.integers(-5, 5, 500).astype(float),
    "huge": rng.normal(0, 1e300, 500),
    "tiny": rng.random(500) * 1e-310,
    "outlier": np.append(rng.random(499), 1e308),
    "hot": np.append(np.full(400, 7.25), rng.random(100) * 100),
    "two": np.array([1.5, 2.5]),
    "one": np.array([3.0]),
    "crowded": np.append(np.linspace(1.0, 1.0 + 2e-9, 499), 1.0005),
}


def test_quantiles_equal_numpy_exactly(spark):
    rows = [(name, float(v)) for name, values in SHAPES.items() for v in values]
    counts = spark.createDataFrame(rows, "feature string, value double").groupBy("feature", "value").agg(
        F.count("*").alias("n")
    )
    wanted = [i * 0.1 for i in range(10)] + [1.0]
    got = {r.feature: r.quantiles for r in exact_quantiles(counts, wanted).collect()}
    for name, values in SHAPES.items():
        assert got[name] == list(np.quantile(values, np.linspace(0, 1, 11))), name


def test_constant_reference(spark):
    # All of the reference is one value: what counts is the share of the current rows that differ from it.
    ref, half = frame(spark, x=[7.5] * 40), frame(spark, x=[7.5] * 15 + [7.0, 8.0] * 15)
    assert psi_of(numeric_psi(ref, frame(spark, x=[7.5] * 9), ["x"]))["x"] == pytest.approx(0, abs=1e-9)
    share = 2 / 3
    want = (1 - share - 1) * math.log(1 - share) + (share - 1e-4) * math.log(share / 1e-4)
    assert psi_of(numeric_psi(ref, half, ["x"]))["x"] == pytest.approx(want)


def test_two_edges_give_no_drift(spark):
    ref, cur = frame(spark, x=[0.0] * 96 + [5.0] * 4), frame(spark, x=[9.0] * 10)
    counts = number_rows(ref, cur, ["x"])
    assert quantile_edges(counts).first().edges == [0.0, 5.0]
    assert psi_of(numeric_psi(ref, cur, ["x"]))["x"] == 0


def test_an_empty_side_gives_nan(spark):
    some, none = frame(spark, x=[1.0, 2.0]), frame(spark, x=[1.0]).where("false")
    assert math.isnan(psi_of(numeric_psi(none, some, ["x"]))["x"])
    assert math.isnan(psi_of(numeric_psi(some, none, ["x"]))["x"])
    texts = frame(spark, x=["a"])
    assert math.isnan(psi_of(categorical_psi(texts, texts.where("false"), ["x"]))["x"])


def test_unknown_values_do_not_count(spark):
    ref = frame(spark, x=[1.0, 2.0, 3.0, float("nan"), None])
    cur = frame(spark, x=[1.0, float("nan"), 2.0, 3.0, None])
    assert psi_of(numeric_psi(ref, cur, ["x"]))["x"] == pytest.approx(0)


def test_categories(spark):
    ref = frame(spark, c=["red"] * 6 + ["blue"] * 3 + ["gray"])
    assert psi_of(categorical_psi(ref, ref, ["c"]))["c"] == pytest.approx(0)
    swapped = frame(spark, c=["red"] * 3 + ["blue"] * 6 + ["gray"])
    assert psi_of(categorical_psi(ref, swapped, ["c"]))["c"] == pytest.approx(0.6 * math.log(2))
    gone = frame(spark, c=["red"] * 6 + ["blue"] * 3 + ["green"])
    assert psi_of(categorical_psi(ref, gone, ["c"]))["c"] == pytest.approx(2 * (0.1 - 1e-4) * math.log(0.1 / 1e-4))
    shares = {r.value: r["share"] for r in frequency(frame(spark, c=["a", "a", "b", None]), ["c"]).collect()}
    assert shares == pytest.approx({"a": 2 / 3, "b": 1 / 3})


def test_each_column_is_judged_by_itself(spark):
    # Ages rise by half, fuel and miles stay, the guess follows the age: two drifts, of which one is the prediction's.
    age, miles = rng.gamma(3, 2, 700), rng.uniform(0, 9e4, 700)
    fuel = (["petrol"] * 4 + ["electric"] * 3) * 100
    ref = frame(spark, age=age, miles=miles, fuel=fuel, guess=9000 - 400 * age)
    cur = frame(spark, age=age * 1.5 + 2, miles=rng.permutation(miles), fuel=fuel[::-1], guess=9000 - 400 * (age * 1.5 + 2))
    drift = compute_drift(ref, cur, numeric_cols=["miles", "age"], categorical_cols=["fuel"], prediction_col="guess")
    by_name = {r.feature: (r.drifted, r.is_prediction, r.psi) for r in drift.collect()}
    assert {n: v[:2] for n, v in by_name.items()} == {
        "age": (True, False), "miles": (False, False), "fuel": (False, False), "guess": (False, True),
    }
    assert by_name["guess"][2] > 0.25 and by_name["miles"][2] == pytest.approx(0) == by_name["fuel"][2]
    summary = drift_summary(drift).first()
    assert (summary.n_drifted, summary.drifted_features) == (1, ["age"])
    assert summary.prediction_psi == by_name["guess"][2] and summary.max_feature_psi == by_name["age"][2]


def test_summary_without_any_known_psi(spark):
    some, none = frame(spark, x=[1.0]), frame(spark, x=[1.0]).where("false")
    summary = drift_summary(compute_drift(some, none, numeric_cols=["x"], categorical_cols=[])).first()
    assert (summary.max_feature_psi, summary.prediction_psi, summary.drifted_features) == (0.0, None, [])


def test_settled_features_are_not_read_again(spark):
    # A value that fills its cell needs no finer look: fewer jobs run than for one whose neighbours share the cell.
    def jobs(values):
        spark.sparkContext.setJobGroup(f"quantiles of {len(values)}", "quantiles")
        counts = spark.createDataFrame([("x", v, 1) for v in values], "feature string, value double, n long")
        assert exact_quantiles(counts, [0.0, 0.5, 1.0]).first().quantiles == [values[0], values[len(values) // 2], values[-1]]
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"quantiles of {len(values)}"))

    try:
        assert jobs([1.0, 2.0, 3.0]) < jobs([1.0, 1.0001, 1.0002, 1.0003, 1.0004])
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_value_meets_only_the_parts_of_its_own_cell(spark, monkeypatch):
    counts = number_rows(frame(spark, x=list(rng.random(50))), frame(spark, x=[0.5]), ["x"])
    joined, join = [], type(counts).join
    monkeypatch.setattr(type(counts), "join", lambda left, right, on=None, how=None: joined.append(on) or join(left, right, on, how))
    quantile_edges(counts).collect()
    assert joined and all(on == ["feature", "cell"] for on in joined)
