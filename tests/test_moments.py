"""Moments of sliding windows equal those of the flattened windows, and so does the fit."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from verdigris.operators.models import SequenceParams, train_forecaster
from verdigris.operators.moments import rows_with_moments, window_moments


def series(n: int) -> np.ndarray:
    rng = np.random.default_rng(3)
    a = np.cumsum(rng.normal(size=n)) / 10
    return np.column_stack([a, rng.normal(size=n), 0.4 * np.roll(a, 1) + rng.normal(size=n) / 5])


def frame(spark, values):
    rows = [(i, *map(float, v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "position long, a double, b double, y double").repartition(5)


def flattened(values, length, windows):
    return np.array([[*values[s : s + length, :2].ravel(), values[s + length, 2]] for s in range(windows)])


@pytest.mark.parametrize(("n", "length", "windows", "chunk"), [(300, 6, 200, 50), (300, 6, 294, 6), (40, 1, 39, 7), (30, 12, 3, 5), (200, 4, 100, 65_536)])
def test_moments_equal_flattened_windows(spark, n, length, windows, chunk):
    values = series(n)
    mean, covariance = window_moments(frame(spark, values), ["a", "b"], "y", length, windows, chunk)
    flat = flattened(values, length, windows)
    assert np.allclose(mean, flat.mean(axis=0))
    assert np.allclose(covariance, np.cov(flat.T, bias=True), atol=1e-10)


def test_rows_have_the_moments(spark):
    flat = flattened(series(120), 3, 100)
    mean, covariance = flat.mean(axis=0), np.cov(flat.T, bias=True)
    rows = np.array([[*r.x, r.y] for r in rows_with_moments(spark, mean, covariance).collect()])
    assert np.allclose(rows.mean(axis=0), mean) and np.allclose(np.cov(rows.T, bias=True), covariance)
    still = rows_with_moments(spark, mean, np.zeros_like(covariance)).collect()
    assert len(still) == 1 and np.allclose([*still[0].x, still[0].y], mean)


def test_gaps_are_refused(spark):
    gappy = frame(spark, series(60)).withColumn("b", F.when(F.col("position") != 20, F.col("b")))
    with pytest.raises(ValueError, match="gaps"):
        window_moments(gappy, ["a", "b"], "y", 3, 40)


def test_forecast_equals_least_squares_on_flattened_windows(spark):
    values, length, share = series(300), 5, 0.8
    model, tested = train_forecaster(frame(spark, values), ["a", "b"], 300, SequenceParams(length=length, target="y"), share)
    train = int((300 - length) * share)
    flat = flattened(values, length, 300 - length)
    design = np.column_stack([np.ones(len(flat)), flat[:, :-1]])
    weights = np.linalg.lstsq(design[:train], flat[:train, -1], rcond=None)[0]
    got = {r["sample"]: (r.actual, r.predicted) for r in tested.collect()}
    assert sorted(got) == list(range(train, 300 - length))
    for s, (actual, predicted) in got.items():
        assert actual == pytest.approx(flat[s, -1]) and predicted == pytest.approx(design[s] @ weights, abs=1e-6)


def test_constant_columns_stay_constant(spark):
    flat = flattened(series(120), 3, 100)
    flat[:, 2] = 0.1
    rows = rows_with_moments(spark, flat.mean(axis=0), np.cov(flat.T, bias=True)).collect()
    assert len({r.x[2] for r in rows}) == 1 and len({r.x[0] for r in rows}) > 1


def test_numbered_rows_are_filled_without_a_second_sort(spark, monkeypatch):
    from verdigris.operators import sequences
    from verdigris.plans.batch import feature_series
    from verdigris.plans.registry import Tables

    schema = "position long, a double, b double, never double"
    rows = [(i, None if i < 9 or i % 5 else float(i), None if i in (0, 7, 8, 19) else -float(i), None) for i in range(20)]
    df = spark.createDataFrame(rows, schema)
    want = sequences.fill_gaps(df, ["a", "b", "never"], ["position"]).orderBy("position").collect()
    monkeypatch.setattr(sequences, "store_sorted", lambda *_: pytest.fail("sorted again"))
    series, _ = feature_series(Tables(spark, "/root/testdata/sf0.001").fact.limit(50))
    assert series.filter("ph_level is null").count() == 0
    for size in (1, 3, 100):
        found = sequences.fill_gaps(df, ["a", "b", "never"], ["position"], numbered="position", range_rows=size)
        assert found.orderBy("position").collect() == want
