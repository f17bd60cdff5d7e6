"""Scoring and training jobs do the work of a row once, not once for each window or model."""

from __future__ import annotations

import math

import pytest
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from tests.conftest import plan_of
from verdigris.operators import models as m
from verdigris.operators.sequences import inference_windows
from verdigris.plans import batch

INPUTS = ["a", "b", "c"]
OUTPUTS = ["lstm_prediction", "gru_prediction"]


class _Trees:
    def score(self, df, output):
        return df.withColumn(output, F.lit(0.5))


@pytest.fixture(scope="module")
def series(spark):
    """4,000 rows (two chunks) with gaps, a very large value and one that is not a number."""
    from verdigris.session import materialize

    at = F.col("id")
    df = spark.range(4000).select(
        at.alias("position"),
        at.alias("reading_id"),
        F.timestamp_seconds(at * 60).alias("timestamp"),
        (F.sin(at / 7) + 6).alias("ph_level"),
        F.when(at % 11 != 0, F.cos(at / 5) * 100).alias("a"),
        F.when(at == 3700, 1e300).when(at == 3900, F.lit("NaN").cast("double")).otherwise(F.sin(at / 3)).alias("b"),
        (at * 7919 % 100).alias("c"),
    )
    return materialize(df, "series")


@pytest.fixture(scope="module")
def models(series):
    whole = series.fillna(0.0).withColumn("b", F.sin(F.col("position") / 3))
    kinds = {OUTPUTS[0]: m.SequenceParams(length=12, penalty=0.1), OUTPUTS[1]: m.SequenceParams(length=12, penalty=0.3, mix=0.9)}
    return {name: m.train_forecaster(whole, INPUTS, 4000, params)[0] for name, params in kinds.items()}


@pytest.mark.parametrize("own", [False, True])
def test_forecasts_equal_those_of_windows(series, models, own):
    assert isinstance(models[OUTPUTS[1]].model.coefficients, SparseVector)
    rows = series.filter("position < 3600") if own else series
    stats = m.batch_statistics(rows, INPUTS, 12, rows.count()) if own else None
    windows = inference_windows(rows, INPUTS, 12, keep=["reading_id"])
    for name, model in models.items():
        windows = model.predict(windows, name, stats)
    wanted = {r.reading_id: r for r in windows.select("reading_id", *OUTPUTS).collect()}
    out = m.score_batch(rows, _Trees(), models, own_stats=own)
    assert out.columns == [*[c for c in rows.columns if c != "position"], "lightgbm_prediction", *OUTPUTS, "ensemble_avg", "inference_timestamp"]
    found = out.collect()
    assert len(found) == len(wanted) == rows.count() - 12
    for r in found:
        for name in OUTPUTS:
            a, b = r[name], wanted[r.reading_id][name]
            assert (math.isnan(a) and math.isnan(b)) or a == b or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


def test_no_window_is_built_to_score(series, models):
    plan = plan_of(m.score_batch(series, _Trees(), models))
    assert "collect_list" not in plan and "zip_with" not in plan and plan.count("ArrowEvalPython") == 1


def test_fits_share_their_statistics(spark, series, fresh, monkeypatch):
    calls, moments = [], m.window_moments
    monkeypatch.setattr(m, "window_moments", lambda *a: calls.append(a) or moments(*a))
    rows = series.fillna(0.0).withColumns({"b": F.sin(F.col("position") / 3), batch.LABEL: (F.col("c") > 50).cast("int")})
    _, both = batch.train_models(rows, batch.Lake(fresh("lake")), trees=m.TreeParams(rounds=2, max_depth=2))
    assert sorted(both) == sorted(OUTPUTS) and len(calls) == 1
    assert both[OUTPUTS[0]].stats == both[OUTPUTS[1]].stats
