"""Metric logs with a row for each stage of a model."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from verdigris.operators.metrics import forecast_metrics, staged_log
from verdigris.operators.models import TreeParams, boosting_log, train_trees


@pytest.fixture(scope="module")
def rows(spark):
    x = (F.col("id") * 37 % 101).cast("double")
    return spark.range(400).select(
        F.col("id").alias("reading_id"), F.col("id").alias("timestamp"), x.alias("x"), (x > 50).cast("int").alias("y"), (2 * x).alias("v")
    )


def test_boosting_has_a_row_for_each_round(rows):
    model, prepared = train_trees(rows, "y", params=TreeParams(rounds=6, max_depth=2), columns=["x"])
    log = boosting_log(model, prepared, "y", "trees").orderBy("step").collect()
    assert [r.step for r in log] == list(range(1, model.model.getNumTrees + 1))
    assert log[-1].value < log[0].value
    # The last row is the loss of the final scores: 2 log(1 + exp(-2 y m)), with p = 1 / (1 + exp(-2 m)).
    scored = model.score(prepared, "p").select("p", "y").collect()
    loss = sum(-2 * math.log(r.p if r.y == 1 else 1 - r.p) for r in scored) / len(scored)
    assert log[-1].value == pytest.approx(loss, rel=1e-6)


def test_a_regressor_ends_at_its_squared_error(rows):
    model, prepared = train_trees(rows, "v", classify=False, params=TreeParams(rounds=5, max_depth=2), columns=["x"])
    log = boosting_log(model, prepared, "v", "trees").orderBy("step").collect()
    scored = model.score(prepared, "p")
    final = scored.agg(F.avg(F.pow(F.col("v") - F.col("p"), F.lit(2.0)))).first()[0]
    assert log[-1].value == pytest.approx(final, rel=1e-6)


def test_stages_equal_single_metrics(spark):
    frame = spark.createDataFrame(
        [(1.0, 2.0, None), (0.0, 1.0, math.nan), (4.0, math.inf, 4.5), (None, 1.0, 1.0)], "y double, a double, b double"
    )
    log = {(r.step, r.name): r.value for r in staged_log(frame, "y", ["a", "b"], "run").collect()}
    for step, name in ((1, "a"), (2, "b")):
        for metric, value in forecast_metrics(frame, "y", name).first().asDict().items():
            assert log[step, metric] == pytest.approx(value)
    assert staged_log(frame.limit(0), "y", ["a"], "run").count() == 0
