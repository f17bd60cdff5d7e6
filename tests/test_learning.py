"""Windows, scaling, metrics and models against direct computations."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from verdigris.operators.joins import join_predictions
from verdigris.operators.metrics import (
    classification_metrics,
    forecast_metrics,
    metric_rows,
    regression_metrics,
    roc_auc,
)
from verdigris.operators.mlprep import (
    LABEL,
    check_features,
    class_weights,
    env_label,
    feature_names,
    hash_split,
    holdout,
    mean_fill,
    prepare_tabular,
    scale_standard,
    standard_stats,
)
from verdigris.operators.models import (
    SequenceParams,
    TreeParams,
    batch_statistics,
    score_batch,
    score_with_function,
    train_forecaster,
    train_trees,
)
from verdigris.operators.sequences import chrono_split, inference_windows, sequence_windows, window_weight


def series(spark, n=60):
    return spark.range(n).select(
        F.col("id").alias("position"),
        (F.col("id") * 7 % 11).cast("double").alias("a"),
        (F.col("id") * 5 % 13).cast("double").alias("b"),
        F.col("id").cast("double").alias("t"),
    )


@pytest.mark.parametrize("length,horizon,chunk", [(4, 1, 10), (5, 3, 7), (24, 1, 1000)])
def test_windows_match_slices(spark, length, horizon, chunk):
    n = 60
    data = np.array([[i * 7 % 11, i * 5 % 13] for i in range(n)], float)
    rows = sequence_windows(series(spark, n), ["a", "b", "t"], length, "t", horizon, chunk_rows=chunk).collect()
    assert len(rows) == n - length - horizon + 1
    for r in rows:
        i = r.sample
        assert np.array_equal(np.array(r.x), data[i : i + length])
        goal = [float(i + length + k) for k in range(horizon)]
        assert r.y == (goal[0] if horizon == 1 else goal)


def test_short_series_has_no_windows(spark):
    assert sequence_windows(series(spark, 24), ["a"], 24, "t").count() == 0
    assert inference_windows(series(spark, 24), ["a"], 24).count() == 0
    assert inference_windows(series(spark, 25), ["a"], 24).count() == 1


def test_null_targets_keep_their_place(spark):
    rows = series(spark, 10).withColumn("t", F.when(F.col("position") != 5, F.col("t")))
    found = {r.sample: r.y for r in sequence_windows(rows, ["a"], 3, "t").collect()}
    assert len(found) == 7 and found[2] is None and found[3] == 6.0


def test_join_predictions_drops_the_first_rows(spark):
    predictions = spark.range(56).select(F.col("id").alias("sample"), (F.col("id") * 2).alias("p"))
    rows = join_predictions(series(spark), predictions, 4).collect()
    assert len(rows) == 56 and all(r.p == 2 * (r.position - 4) for r in rows)


def test_chrono_split_counts(spark):
    rows = chrono_split(spark.range(57).withColumnRenamed("id", "sample"), 57)
    assert rows.filter("is_train").count() == int(57 * 0.8)


def test_window_weights_equal_flattened_windows(spark):
    n, length = 60, 6
    train = int((n - length) * 0.8)
    x = np.array([i * 7 % 11 for i in range(n)], float)
    flat = np.concatenate([x[i : i + length] for i in range(train)])
    row = standard_stats(series(spark, n), ["a"], window_weight(F.col("position"), train, length)).first()
    assert math.isclose(row.mean_a, flat.mean()) and math.isclose(row.std_a, flat.std())
    own = batch_statistics(series(spark, n), ["a"], length, n)
    flat = np.concatenate([x[i : i + length] for i in range(n - length)])
    assert math.isclose(own["std_a"], flat.std(ddof=1) + 1e-8)


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert {r.v for r in scale_standard(df, ["v"], standard_stats(df, ["v"])).collect()} == {0.0}


def test_metric_edge_cases(spark):
    nan = float("nan")
    frame = lambda rows: spark.createDataFrame(rows, "y double, p double")
    empty = forecast_metrics(frame([(nan, 1.0), (1.0, None), (float("inf"), 2.0)]), "y", "p").first()
    assert empty.mae is None and empty.rmse is None and empty.mape is None
    zero = forecast_metrics(frame([(0.0, 1.0), (0.0, 3.0)]), "y", "p").first()
    assert zero.mae == 2.0 and zero.mape is None
    assert regression_metrics(frame([(1.0, 1.0), (1.0, 2.0)]), "y", "p").first().r2_score is None
    one_class = classification_metrics(spark.createDataFrame([(0, 0.1), (0, 0.5)], "y int, p double"), "y", "p").first()
    assert (one_class.accuracy, one_class.precision, one_class.recall, one_class.f1_score) == (1.0, 0.0, 0.0, 0.0)
    assert one_class.roc_auc is None


def test_auc_equals_pair_count(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 300)
    s = np.round(rng.random(300) + 0.2 * y, 1)
    pos, neg = s[y == 1], s[y == 0]
    want = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double").repartition(5)
    assert math.isclose(roc_auc(df, "y", "s").first().roc_auc, want)


def test_metric_rows_drop_missing(spark):
    rows = metric_rows(spark, "r", {"mae": 1.0, "mape": None, "auc": float("nan")}, 3).collect()
    assert [(r.run, r.step, r.name, r.value) for r in rows] == [("r", 3, "mae", 1.0)]


def test_feature_lists(spark, tables):
    labelled = env_label(tables.features)
    assert len(tables.features.columns) == 39
    assert len(feature_names(labelled, with_id=True)) == 30
    assert len(feature_names(labelled)) == 29
    with pytest.raises(ValueError, match="missing features"):
        check_features(labelled, ["nope"])
    with pytest.raises(ValueError, match="mismatch"):
        check_features(labelled, ["ph_level"], 2)
    with pytest.raises(ValueError, match="indicator"):
        env_label(labelled.drop("is_ph_optimal"))


def test_split_is_stable_and_near_its_share(spark):
    df = spark.range(5000)
    split = holdout(hash_split(df, ["id"]), ["id"])
    again = holdout(hash_split(df.repartition(7), ["id"]), ["id"])
    assert split.exceptAll(again).count() == 0
    train = split.filter("is_train").count()
    assert abs(train / 5000 - 0.8) < 0.03
    assert abs(split.filter("is_validation").count() / train - 0.2) < 0.03
    assert split.filter("is_validation and not is_train").count() == 0


def test_means_come_from_training_rows(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 2 == 0, F.col("id").cast("double")).alias("v"), F.lit(0).alias("y"))
    split = hash_split(df, ["id"])
    mean = split.filter("is_train").agg(F.avg("v")).first()[0]
    filled = prepare_tabular(df, "y", ["v"], ["id"]).filter("id % 2 = 1").select("v").distinct().collect()
    assert len(filled) == 1 and math.isclose(filled[0].v, mean)
    assert mean_fill(df, ["v"]).filter("v is null").count() == 0


@pytest.mark.parametrize("positive,weighted", [(5, True), (30, False), (95, True)])
def test_class_weights_only_when_rare(spark, positive, weighted):
    df = spark.range(100).select((F.col("id") < positive).cast("int").alias("y"))
    found = {r.y: r.weight for r in class_weights(df, "y").collect()}
    want = {1: 100 / (2 * positive), 0: 100 / (2 * (100 - positive))} if weighted else {0: 1.0, 1: 1.0}
    assert found == pytest.approx(want)


@pytest.fixture(scope="module")
def wave(spark):
    """A learnable series: a sine with a phase-shifted companion and a label."""
    from verdigris.session import materialize

    angle = F.col("id") / 7.0
    df = spark.range(600).select(
        F.col("id").alias("position"),
        F.col("id").alias("reading_id"),
        F.timestamp_seconds(F.col("id") * 60).alias("timestamp"),
        (F.sin(angle) + 6).alias("ph_level"),
        (F.cos(angle) * 100 + 1000).alias("tds_level"),
        F.lit(None).cast("double").alias("empty"),
        (F.sin(angle) > 0).cast("int").alias("up"),
    )
    return materialize(df, "wave")


def test_models_beat_constant_predictions(spark, wave):
    forecaster, tested = train_forecaster(wave, ["ph_level", "tds_level"], 600, SequenceParams(length=12))
    spread = tested.agg(F.stddev_pop("actual")).first()[0]
    assert forecast_metrics(tested, "actual", "predicted").first().rmse < 0.1 * spread

    trees, prepared = train_trees(wave, "up", columns=["tds_level", "ph_level", "empty"],
                                  params=TreeParams(rounds=5, max_depth=3, min_leaf_rows=5, step=0.3))
    scored = trees.score(prepared.filter("not is_train"), "p")
    metrics = classification_metrics(scored, "up", "p").first()
    assert metrics.accuracy > 0.9 and metrics.roc_auc > 0.9

    out = score_batch(wave, trees, {"lstm_prediction": forecaster, "gru_prediction": forecaster})
    assert out.columns[-5:] == ["lightgbm_prediction", "lstm_prediction", "gru_prediction", "ensemble_avg", "inference_timestamp"]
    rows = out.collect()
    assert len(rows) == 600 - 12
    for r in rows:
        assert math.isclose(r.ensemble_avg, (r.lstm_prediction + r.gru_prediction + r.lightgbm_prediction) / 3)
        assert abs(r.lstm_prediction - r.ph_level) < 0.2
    assert score_batch(wave, trees, {"lstm_prediction": forecaster}, own_stats=True).count() == 588

    regressor, _ = train_trees(wave, "ph_level", False, TreeParams(rounds=5, max_depth=3, min_leaf_rows=5, step=0.5), ["tds_level", "up"])
    fitted = regression_metrics(regressor.score(wave, "p"), "ph_level", "p").first()
    assert fitted.r2_score > 0.5

    with pytest.raises(ValueError, match="differ"):
        other, _ = train_forecaster(wave, ["ph_level", "tds_level"], 600, SequenceParams(length=6))
        score_batch(wave, trees, {"a": forecaster, "b": other})
    with pytest.raises(ValueError, match="too short"):
        train_forecaster(wave, ["ph_level"], 10, SequenceParams(length=12))


def test_any_python_model_can_score(spark, wave):
    windows = inference_windows(wave, ["ph_level", "tds_level"], 12, keep=["position"])
    scored = score_with_function(windows, lambda x: x.map(lambda w: float(w[-1][0])), "p")
    rows = {r.position: r.p for r in scored.collect()}
    truth = {r.position: r.ph_level for r in wave.collect()}
    assert len(rows) == 588 and all(abs(rows[p] - truth[p - 1]) < 1e-5 for p in rows)


def test_trees_are_fitted_on_partitions_of_bounded_size(spark, monkeypatch):
    from verdigris.operators import models

    seen = []

    class Fitted(Exception):
        pass

    def fit(_, data):
        seen.extend(r["count"] for r in data.groupBy(F.spark_partition_id()).count().collect())
        raise Fitted

    monkeypatch.setattr(models, "TREE_PARTITION_ROWS", 50, raising=False)
    monkeypatch.setattr(models.GBTClassifier, "fit", fit)
    rows = spark.range(1000).coalesce(1).selectExpr(
        "id as reading_id", "timestamp'2024-01-01' as timestamp", "id / 7 as a", "cast(id % 2 as int) as label"
    )
    with pytest.raises(Fitted):
        models.train_trees(rows, "label", columns=["a"])
    # About 800 training rows; before, all of them were one task's.
    assert sum(seen) > 700 and max(seen) <= 100
