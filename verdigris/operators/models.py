"""Training and batch scoring with Spark ML pipelines."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import SparseVector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from verdigris.operators.metrics import METRIC_ROWS
from verdigris.operators.mlprep import (
    LABEL,
    SEED,
    check_features,
    class_weights,
    feature_names,
    holdout,
    inverse_standard,
    prepare_tabular,
    standard_stats,
)
from verdigris.operators.moments import rows_with_moments, window_moments
from verdigris.operators.ordering import in_chunks
from verdigris.operators.sequences import inference_row, inference_windows, sequence_windows, window_weight


# Training defaults.
@dataclass(frozen=True)
class TreeParams:
    """Boosted-tree settings. Depth 5 stands for 31 leaves."""

    rounds: int = 100
    max_depth: int = 5
    step: float = 0.05
    feature_share: str = "0.9"
    row_share: float = 0.8
    min_leaf_rows: int = 20


@dataclass(frozen=True)
class SequenceParams:
    """Forecast settings: window length, horizon and regularisation."""

    length: int = 24
    target: str = "ph_level"
    penalty: float = 0.0
    mix: float = 0.0


TREE_PARTITION_ROWS = 100_000

_SPEC = "kind string, features array<string>, classifies boolean, length int, target string, stats map<string, double>"
_FITTED = {m.__name__: m for m in (GBTClassificationModel, GBTRegressionModel, LinearRegressionModel)}


@dataclass
class TabularModel:
    """A fitted tree model with the feature list it was trained on."""

    model: Model
    features: list[str]
    classifies: bool

    def score(self, df: DataFrame, output: str) -> DataFrame:
        """Add the positive-class probability (classifier) or the value (regressor)."""
        check_features(df, self.features, self.model.numFeatures)
        inputs = [F.coalesce(F.col(n).cast("float"), F.lit(0.0)).cast("double") for n in self.features]
        scored = self.model.transform(df.withColumn("features", array_to_vector(F.array(*inputs))))
        value = vector_to_array("probability")[1] if self.classifies else F.col("prediction")
        return scored.select(*df.columns, value.alias(output))


def _spread(training: DataFrame) -> DataFrame:
    """Many rows in partitions of ``TREE_PARTITION_ROWS``: each pass over the cached rows reads a partition
    whole in one task, and stored files only follow the compressed size of the rows."""
    rows = training.count()
    if rows <= TREE_PARTITION_ROWS:
        return training
    parallel = training.sparkSession.sparkContext.defaultParallelism
    return training.repartition(max(-(-rows // TREE_PARTITION_ROWS), parallel))


def train_trees(
    features: DataFrame,
    target: str = LABEL,
    classify: bool = True,
    params: TreeParams = TreeParams(),
    columns: Sequence[str] | None = None,
    key: Sequence[str] = ("reading_id", "timestamp"),
    seed: int = SEED,
) -> tuple[TabularModel, DataFrame]:
    """Fit boosted trees; returns the model and the prepared rows (with ``is_train``).

    A fifth of the training rows is held out and stops the boosting when it no longer
    improves. Rare classes are weighted.
    """
    columns = list(columns) if columns is not None else feature_names(features, target)
    check_features(features, columns)
    prepared = prepare_tabular(features, target, columns, key, seed=seed)
    # A feature missing on every training row has no mean; it carries no signal either.
    prepared = prepared.na.fill(0.0, columns)
    rows = holdout(prepared.filter("is_train"), key, seed=seed + 1)
    if classify:
        # At most a handful of classes: the weights are a constant-size table.
        weights = class_weights(rows.filter("not is_validation"), target).select(target, "weight")
        # Validation rows of a class without training rows, and rows without label, stay.
        rows = rows.join(weights, target, "left").fillna(1.0, ["weight"])
    else:
        rows = rows.withColumn("weight", F.lit(1.0))
    assembled = VectorAssembler(inputCols=columns, outputCol="features").transform(rows)
    shared = dict(
        featuresCol="features",
        labelCol=target,
        weightCol="weight",
        validationIndicatorCol="is_validation",
        maxIter=params.rounds,
        maxDepth=params.max_depth,
        stepSize=params.step,
        featureSubsetStrategy=params.feature_share,
        subsamplingRate=params.row_share,
        minInstancesPerNode=params.min_leaf_rows,
        seed=seed,
    )
    learner = GBTClassifier(**shared) if classify else GBTRegressor(**shared)
    training = assembled.select("features", F.col(target).cast("double").alias(target), "weight", "is_validation")
    return TabularModel(learner.fit(_spread(training)), columns, classify), prepared


def boosting_log(model: TabularModel, rows: DataFrame, target: str, run: str) -> DataFrame:
    """Loss of the model after each boosting round over ``rows``: ``(run, step, name, value)``.

    All rounds are evaluated in one pass over the rows.
    """
    check_features(rows, model.features, model.model.numFeatures)
    inputs = [F.coalesce(F.col(n).cast("float"), F.lit(0.0)).cast("double") for n in model.features]
    names = {
        model.model.getLabelCol(): F.col(target).cast("double"),
        model.model.getFeaturesCol(): array_to_vector(F.array(*inputs)),
        model.model.getOrDefault("weightCol"): F.lit(1.0),
    }
    data = rows.select(*[column.alias(name) for name, column in names.items()])
    if model.classifies:
        found = model.model.evaluateEachIteration(data)
    else:
        found = model.model.evaluateEachIteration(data, "squared")
    log = [(run, step, "loss", float(value)) for step, value in enumerate(found, 1)]
    return rows.sparkSession.createDataFrame(log, METRIC_ROWS)


@dataclass
class SequenceModel:
    """A fitted window model with the scaling statistics of its training rows."""

    model: Model
    features: list[str]
    length: int
    target: str
    stats: dict[str, float]

    def predict(
        self, windows: DataFrame, output: str, stats: dict[str, float] | None = None
    ) -> DataFrame:
        """Add the forecast, in original units, to rows holding a raw window ``x``.

        ``stats`` replaces the training statistics as the input scaling.
        """
        used = stats or self.stats
        means = F.array(*[F.lit(float(used[f"mean_{n}"])) for n in self.features])
        spreads = F.array(*[F.lit(float(used[f"std_{n}"]) or 1.0) for n in self.features])
        scaled = F.transform(
            F.col("x").cast("array<array<double>>"),
            lambda row: F.zip_with(
                F.zip_with(row, means, lambda v, m: v - m), spreads, lambda v, s: v / s
            ),
        )
        vectors = windows.withColumn("_vector", _window_vector(scaled))
        mean, std = F.lit(self.stats["mean_y"]), F.lit(self.stats["std_y"])
        # The fitted model is shared, so its columns are named on a copy.
        model = self.model.copy({self.model.featuresCol: "_vector", self.model.predictionCol: "_z"})
        return model.transform(vectors).select(
            *windows.columns, inverse_standard(F.col("_z"), mean, std).alias(output)
        )


def save_model(spark: SparkSession, model: TabularModel | SequenceModel, path: str) -> None:
    """The fitted model, and one Parquet row with its inputs and scaling statistics."""
    model.model.write().overwrite().save(f"{path}/model")
    sequence = isinstance(model, SequenceModel)
    row = (
        type(model.model).__name__,
        list(model.features),
        None if sequence else model.classifies,
        model.length if sequence else None,
        model.target if sequence else None,
        {k: float(v) for k, v in model.stats.items()} if sequence else {},
    )
    spark.createDataFrame([row], _SPEC).coalesce(1).write.mode("overwrite").parquet(f"{path}/spec")


def load_model(spark: SparkSession, path: str) -> TabularModel | SequenceModel:
    """What ``save_model`` stored, ready to score."""
    spec = spark.read.schema(_SPEC).parquet(f"{path}/spec").first()
    fitted = _FITTED[spec["kind"]].load(f"{path}/model")
    if spec["length"] is None:
        return TabularModel(fitted, spec["features"], spec["classifies"])
    return SequenceModel(fitted, spec["features"], spec["length"], spec["target"], spec["stats"])


def batch_statistics(
    numbered: DataFrame, columns: Sequence[str], length: int, total: int, epsilon: float = 1e-8
) -> dict[str, float]:
    """Mean and sample deviation of the rows about to be scored.

    Every row counts once per window it occurs in; ``epsilon`` is added to the deviation.
    """
    weight = window_weight(F.col("position"), total - length, length)
    filled = numbered.select(
        "position", *[F.coalesce(F.col(n).cast("double"), F.lit(0.0)).alias(n) for n in columns]
    )
    row = standard_stats(filled.filter(weight > 0), columns, weight, sample=True).first().asDict()
    return {n: (v or 0.0) + (epsilon if n.startswith("std_") else 0.0) for n, v in row.items()}


def _window_vector(windows: Column) -> Column:
    return array_to_vector(F.flatten(windows).cast("array<double>"))


@dataclass
class WindowStatistics:
    """What a forecast is fitted from: scaling statistics and moments of the training windows."""

    stats: dict[str, float]
    scaled_rows: DataFrame
    train_windows: int
    mean: np.ndarray
    covariance: np.ndarray


def window_statistics(
    numbered: DataFrame, columns: Sequence[str], total: int, length: int, target: str, share: float = 0.8
) -> WindowStatistics:
    """Statistics of the first ``share`` of the windows; penalties do not change them."""
    inputs = [n for n in columns if n != target]
    samples = total - length
    train_windows = int(max(samples, 0) * share)
    if train_windows < 1:
        raise ValueError("the series is too short for one training window")
    position = F.col("position")
    weight = window_weight(position, train_windows, length)
    x_stats = standard_stats(numbered.filter(weight > 0), inputs, weight)
    is_goal = position.between(length, length + train_windows - 1)
    y_stats = standard_stats(numbered.filter(is_goal).select(F.col(target).alias("y")), ["y"])
    # Two rows of statistics: their size depends on the column count only.
    stats = {**x_stats.first().asDict(), **y_stats.first().asDict()}
    stats = {name: (value if value is not None else 0.0) for name, value in stats.items()}
    scaled = {}
    for n in inputs:
        std = stats[f"std_{n}"] or 1.0
        scaled[n] = (F.col(n).cast("double") - F.lit(stats[f"mean_{n}"])) / F.lit(std)
    y_std = stats["std_y"] or 1.0
    scaled[target] = (F.col(target) - F.lit(stats["mean_y"])) / F.lit(y_std)
    scaled_rows = numbered.withColumns(scaled)
    moments = window_moments(scaled_rows, inputs, target, length, train_windows)
    return WindowStatistics(stats, scaled_rows, train_windows, *moments)


def train_forecaster(
    numbered: DataFrame,
    columns: Sequence[str],
    total: int,
    params: SequenceParams = SequenceParams(),
    share: float = 0.8,
    statistics: WindowStatistics | None = None,
) -> tuple[SequenceModel, DataFrame]:
    """Direct autoregression on flattened windows; the first ``share`` of the samples train.

    The fit needs the mean and covariance of the windows only, which come from lagged products
    of the scaled rows: no training window is built. Returns the model and the scored test samples (``actual``,
    ``predicted`` in original units). ``numbered`` must have no gaps. ``statistics`` of the same rows,
    columns, length, target and share may be passed, so that several fits share one pass.
    """
    inputs = [n for n in columns if n != params.target]
    position = F.col("position")
    found = statistics or window_statistics(numbered, columns, total, params.length, params.target, share)
    stats = found.stats
    alike = rows_with_moments(numbered.sparkSession, found.mean, found.covariance)
    windows = sequence_windows(
        found.scaled_rows.filter(position >= found.train_windows), [*inputs, params.target], params.length, params.target
    ).select("sample", _window_vector(F.col("x")).alias("features"), "y")
    learner = LinearRegression(
        featuresCol="features",
        labelCol="y",
        regParam=params.penalty,
        elasticNetParam=params.mix,
        standardization=False,
    )
    fitted = learner.fit(alike.select(array_to_vector("x").alias("features"), "y"))
    model = SequenceModel(fitted, inputs, params.length, params.target, stats)
    mean, std = F.lit(stats["mean_y"]), F.lit(stats["std_y"])
    tested = fitted.transform(windows).select(
        "sample",
        inverse_standard(F.col("y"), mean, std).alias("actual"),
        inverse_standard(F.col("prediction"), mean, std).alias("predicted"),
    )
    return model, tested


def score_with_function(
    windows: DataFrame,
    predict: Callable[[pd.Series], pd.Series],
    output: str,
    keep: Sequence[str] = ("position",),
) -> DataFrame:
    """Score windows with any Python model.

    ``predict`` maps a batch of windows (``x``, nested lists) to a batch of numbers; it is
    shipped to the tasks once and called per Arrow batch.
    """
    kept = [windows.schema[name] for name in keep]
    schema = T.StructType([*kept, T.StructField(output, T.DoubleType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scored = batch[list(keep)].copy()
            scored[output] = predict(batch["x"])
            yield scored

    return windows.select(*keep, "x").mapInPandas(run, schema)


def ensemble_average(*predictions: Column) -> Column:
    """Unweighted mean of the model outputs."""
    total = predictions[0]
    for other in predictions[1:]:
        total = total + other
    return total / len(predictions)


def _step_sums(row: Column, models: Sequence[SequenceModel], stats: dict[str, float] | None) -> Column:
    """What a row adds to each linear forecast at each step of a window: models by steps, flattened."""
    parts = []
    for model in models:
        used = stats or model.stats
        found = model.model.coefficients
        weights = np.array(found.toArray(), np.float64).reshape(model.length, len(model.features)).T
        means = np.array([float(used[f"mean_{n}"]) for n in model.features])
        spreads = np.array([float(used[f"std_{n}"]) or 1.0 for n in model.features])
        # A sparse vector skips its zeros: there a value that is not finite has no effect.
        skipped = (weights == 0) & isinstance(found, SparseVector)
        parts.append((weights, means, spreads, skipped))

    inputs, wide = len(models[0].features), sum(p[0].shape[1] for p in parts)

    # Arrow arrays keep what is not a number apart from null.
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = batch.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(batch), inputs)
            sums = []
            with np.errstate(all="ignore"):
                for weights, means, spreads, skipped in parts:
                    scaled = (rows - means) / spreads
                    added = scaled @ weights
                    for i in np.flatnonzero(~np.isfinite(scaled).all(axis=1)):
                        added[i] = np.where(skipped, 0.0, scaled[i][:, None] * weights).sum(axis=0)
                    sums.append(added)
            ends = np.arange(0, len(batch) * wide + 1, wide, dtype=np.int32)
            yield pa.ListArray.from_arrays(ends, np.concatenate(sums, axis=1).ravel())

    return F.arrow_udf(run, "array<double>")(row)


def _total(terms: Sequence[Column]) -> Column:
    """Sum of the terms, in pairs, so that the expression stays shallow."""
    while len(terms) > 1:
        terms = [a + b for a, b in zip(terms[::2], terms[1::2])] + list(terms[len(terms) // 2 * 2 :])
    return terms[0]


def _forecast_linear(
    scored: DataFrame, kept: Sequence[str], sequence: Mapping[str, SequenceModel], stats: dict[str, float] | None
) -> DataFrame:
    """``kept`` and the forecasts of linear models, without building a window.

    A forecast is a sum over the window's rows. Each row is scaled and multiplied by the weights of
    all steps once, and a window adds up one number of each of its rows, where a window of rows
    would scale and multiply every row ``length`` times.
    """
    models = list(sequence.values())
    length = models[0].length
    slim = scored.select("position", *kept, _step_sums(inference_row(models[0].features), models, stats).alias("_sums"))

    def frames(window):
        def forecast(number: int, model: SequenceModel) -> Column:
            own = [F.lag(F.col("_sums")[number * length + k], length - k).over(window) for k in range(length)]
            z = _total(own) + F.lit(float(model.model.intercept))
            return inverse_standard(z, F.lit(model.stats["mean_y"]), F.lit(model.stats["std_y"]))

        found = [forecast(i, m).alias(name) for i, (name, m) in enumerate(sequence.items())]
        return [*found, F.lag("position", length).over(window).alias("_first")]

    framed = in_chunks(slim, frames, length)
    return framed.filter("_first is not null").select(*kept, *sequence)


def score_batch(
    features: DataFrame,
    tabular: TabularModel,
    sequence: Mapping[str, SequenceModel],
    tabular_output: str = "lightgbm_prediction",
    own_stats: bool = False,
) -> DataFrame:
    """Feature rows with every prediction, their mean and the scoring time.

    ``features`` carries ``position``. Sequence models must agree on their inputs. Rows
    without a complete window before them are dropped.
    """
    specs = list(sequence.values())
    first = specs[0]
    if any(m.features != first.features or m.length != first.length for m in specs):
        raise ValueError("sequence models differ in features or window length")
    check_features(features, first.features)
    stats = None
    if own_stats:
        stats = batch_statistics(features, first.features, first.length, features.count())
    scored = tabular.score(features, tabular_output)
    kept = [n for n in scored.columns if n != "position"]
    if all(isinstance(m.model, LinearRegressionModel) for m in specs):
        scored = _forecast_linear(scored, kept, sequence, stats)
    else:
        # One window per row serves all sequence models; it stays on the row it predicts.
        scored = inference_windows(scored, first.features, first.length, keep=kept)
        for name, model in sequence.items():
            scored = model.predict(scored, name, stats)
        scored = scored.drop("x", "sample")
    outputs = [*sequence, tabular_output]
    return scored.withColumns(
        {
            "ensemble_avg": ensemble_average(*[F.col(n) for n in outputs]),
            "inference_timestamp": F.current_timestamp(),
        }
    )
