"""Evaluation metrics as aggregates over (label, prediction) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from verdigris.functions.cleaning import is_finite
from verdigris.operators.ordering import RANGE, SLOT, store_sorted


def finite_pairs(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Rows where both values are finite numbers."""
    return df.filter(is_finite(F.col(actual)) & is_finite(F.col(predicted)))


def forecast_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """MAE, RMSE and MAPE (percent, zero actuals skipped) over finite pairs.

    Without a usable pair the values are null.
    """
    y, p = F.col(actual), F.col(predicted)
    error = y - p
    return finite_pairs(df, actual, predicted).agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.avg(F.when(y != 0, F.abs(error / y))) * 100).alias("mape"),
    )


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """MAE, RMSE and R² of rows with both values. R² is null when the actual values do not vary."""
    y, p = F.col(actual), F.col(predicted)
    error = y - p
    total = F.count(y) * F.var_pop(y)
    return df.filter(y.isNotNull() & p.isNotNull()).agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (1 - F.sum(error * error) / F.when(total != 0, total)).alias("r2_score"),
    )


def predicted_class(probability: Column) -> Column:
    """1 above one half, strictly."""
    return (probability > 0.5).cast("int")


def confusion_matrix(df: DataFrame, label: str, probability: str) -> DataFrame:
    """One row: the four cells, class sizes and predicted sizes."""
    y, p = F.col(label) == 1, predicted_class(F.col(probability)) == 1
    return df.agg(
        F.count_if(~y & ~p).alias("true_negatives"),
        F.count_if(~y & p).alias("false_positives"),
        F.count_if(y & ~p).alias("false_negatives"),
        F.count_if(y & p).alias("true_positives"),
        F.count_if(~y).alias("actual_0"),
        F.count_if(y).alias("actual_1"),
        F.count_if(~p).alias("predicted_0"),
        F.count_if(p).alias("predicted_1"),
    )


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve, ties counted half; null unless both classes occur.

    Rows are first reduced to one per distinct score. The number of negatives below a
    score is a running total over the range-sorted scores: within each range, plus the
    totals of earlier ranges (one row per range).
    """
    y = F.col(label) == 1
    scores = (
        df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(score).alias("_score"))
        .agg(F.count_if(y).alias("_pos"), F.count_if(~y).alias("_neg"))
    )
    stored = store_sorted(scores, ["_score"])
    earlier = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    below = (
        stored.groupBy(RANGE)
        .agg(F.sum("_neg").alias("_n"))
        .select(RANGE, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_below"))
    )
    inside = Window.partitionBy(RANGE).orderBy(SLOT).rowsBetween(Window.unboundedPreceding, -1)
    ranked = stored.withColumn(
        "_lower", F.coalesce(F.sum("_neg").over(inside), F.lit(0))
    ).join(F.broadcast(below), RANGE)
    wins = F.col("_pos") * (F.col("_below") + F.col("_lower") + F.col("_neg") / 2)
    pairs = F.sum("_pos").cast("double") * F.sum("_neg").cast("double")
    return ranked.agg((F.sum(wins) / F.when(pairs > 0, pairs)).alias("roc_auc"))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, 0.0).otherwise(part / F.when(whole != 0, whole))


def classification_metrics(df: DataFrame, label: str, probability: str) -> DataFrame:
    """Accuracy, precision, recall, F1 (0 where undefined) and ROC AUC."""
    tp, tn = F.col("true_positives"), F.col("true_negatives")
    fp, fn = F.col("false_positives"), F.col("false_negatives")
    auc = roc_auc(df, label, probability).scalar()
    return confusion_matrix(df, label, probability).select(
        _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        auc.alias("roc_auc"),
    )


def prediction_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean and sample deviation per prediction column, one row each."""
    stats = df.agg(
        *[F.struct(F.avg(n).alias("mean"), F.stddev_samp(n).alias("std")).alias(n) for n in columns]
    )
    return stats.unpivot([], columns, "prediction", "stats").select(
        "prediction", "stats.mean", "stats.std"
    )


def trajectory_summary(
    fact: DataFrame, by: list[Column], order: Column, measures: list[str], optimal: Column
) -> DataFrame:
    """First and last value of each measure, rows, and optimal rows per group.

    Aggregates keep one row per group and task, whatever the group's size.
    """
    return fact.groupBy(*by).agg(
        F.count(F.lit(1)).alias("steps"),
        F.count_if(optimal).alias("optimal_steps"),
        *[F.min_by(n, order).alias(f"first_{n}") for n in measures],
        *[F.max_by(n, order).alias(f"last_{n}") for n in measures],
    )


METRIC_ROWS = "run string, step int, name string, value double"


def metric_rows(
    spark: SparkSession, run: str, metrics: dict[str, float | None], step: int | None = None
) -> DataFrame:
    """One model evaluation as ``(run, step, name, value)``; missing and NaN values drop out."""
    rows = [
        (run, step, name, float(value))
        for name, value in metrics.items()
        if value is not None and value == value
    ]
    return spark.createDataFrame(rows, METRIC_ROWS)


def metrics_long(metrics: DataFrame, run: str, step: int | None = None) -> DataFrame:
    """A one-row metrics frame as ``(run, step, name, value)`` rows, for an append log."""
    values = metrics.select(*[F.col(n).cast("double").alias(n) for n in metrics.columns])
    return (
        values.unpivot([], metrics.columns, "name", "value")
        .filter(F.col("value").isNotNull() & ~F.isnan("value"))
        .select(F.lit(run).alias("run"), F.lit(step).cast("int").alias("step"), "name", "value")
    )


def staged_log(df: DataFrame, actual: str, stages: list[str], run: str) -> DataFrame:
    """Forecast metrics of each stage of a model as ``(run, step, name, value)``, in one pass.

    ``stages`` are prediction columns in order; steps count from 1. Pairs that are not finite
    are left out of their own stage only, and missing metrics drop out.
    """
    aggregates = []
    for step, name in enumerate(stages, 1):
        y, p = F.col(actual).cast("double"), F.col(name).cast("double")
        error = F.when(is_finite(y) & is_finite(p), y - p)
        relative = F.when(y != 0, F.abs(error / y))
        aggregates += [
            F.avg(F.abs(error)).alias(f"mae|{step}"),
            F.sqrt(F.avg(error * error)).alias(f"rmse|{step}"),
            (F.avg(relative) * 100).alias(f"mape|{step}"),
        ]
    row = df.agg(*aggregates)
    found = row.unpivot([], row.columns, "stage", "value").filter(F.col("value").isNotNull() & ~F.isnan("value"))
    stage = F.split("stage", "[|]")
    return found.select(F.lit(run).alias("run"), stage[1].cast("int").alias("step"), stage[0].alias("name"), "value")
