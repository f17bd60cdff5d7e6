"""Dataset preparation, scaling, metrics, training and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from verdigris.operators.joins import join_predictions
from verdigris.operators.metrics import (
    classification_metrics,
    confusion_matrix,
    forecast_metrics,
    prediction_stats,
    regression_metrics,
    staged_log,
)
from verdigris.operators.mlprep import (
    LABEL,
    SEED,
    check_features,
    class_weights,
    env_label,
    feature_names,
    fill_zero,
    hash_split,
    holdout,
    inverse_scale,
    mean_fill,
    minmax_stats,
    prepare_tabular,
    scale_minmax,
    scale_standard,
    standard_stats,
)
from verdigris.operators.models import (
    SequenceParams,
    ensemble_average,
    score_batch,
    train_forecaster,
    train_trees,
)
from verdigris.operators.moments import window_moments
from verdigris.operators.ordering import in_chunks
from verdigris.operators.sequences import fill_gaps, inference_windows, window_weight
from verdigris.plans.batch import Lake, feature_series, refresh_features, score_features, train_models
from verdigris.plans.oracle import replace_rounded, round6, round_sql, using
from verdigris.plans.registry import Tables, query, rounded
from verdigris.schemas import ACTUATOR_NAMES, INDICATORS, MEASURES
from verdigris.session import materialize, scratch_path

_KEYS = 'reading_id, "timestamp"'
_LABEL_SQL = "cast(is_ph_optimal + is_tds_optimal + is_temp_optimal + is_humidity_optimal = 4 as integer)"
_SCALED = [*MEASURES, *[state for _, _, state in ACTUATOR_NAMES.values()], *INDICATORS]  # all inputs


@query("env_label", using("base", f"select {_KEYS}, {_LABEL_SQL} as is_env_optimal from base"))
def _(t: Tables):
    return env_label(t.base).select("reading_id", "timestamp", LABEL)


@query(
    "feature_select",
    using(
        "features",
        """select * exclude ("timestamp", ph_level, tds_level, air_temperature, air_humidity, is_ph_optimal,
           is_tds_optimal, is_temp_optimal, is_humidity_optimal)
           replace ("""
        + round_sql([f"{n}_avg_{k}" for n in ("ph", "tds", "temp", "humidity", "water_temp") for k in ("1h", "6h")])
        + ") from features",
    ),
)
def _(t: Tables):
    """The historic 30-feature list, row id included."""
    labelled = env_label(t.features)
    return rounded(labelled.select(*feature_names(labelled, with_id=True)))


@query(
    "fill_zero",
    using(
        "base",
        f"select {_KEYS}, "
        + ", ".join(f"{round6(f'coalesce(cast({c} as float), 0)', 3)} as {c}" for c in _SCALED)
        + " from base",
    ),
)
def _(t: Tables):
    return rounded(fill_zero(t.base, _SCALED).select("reading_id", "timestamp", *_SCALED), 3)


def _filled_sql(source: str, rows: str) -> str:
    """Every input, missing values replaced by the mean over ``rows``."""
    means = ", ".join(f"avg({c}) as m_{c}" for c in _SCALED)
    filled = ", ".join(f"round(coalesce({c}, m_{c}) + 1.3e-8, 6) as {c}" for c in _SCALED)
    return f"{filled} from {source}, (select {means} from {source} where {rows})"


@query("prepare_tabular", using("base", f"select {_KEYS}, {_filled_sql('base', 'true')}"))
def _(t: Tables):
    """Means over all rows; the default takes training rows only."""
    key = ["reading_id", "timestamp"]
    prepared = prepare_tabular(env_label(t.base), LABEL, _SCALED, key, fill_from_all=True)
    return rounded(prepared.select(*key, *_SCALED))


@query("mean_fill", using("base", f"select {_KEYS}, {_filled_sql('base', 'true')}"))
def _(t: Tables):
    return rounded(mean_fill(t.base.select("reading_id", "timestamp", *_SCALED), _SCALED))


def _bucket_sql(seed: int) -> str:
    text = f"""concat_ws('|', '{seed}', cast(reading_id as varchar), cast("timestamp" as varchar))"""
    return f"cast('0x' || substr(md5({text}), 1, 8) as bigint) % 1000"


@query(
    "prepare_tabular_train_means",
    using(
        "base",
        f"""select {_KEYS}, {LABEL}, is_train, {_filled_sql(
            f"(select *, {_LABEL_SQL} as {LABEL}, {_bucket_sql(SEED)} >= 200 as is_train from base)", "is_train")}""",
    ),
)
def _(t: Tables):
    """The default: means of training rows only, with label and split."""
    key = ["reading_id", "timestamp"]
    prepared = prepare_tabular(env_label(t.base), LABEL, _SCALED, key)
    return rounded(prepared.select(*key, LABEL, "is_train", *_SCALED))


@query(
    "feature_spec_check",
    using("base", f"select {_KEYS}, {', '.join(_SCALED)} from base"),
)
def _(t: Tables):
    """Declared features are all there, in the declared number; otherwise this is an error."""
    check_features(t.base, _SCALED, expected=len(_SCALED))
    return t.base.select("reading_id", "timestamp", *_SCALED)


@query(
    "hash_split",
    using(
        "base",
        f"""select {_bucket_sql(SEED)} >= 200 as is_train, {_LABEL_SQL} as {LABEL}, count(*) as n
            from base group by 1, 2""",
    ),
)
def _(t: Tables):
    rows = hash_split(env_label(t.base), ["reading_id", "timestamp"])
    return rows.groupBy("is_train", LABEL).agg(F.count(F.lit(1)).alias("n"))


@query(
    "holdout_tail",
    using(
        "base",
        f"""select is_train, is_train and chosen as is_validation, count(*) as n from (
            select {_bucket_sql(SEED)} >= 200 as is_train, {_bucket_sql(SEED + 1)} < 200 as chosen from base)
            group by 1, 2""",
    ),
)
def _(t: Tables):
    key = ["reading_id", "timestamp"]
    rows = holdout(hash_split(env_label(t.base), key), key)
    return rows.groupBy("is_train", "is_validation").agg(F.count(F.lit(1)).alias("n"))


@query(
    "class_weights",
    using(
        "base",
        f"""select is_env_optimal, class_rows, round(case when share < 0.1 or share > 0.9
              then cast(total as double) / (2 * class_rows) else 1.0 end + 1.3e-8, 6) as weight
            from (select {_LABEL_SQL} as is_env_optimal, count(*) as class_rows,
              sum(count(*)) over () as total,
              sum(case when {_LABEL_SQL} = 1 then count(*) else 0 end) over () / sum(count(*)) over () as share
              from base group by 1)""",
    ),
)
def _(t: Tables):
    return rounded(class_weights(env_label(t.base)))


def _stats_sql(*pairs: tuple[str, str]) -> str:
    """One row of statistics of every input, by prefix and function."""
    return "(select " + ", ".join(f"cast({f}({c}) as double) as {p}_{c}" for p, f in pairs for c in _SCALED) + " from base)"


def _score_sql(c: str) -> str:
    return f"({c} - m_{c}) / (case when s_{c} = 0 then 1 else s_{c} end)"


_MOMENTS = _stats_sql(("m", "avg"), ("s", "stddev_pop"))


@query(
    "scale_standard",
    using(
        "base",
        f"select {_KEYS}, " + ", ".join(f"round({_score_sql(c)} + 1.3e-8, 6) as {c}" for c in _SCALED) + f" from base, {_MOMENTS}",
    ),
)
def _(t: Tables):
    rows = t.base.select("reading_id", "timestamp", *_SCALED)
    return rounded(scale_standard(rows, _SCALED, standard_stats(rows, _SCALED)))


_WEIGHT_SQL = """select *, greatest(0, least(position, cast(floor((n - 24) * 0.8e0) as bigint) - 1)
  - greatest(0, position - 23) + 1) as w
  from (select *, (select count(*) from numbered) as n from numbered)"""


def _present_sql(c: str, over: str = "") -> str:
    """Weight of the rows that have a value."""
    return f"sum(case when {c} is not null then w end) {over}"


@query(
    "scale_standard_windows",
    using(
        "numbered",
        "select "
        + ", ".join(f"round(sum(w * {c}) / {_present_sql(c)} + 1.3e-8, 6) as mean_{c}" for c in _SCALED)
        + ", "
        + ", ".join(
            f"round(sqrt(sum(w * ({c} - m_{c}) * ({c} - m_{c})) / {_present_sql(c)}) + 1.3e-8, 6) as std_{c}" for c in _SCALED
        )
        + " from (select *, "
        + ", ".join(f"sum(w * {c}) over () / {_present_sql(c, 'over ()')} as m_{c}" for c in _SCALED)
        + f" from ({_WEIGHT_SQL}))",
    ),
)
def _(t: Tables):
    """Statistics over overlapping training windows without building the windows."""
    numbered = t.numbered(*_SCALED)
    windows = F.floor((numbered.count() - 24) * F.lit(0.8))
    return rounded(standard_stats(numbered, _SCALED, window_weight(F.col("position"), windows, 24)))


@query(
    "scale_minmax",
    using(
        "base",
        f"select {_KEYS}, "
        + ", ".join(
            f"round(({c} - l_{c}) / (case when h_{c} = l_{c} then 1 else h_{c} - l_{c} end) + 1.3e-8, 6) as {c}"
            for c in _SCALED
        )
        + f" from base, {_stats_sql(('l', 'min'), ('h', 'max'))}",
    ),
)
def _(t: Tables):
    rows = t.base.select("reading_id", "timestamp", *_SCALED)
    return rounded(scale_minmax(rows, _SCALED, minmax_stats(rows, _SCALED)))


@query(
    "scale_inference",
    using(
        "numbered",
        f"select {_KEYS}, "
        + ", ".join(f"round(({c} - m_{c}) / (s_{c} + 1e-8) + 1.3e-8, 6) as {c}" for c in _SCALED)
        + " from (select *, "
        + ", ".join(
            f"sqrt(sum(w * ({c} - m_{c}) * ({c} - m_{c})) over () / ({_present_sql(c, 'over ()')} - 1)) as s_{c}"
            for c in _SCALED
        )
        + " from (select *, "
        + ", ".join(f"sum(w * {c}) over () / {_present_sql(c, 'over ()')} as m_{c}" for c in _SCALED)
        + """ from (select *, greatest(0, least(position, n - 25) - greatest(0, position - 23) + 1) as w
             from (select *, (select count(*) from numbered) as n from numbered))))""",
    ),
)
def _(t: Tables):
    """The scored batch's own statistics, each row counted once per window."""
    numbered = t.numbered(*_SCALED)
    weight = window_weight(F.col("position"), numbered.count() - 24, 24)
    stats = standard_stats(numbered, _SCALED, weight, sample=True)
    rows = numbered.select("reading_id", "timestamp", *_SCALED)
    return rounded(scale_standard(rows, _SCALED, stats, epsilon=1e-8))


@query(
    "inverse_scale",
    using(
        "base",
        f"select {_KEYS}, "
        + ", ".join(f"round({_score_sql(c)} + 1.3e-8, 6) as scaled_{c}, {round6(c)} as {c}" for c in _SCALED)
        + f" from base, {_MOMENTS}",
    ),
)
def _(t: Tables):
    """Scaled values beside those restored from them."""
    rows = t.base.select("reading_id", "timestamp", *_SCALED)
    stats = standard_stats(rows, _SCALED)
    scaled = scale_standard(rows, _SCALED, stats).withColumns({f"scaled_{c}": F.col(c) for c in _SCALED})
    return rounded(inverse_scale(scaled, _SCALED, stats))


# --- metrics on a baseline both engines can compute: the previous pH predicts the next ---

_PAIRS = "select ph_level as y, ph_lag_1 as p from features"


def _pairs(t: Tables):
    return t.features.select(F.col("ph_level").alias("y"), F.col("ph_lag_1").alias("p"))


@query(
    "forecast_metrics",
    using(
        "features",
        f"""select round(avg(abs(y - p)) + 1.3e-8, 6) as mae, round(sqrt(avg((y - p) * (y - p))) + 1.3e-8, 6) as rmse,
            round(avg(case when y <> 0 then abs((y - p) / y) end) * 100 + 1.3e-8, 6) as mape
            from ({_PAIRS}) where y is not null and p is not null""",
    ),
)
def _(t: Tables):
    return rounded(forecast_metrics(_pairs(t), "y", "p"))


@query(
    "regression_metrics",
    using(
        "features",
        f"""select round(avg(abs(y - p)) + 1.3e-8, 6) as mae, round(sqrt(avg((y - p) * (y - p))) + 1.3e-8, 6) as rmse,
            round(1 - sum((y - p) * (y - p)) / (count(*) * var_pop(y)) + 1.3e-8, 6) as r2_score
            from ({_PAIRS}) where y is not null and p is not null""",
    ),
)
def _(t: Tables):
    return rounded(regression_metrics(_pairs(t), "y", "p"))


# A score with ties: humidity in whole percent, mapped to 0..1.
_SCORES = f"select {_LABEL_SQL} as label, floor(air_humidity) / 1e2 as score from base"


def _scores(t: Tables):
    return env_label(t.base).select(
        F.col(LABEL).alias("label"), (F.floor("air_humidity") / F.lit(1e2)).alias("score")
    )


_CELLS = """count(*) filter (label = 0 and score <= 0.5) as true_negatives,
  count(*) filter (label = 0 and score > 0.5) as false_positives,
  count(*) filter (label = 1 and score <= 0.5) as false_negatives,
  count(*) filter (label = 1 and score > 0.5) as true_positives"""


@query(
    "confusion_matrix",
    using(
        "base",
        f"""select {_CELLS}, count(*) filter (label = 0) as actual_0, count(*) filter (label = 1) as actual_1,
            count(*) filter (score <= 0.5) as predicted_0, count(*) filter (score > 0.5) as predicted_1
            from ({_SCORES})""",
    ),
)
def _(t: Tables):
    return confusion_matrix(_scores(t), "label", "score")


@query(
    "classification_metrics",
    using(
        "base",
        f"""select round((true_positives + true_negatives) / (true_positives + true_negatives + false_positives
              + false_negatives) + 1.3e-8, 6) as accuracy,
            round(true_positives / (true_positives + false_positives) + 1.3e-8, 6) as "precision",
            round(true_positives / (true_positives + false_negatives) + 1.3e-8, 6) as recall,
            round(2 * true_positives / (2 * true_positives + false_positives + false_negatives) + 1.3e-8, 6) as f1_score,
            round((rank_sum - pos * (pos + 1) / 2) / (pos * neg) + 1.3e-8, 6) as roc_auc
            from (select {_CELLS} from ({_SCORES})),
              (select cast(sum(avg_rank) filter (label = 1) as double) as rank_sum,
                 cast(count(*) filter (label = 1) as double) as pos, cast(count(*) filter (label = 0) as double) as neg
               from (select label, rank() over (order by score) + (count(*) over (partition by score) - 1) / 2.0
                 as avg_rank from ({_SCORES})))""",
    ),
)
def _(t: Tables):
    return rounded(classification_metrics(_scores(t), "label", "score"))


# --- scoring with models both engines can compute ------------------------------------
# Persistence (last pH of the window), window mean, and the label itself.

_SCORED = f"""select reading_id, "timestamp", position, a as lstm_prediction, b as gru_prediction,
  cast({_LABEL_SQL} as double) as lightgbm_prediction
  from (select *, count(*) over w as n, last_value(tds_level) over w as a, avg(tds_level) over w as b
    from numbered window w as (order by position rows between 24 preceding and 1 preceding)) where n = 24"""
_PREDICTIONS = ["lstm_prediction", "gru_prediction", "lightgbm_prediction"]


def _scored(t: Tables):
    keep = ["reading_id", "timestamp", "position", LABEL]
    rows = env_label(t.numbered("tds_level", *INDICATORS))
    windows = inference_windows(rows, ["tds_level"], 24, keep=keep)
    values = F.transform("x", lambda row: row[0].cast("double"))
    return windows.select(
        "reading_id",
        "timestamp",
        "position",
        F.element_at(values, -1).alias("lstm_prediction"),
        (F.aggregate(values, F.lit(0.0), lambda a, v: a + v) / F.size(values)).alias("gru_prediction"),
        F.col(LABEL).cast("double").alias("lightgbm_prediction"),
    )


@query(
    "ensemble_avg",
    using(
        "numbered",
        f"""select {replace_rounded(_PREDICTIONS)},
            round((lstm_prediction + gru_prediction + lightgbm_prediction) / 3 + 1.3e-8, 6) as ensemble_avg from ({_SCORED})""",
    ),
)
def _(t: Tables):
    average = ensemble_average(*[F.col(n) for n in _PREDICTIONS])
    return rounded(_scored(t).withColumn("ensemble_avg", average))


@query(
    "prediction_stats",
    using(
        "numbered",
        " union all ".join(
            f"select '{n}' as prediction, round(avg({n}) + 1.3e-8, 6) as mean, round(stddev_samp({n}) + 1.3e-8, 6) as std from ({_SCORED})"
            for n in _PREDICTIONS
        ),
    ),
)
def _(t: Tables):
    return rounded(prediction_stats(_scored(t), _PREDICTIONS))


@query(
    "join_predictions",
    using("numbered", f"select reading_id, position, round(lstm_prediction + 1.3e-8, 6) as prediction from ({_SCORED})"),
)
def _(t: Tables):
    """Predictions keyed by sample number, attached to the row after their window."""
    predictions = _scored(t).select(
        (F.col("position") - 24).alias("sample"), F.col("lstm_prediction").alias("prediction")
    )
    joined = join_predictions(t.numbered(), predictions, 24)
    return rounded(joined.select("reading_id", "position", "prediction"))


# --- fitted models --------------------------------------------------------------------


def _series(t: Tables):
    """Stored gapless feature rows, the forecast inputs and the number of rows."""
    series, inputs = feature_series(t.fact)
    series = materialize(series, "series")
    return series, inputs, series.count()


_TEST_ROWS = f"count(*) filter (not ({_bucket_sql(SEED)} >= 200))"


@query(
    "train_gbt",
    using(
        "base",
        f"""select {_TEST_ROWS} as test_rows, cast(29 as integer) as features, cast(0 as bigint) as null_scores,
            cast(0 as bigint) as no_probability from base""",
    ),
)
def _(t: Tables):
    """Boosted trees on the feature table: what must hold of the scores of the test rows."""
    features = materialize(env_label(t.features), "features")
    model, prepared = train_trees(features)
    scored = model.score(prepared.filter("not is_train"), "p").select("p")
    return scored.agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.lit(len(model.features)).alias("features"),
        F.count_if(F.col("p").isNull()).alias("null_scores"),
        F.count_if(~F.col("p").between(0, 1)).alias("no_probability"),
    )


_SAMPLES = "(select count(*) - 24 as samples from base)"


@query(
    "train_forecaster",
    using(
        "numbered",
        f"""select count(*) as test_rows, cast(36 as integer) as features, cast(0 as bigint) as null_forecasts,
            {round6('avg(filled)')} as mean_actual
            from (select position, coalesce(last_value(ph_level ignore nulls) over (order by position
                rows between unbounded preceding and current row), first_value(ph_level ignore nulls) over (order by position
                rows between current row and unbounded following), 0) as filled, count(*) over () - 24 as samples from numbered)
            where position >= 24 + cast(floor(samples * 0.8e0) as bigint)""",
    ),
)
def _(t: Tables):
    """Window forecast of pH from every other numeric feature: what must hold of the test samples."""
    series, inputs, total = _series(t)
    model, tested = train_forecaster(series, inputs, total, SequenceParams(penalty=0.1))
    found = tested.agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.lit(len(model.features)).alias("features"),
        F.count_if(F.col("predicted").isNull() | F.isnan("predicted")).alias("null_forecasts"),
        F.avg("actual").alias("mean_actual"),
    )
    return rounded(found)


_MOMENT_PAIR = ("air_temperature", "ph_level")


def _filled_sql(name: str) -> str:
    return f"""coalesce(last_value({name} ignore nulls) over (order by position rows between unbounded preceding and current row),
        first_value({name} ignore nulls) over (order by position rows between current row and unbounded following), 0) as {name}"""


@query(
    "window_moments",
    using(
        "numbered",
        f"""select step, {round6('avg(x)')} as mean_x, {round6('avg(y)')} as mean_y, {round6('covar_pop(y, x)')} as covariance,
            {round6('regr_slope(y, x)')} as slope, {round6('regr_intercept(y, x)')} as intercept
            from (select cast(step as integer) as step, x.air_temperature as x, y.ph_level as y
                from (select position, {_filled_sql('air_temperature')} from numbered) x
                join range(24) steps(step) on true
                join (select position, {_filled_sql('ph_level')} from numbered) y on y.position = x.position - step + 24
                where x.position >= step
                    and x.position - step < (select cast(floor((count(*) - 24) * 0.8e0) as bigint) from numbered))
            group by step""",
    ),
)
def _(t: Tables):
    """For each step of the training windows: the one-variable fit of the next pH by that step, from window moments."""
    x, y = _MOMENT_PAIR
    rows = t.numbered(x, y)
    series = materialize(fill_gaps(rows, [x, y], ["position"], numbered="position"), "series")
    total = series.count()
    windows = int((total - 24) * 0.8)
    mean, covariance = window_moments(series, [x], y, 24, windows)
    rows = []
    for step in range(24):
        slope = covariance[step, -1] / covariance[step, step]
        fit = (mean[step], mean[-1], covariance[step, -1], slope, mean[-1] - slope * mean[step])
        rows.append((step, *map(float, fit)))
    schema = "step int, mean_x double, mean_y double, covariance double, slope double, intercept double"
    return rounded(t.spark.createDataFrame(rows, schema))


@query(
    "score_batch",
    using(
        "base",
        """select count(*) - 24 as scored_rows, count(*) - 24 as distinct_keys, cast(0 as bigint) as null_predictions,
           cast(0 as bigint) as no_probability, cast(0 as bigint) as wrong_ensembles from base""",
    ),
)
def _(t: Tables):
    """All feature rows scored by two forecasts and the trees: every row once, and the mean of three."""
    series, inputs, total = _series(t)
    trees, _ = train_trees(series)
    first, _ = train_forecaster(series, inputs, total, SequenceParams(penalty=0.1))
    second, _ = train_forecaster(series, inputs, total, SequenceParams(penalty=1.0, mix=0.5))
    scored = score_batch(series, trees, {"lstm_prediction": first, "gru_prediction": second})
    some = F.lit(False)
    for name in _PREDICTIONS:
        some = some | F.col(name).isNull() | F.isnan(name)
    mean = sum((F.col(n) for n in _PREDICTIONS[1:]), F.col(_PREDICTIONS[0])) / 3
    return scored.agg(
        F.count(F.lit(1)).alias("scored_rows"),
        F.count_distinct("reading_id", "timestamp").alias("distinct_keys"),
        F.count_if(some).alias("null_predictions"),
        F.count_if(~F.col("lightgbm_prediction").between(0, 1)).alias("no_probability"),
        F.count_if(~(F.abs(F.col("ensemble_avg") - mean) < 1e-9)).alias("wrong_ensembles"),
    )


def _lagged(rows: int) -> str:
    return f"lag(ph_level, {rows}) over (order by position)"


@query(
    "eval_history",
    using(
        "numbered",
        "select 'persistence' as run, cast(step as integer) as step, name, round(value + 1.3e-8, 6) as value from ("
        + " union all ".join(
            f"select {k} as step, unnest(['mae', 'rmse', 'mape']) as name, unnest([avg(abs(y - p)), sqrt(avg((y - p) * (y - p))),"
            f" avg(case when y <> 0 then abs((y - p) / y) end) * 100]) as value"
            f" from (select ph_level as y, {_lagged(k)} as p from numbered) where y is not null and p is not null"
            for k in (1, 2)
        )
        + ")",
    ),
)
def _(t: Tables):
    """One row for each step and metric: forecasts by the value one and two readings before."""
    stages = ["lag_1", "lag_2"]
    rows = in_chunks(
        t.numbered("ph_level"),
        lambda w: [F.lag("ph_level", k).over(w).alias(name) for k, name in enumerate(stages, 1)],
        len(stages),
    )
    return rounded(staged_log(rows, "ph_level", stages, "persistence"))


@query(
    "score_saved_models",
    using(
        "base",
        """select count(*) - 24 as scored_rows, cast(0 as bigint) as differing_rows,
           cast(0 as bigint) as null_predictions from base""",
    ),
)
def _(t: Tables):
    """Feature, training and scoring jobs with their defaults, through stored features and models.

    The scores of the loaded models are compared with those of the models as they were fitted.
    """
    lake = Lake(scratch_path(t.spark, "lake"))
    features = refresh_features(t.fact, lake)
    trees, forecasts = train_models(features, lake)
    stored = score_features(features, lake)
    here = score_batch(features, trees, forecasts)
    key, value = ["reading_id", "timestamp"], F.col("ensemble_avg")
    both = stored.select(*key, value.alias("a")).join(here.select(*key, value.alias("b")), key, "full")
    off = F.coalesce(F.abs(F.col("a") - F.col("b")) > 1e-9, F.lit(True))
    return both.agg(
        F.count(F.lit(1)).alias("scored_rows"),
        F.sum(off.cast("bigint")).alias("differing_rows"),
        F.sum(F.col("a").isNull().cast("bigint")).alias("null_predictions"),
    )
