"""The batch jobs: ingestion to silver, star schema, semantic models, all of it.

Each layer is written once and read back for the next, so no plan runs twice and a
restarted job can begin at any layer.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from verdigris.operators.features import sensor_features
from verdigris.operators.gold import dim_equipment, dim_time, gold_fact
from verdigris.operators.mlprep import LABEL, env_label, feature_names
from verdigris.operators.models import (
    SequenceParams,
    TreeParams,
    load_model,
    save_model,
    score_batch,
    train_forecaster,
    train_trees,
    window_statistics,
)
from verdigris.operators.semantic import (
    daily_environment_metrics,
    dim_sensor_health,
    fct_sensor_readings,
    int_sensor_metrics,
    stg_iot_data,
)
from verdigris.operators.sequences import fill_gaps
from verdigris.operators.silver import build_silver
from verdigris.schemas import (
    BRONZE_SCHEMA,
    DIM_TIME_SCHEMA,
    EQUIPMENT_SCHEMA,
    FACT_SCHEMA,
    SILVER_SCHEMA,
    require_schema,
)
from verdigris.sources.counted import publish_verified, record_count, recorded_counts, write_counted
from verdigris.sources.scans import ingest_csv, ingest_json
from verdigris.sources.sinks import register_table


# Forecasts the training job fits by default, by the name of their prediction column.
DEFAULT_SEQUENCES = {
    "lstm_prediction": SequenceParams(penalty=0.1),
    "gru_prediction": SequenceParams(penalty=1.0, mix=0.5),
}


@dataclass(frozen=True)
class Lake:
    """Folder layout of one lake, and the database that names its tables."""

    root: str
    database: str | None = None

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def write(
        self, df: DataFrame, layer: str, table: str, mode: str = "overwrite", partition_by: Sequence[str] = ()
    ) -> DataFrame:
        """Store one table, keep the rows its write observed, name it, and read it back."""
        spark, path = df.sparkSession, self.path(layer, table)
        self.record(spark, layer, table, write_counted(df, path, mode, partition_by), mode)
        self.register(spark, layer, table, partition_by)
        return spark.read.parquet(path)

    def record(self, spark: SparkSession, layer: str, table: str, rows: int, mode: str = "overwrite") -> None:
        record_count(spark, f"{self.root}/_counts", f"{layer}.{table}", rows, mode)

    def counts(self, spark: SparkSession) -> DataFrame:
        """(table_name, row_count) of every table, as observed when it was written."""
        return recorded_counts(spark, f"{self.root}/_counts")

    def register(self, spark: SparkSession, layer: str, table: str, partition_by: Sequence[str] = ()) -> None:
        """Make a stored table known by name, if the lake has a database."""
        if self.database:
            register_table(spark, f"{self.database}.{layer}_{table}", self.path(layer, table), partition_by)


def land_bronze(
    spark: SparkSession,
    lake: Lake,
    csv: str | None = None,
    json: str | None = None,
    ingested_at: datetime | None = None,
    json_lines: bool = False,
) -> DataFrame:
    """Append CSV and JSON sources to bronze. Appending twice is absorbed by silver.

    JSON files hold one document each, or ``json_lines``, which can be split.
    """
    now = ingested_at or datetime.now(timezone.utc)
    path = lake.path("bronze", "iot_data")
    for found in (
        ingest_csv(spark, csv, now) if csv else None,
        ingest_json(spark, json, ingested_at=now, multi_line=not json_lines) if json else None,
    ):
        if found is not None:
            lake.write(require_schema(found, BRONZE_SCHEMA), "bronze", "iot_data", "append")
    return spark.read.parquet(path)


def refresh_silver(bronze: DataFrame, lake: Lake, processed_at: datetime | None = None) -> DataFrame:
    """Rewrite silver from bronze."""
    silver = build_silver(bronze, processed_at=processed_at or datetime.now(timezone.utc))
    return lake.write(require_schema(silver, SILVER_SCHEMA), "silver", "iot_data")


def refresh_gold(silver: DataFrame, lake: Lake) -> dict[str, DataFrame]:
    """Rewrite fact and dimensions; the fact is partitioned by day for date pruning."""
    spark = silver.sparkSession
    fact = require_schema(gold_fact(silver), FACT_SCHEMA)
    dated = fact.withColumn("partition_day", F.to_date("timestamp_key"))
    return {
        "iot_data": lake.write(dated, "gold", "iot_data", partition_by=["partition_day"]).select(*fact.columns),
        "dim_time": lake.write(require_schema(dim_time(silver), DIM_TIME_SCHEMA), "gold", "dim_time"),
        "dim_equipment": lake.write(require_schema(dim_equipment(spark), EQUIPMENT_SCHEMA), "gold", "dim_equipment"),
    }


def semantic_models(fact: DataFrame, time_dimension: DataFrame | None = None) -> dict[str, DataFrame]:
    """All semantic models as lazy frames."""
    staged = stg_iot_data(fact)
    hourly = int_sensor_metrics(staged)
    return {
        "stg_iot_data": staged,
        "int_sensor_metrics": hourly,
        "daily_environment_metrics": daily_environment_metrics(hourly),
        "fct_sensor_readings": fct_sensor_readings(staged, time_dimension),
        "dim_sensor_health": dim_sensor_health(staged),
    }


def refresh_semantic(gold: dict[str, DataFrame], lake: Lake) -> dict[str, DataFrame]:
    """Persist the roll-ups and marts; the staging model stays a view.

    The daily model is built from the stored hourly rows. Time attributes are derived
    from the timestamp, since the dimension was built from the same readings.
    """
    models = semantic_models(gold["iot_data"])

    def stored(name: str, df: DataFrame, time: str | None = None) -> DataFrame:
        by = ["partition_day"] if time else []
        dated = df.withColumn("partition_day", F.to_date(time)) if time else df
        return lake.write(dated, "semantic", name, partition_by=by)

    hourly = stored("int_sensor_metrics", models["int_sensor_metrics"])
    return {
        "stg_iot_data": models["stg_iot_data"],
        "int_sensor_metrics": hourly,
        "daily_environment_metrics": stored(
            "daily_environment_metrics", daily_environment_metrics(hourly)
        ),
        # Date reads of the marts filter on the partition column.
        "fct_sensor_readings": stored("fct_sensor_readings", models["fct_sensor_readings"], "timestamp_key"),
        "dim_sensor_health": stored("dim_sensor_health", models["dim_sensor_health"], "timestamp_key"),
    }


def feature_series(fact: DataFrame) -> tuple[DataFrame, list[str]]:
    """Labelled feature rows with ``position`` and no gaps, and all numeric forecast inputs."""
    features = env_label(sensor_features(fact, position="position"))
    inputs = [name for name in feature_names(features, target="ph_level") if name != LABEL]
    return fill_gaps(features, ["ph_level", *inputs], ["position"], numbered="position"), inputs


def refresh_features(fact: DataFrame, lake: Lake) -> DataFrame:
    """Rewrite the stored feature table that training and scoring share."""
    series, _ = feature_series(fact)
    return lake.write(series, "ml", "features")


def train_models(
    features: DataFrame,
    lake: Lake,
    trees: TreeParams = TreeParams(),
    sequences: Mapping[str, SequenceParams] | None = None,
) -> tuple:
    """Fit trees and window forecasts on the stored features and save them with their inputs.

    Returns the trees and the forecasts by the name of their prediction column.
    """
    inputs = [name for name in feature_names(features, target="ph_level") if name != LABEL]
    total = features.count()
    model, _ = train_trees(features, params=trees)
    save_model(features.sparkSession, model, lake.path("models", "lightgbm_prediction"))
    # Fits that differ in penalties only share the pass over the rows.
    forecasts, shared = {}, {}
    for name, params in (sequences or DEFAULT_SEQUENCES).items():
        kind = params.length, params.target
        if kind not in shared:
            shared[kind] = window_statistics(features, inputs, total, *kind)
        forecasts[name], _ = train_forecaster(features, inputs, total, params, statistics=shared[kind])
        save_model(features.sparkSession, forecasts[name], lake.path("models", name))
    return model, forecasts


def score_features(
    features: DataFrame, lake: Lake, sequences: Sequence[str] | None = None, own_stats: bool = False, table: str | None = None
) -> DataFrame:
    """Score the stored features with saved models; write path and, if named, table."""
    spark = features.sparkSession
    trees = load_model(spark, lake.path("models", "lightgbm_prediction"))
    loaded = {name: load_model(spark, lake.path("models", name)) for name in sequences or DEFAULT_SEQUENCES}
    scored = lake.write(score_batch(features, trees, loaded, own_stats=own_stats), "ml", "predictions")
    if table:
        register_table(spark, table, lake.path("ml", "predictions"))
    return scored


def run_all_layers(
    spark: SparkSession, root: str, csv: str | None = None, json: str | None = None, database: str | None = None
) -> DataFrame:
    """Ingest, cleanse, model, publish; returns the rows of every table written.

    With a ``database`` every stored layer is also a named table over its path.
    """
    lake = Lake(root, database)
    bronze = land_bronze(spark, lake, csv, json)
    silver = refresh_silver(bronze, lake)
    gold = refresh_gold(silver, lake)
    refresh_semantic(gold, lake)
    wrong = publish_verified(gold, f"{root}/published")[1].filter("not matches").count()
    if wrong:
        raise RuntimeError(f"{wrong} published tables differ in row count from their source")
    counts = lake.counts(spark)
    # The staging model is a view of the fact, row for row.
    view = counts.filter("table_name = 'gold.iot_data'").select(F.lit("semantic.stg_iot_data"), "row_count")
    return counts.union(view)
