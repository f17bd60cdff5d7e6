"""Silver to gold: fact, time dimension, equipment dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from verdigris.functions.calendar import calendar
from verdigris.functions.classify import indicators
from verdigris.schemas import (
    ACTUATOR_NAMES,
    EQUIPMENT_ROWS,
    EQUIPMENT_SCHEMA,
    STANDARD_BANDS,
    BandProfile,
)


def gold_fact(
    silver: DataFrame, bands: BandProfile = STANDARD_BANDS, keep: tuple[str, ...] = ()
) -> DataFrame:
    """One fact row per silver row, with optimality flags."""
    return silver.select(
        F.col("id").alias("reading_id"),
        F.col("timestamp").alias("timestamp_key"),
        F.col("pH").alias("ph_level"),
        F.col("TDS").alias("tds_level"),
        "water_level",
        F.col("DHT_temp").alias("air_temperature"),
        F.col("DHT_humidity").alias("air_humidity"),
        F.col("water_temp").alias("water_temperature"),
        *[F.col(code).alias(fact) for fact, (_, code, _) in ACTUATOR_NAMES.items()],
        *indicators(F.col("pH"), F.col("TDS"), F.col("DHT_temp"), F.col("DHT_humidity"), bands),
        "ingestion_timestamp",
        "source_file",
        *keep,
    )


def dim_time(silver: DataFrame) -> DataFrame:
    """One row per timestamp.

    All attributes derive from the timestamp, so only that column is deduplicated (and
    shuffled); the attributes are computed on the distinct rows.
    """
    keys = silver.select(F.col("timestamp").alias("timestamp_key")).distinct()
    return keys.withColumns(calendar(F.col("timestamp_key")))


def dim_equipment(spark: SparkSession) -> DataFrame:
    """The five actuators."""
    return spark.createDataFrame(EQUIPMENT_ROWS, EQUIPMENT_SCHEMA)
