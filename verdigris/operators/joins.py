"""Joins of the fact with its dimensions and with predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from verdigris.schemas import ACTUATOR_NAMES


def join_fact_time(fact: DataFrame, time_dimension: DataFrame, where: Column | None = None) -> DataFrame:
    """Inner join on the timestamp, newest hour first.

    The filter on fact columns is applied below the join by the optimizer.
    """
    joined = fact.join(time_dimension, "timestamp_key")
    if where is not None:
        joined = joined.filter(where)
    return joined.orderBy(F.desc("date"), F.desc("hour"), F.desc("timestamp_key"), "reading_id")


def suboptimal_readings(fact: DataFrame, time_dimension: DataFrame, flag: str = "is_ph_optimal") -> DataFrame:
    """Readings outside one optimal band with their date and hour, newest hour first."""
    joined = join_fact_time(fact, time_dimension, ~F.col(flag))
    return joined.select("reading_id", "date", "hour", "ph_level", flag, "air_temperature")


def equipment_long(fact: DataFrame, equipment: DataFrame) -> DataFrame:
    """One row per reading and actuator, with the equipment attributes.

    The dimension holds one row per actuator (five), hence the broadcast.
    """
    renamed = fact.select(
        "reading_id",
        "timestamp_key",
        *[F.col(name).alias(code) for name, (_, code, _) in ACTUATOR_NAMES.items()],
    )
    codes = [code for _, code, _ in ACTUATOR_NAMES.values()]
    long = renamed.unpivot(["reading_id", "timestamp_key"], codes, "equipment_code", "is_on")
    return long.join(F.broadcast(equipment), "equipment_code")


def equipment_usage(fact: DataFrame, equipment: DataFrame) -> DataFrame:
    """Readings with each actuator on, per day and equipment.

    Counts are taken on the wide rows first, so only daily totals are unpivoted.
    """
    daily = fact.groupBy(F.to_date("timestamp_key").alias("reading_date")).agg(
        F.count(F.lit(1)).alias("readings"),
        *[F.count_if(name).alias(code) for name, (_, code, _) in ACTUATOR_NAMES.items()],
    )
    codes = [code for _, code, _ in ACTUATOR_NAMES.values()]
    long = daily.unpivot(["reading_date", "readings"], codes, "equipment_code", "readings_on")
    return long.join(F.broadcast(equipment), "equipment_code")


def join_predictions(
    numbered: DataFrame, predictions: DataFrame, length: int, position: str = "position"
) -> DataFrame:
    """Attach predictions keyed by ``sample`` to the row right after their window.

    Window ``s`` covers positions ``s .. s+length-1``; rows before the first complete
    window drop out. Both keys are dense row numbers, so the join has no hot key.
    """
    keyed = predictions.withColumn(position, F.col("sample") + length).drop("sample")
    return numbered.join(keyed, position)
