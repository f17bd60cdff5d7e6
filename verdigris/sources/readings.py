"""Sensor readings derived from the ``events`` table, in raw (all text) form.

Each event becomes one reading. The recipe plants the defects the cleaning steps must
handle: unparsable times, empty, quoted and out-of-range values, unknown actuator words,
an always-empty actuator, and readings sent a second time in a later ingestion.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def _every(n: int) -> Column:
    return F.col("event_id") % n == 0


def _tenths(expr: Column, step: int, span: int, base: float, scale: float) -> Column:
    """A bounded reading spread over ``span`` steps, as text."""
    return (F.lit(base) + (expr * step % span) / F.lit(scale)).cast("string")


def bronze_from_events(spark: SparkSession, folder: str) -> DataFrame:
    """Bronze rows plus ``device_id``: every event, and the re-sent readings on top."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    kind = F.col("event_type")
    cents = F.round(F.col("value") * F.lit(1e2)).cast("bigint")
    ident = F.col("event_id").cast("string").alias("id")
    second = F.date_trunc("second", "ts").cast("string")
    nothing = F.lit(None).cast("string")

    first = events.select(
        ident,
        F.when(_every(103), "not a time").otherwise(second).alias("timestamp"),
        F.when(_every(97), "")
        .when(_every(101), "15.2")
        .when(_every(89), '"6.1"')
        .otherwise(_tenths(cents, 1, 400, 4.0, 1e2))
        .alias("pH"),
        (F.lit(500.0) + cents * 7 % 1000).cast("string").alias("TDS"),
        (cents % 3).cast("string").alias("water_level"),
        F.when(_every(107), "75.0").otherwise(_tenths(cents, 3, 200, 15.0, 1e1)).alias("DHT_temp"),
        _tenths(cents, 11, 600, 30.0, 1e1).alias("DHT_humidity"),
        _tenths(cents, 1, 97, 16.0, 1e1).alias("water_temp"),
        F.when(kind == "click", "ON").when(kind == "view", "OFF").alias("pH_reducer"),
        nothing.alias("add_water"),
        F.when(kind == "purchase", " on ").otherwise("OFF").alias("nutrients_adder"),
        F.when(kind == "signup", "ON").otherwise("OFF").alias("humidifier"),
        F.when(kind.isin("error", "click"), "ON")
        .when(kind.isin("view", "signup"), "OFF")
        .otherwise("n/a")
        .alias("ex_fan"),
        F.col("user_id").alias("device_id"),
        (F.col("ts") + F.expr("interval 1 day")).cast("timestamp").alias("ingestion_timestamp"),
        F.lit("events.parquet").alias("source_file"),
    )
    again = events.filter(_every(50)).select(
        ident,
        second.alias("timestamp"),
        F.lit("5.9").alias("pH"),
        F.lit("900.0").alias("TDS"),
        F.lit("1").alias("water_level"),
        F.lit("22.0").alias("DHT_temp"),
        F.lit("55.0").alias("DHT_humidity"),
        F.lit("20.0").alias("water_temp"),
        F.lit("ON").alias("pH_reducer"),
        nothing.alias("add_water"),
        F.lit("OFF").alias("nutrients_adder"),
        F.lit("OFF").alias("humidifier"),
        F.lit("ON").alias("ex_fan"),
        F.col("user_id").alias("device_id"),
        (F.col("ts") + F.expr("interval 2 day")).cast("timestamp").alias("ingestion_timestamp"),
        F.lit("late.parquet").alias("source_file"),
    )
    return first.unionByName(again)
