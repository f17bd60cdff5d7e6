"""Parameterised dashboard reads over the semantic models."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

# KPI targets and the default reference day.
HEALTH_TARGET = 75
EFFICIENCY_TARGET = 80
KPI_REFERENCE_DATE = date(2023, 12, 11)

FACT_READ_COLUMNS = [
    "reading_id",
    "timestamp_key",
    "reading_date",
    "reading_hour",
    "day_name",
    "month_name",
    "day_type",
    "ph_value",
    "tds_value",
    "air_temp_celsius",
    "air_humidity_pct",
    "water_temp_celsius",
    "water_level_pct",
    "ph_reducer_on",
    "add_water_on",
    "nutrients_adder_on",
    "humidifier_on",
    "ex_fan_on",
    "is_ph_optimal",
    "is_tds_optimal",
    "is_temp_optimal",
    "is_humidity_optimal",
    "is_environment_optimal",
    "ph_status",
    "tds_status",
    "temperature_status",
]


def date_range(
    df: DataFrame, start: date | None = None, end: date | None = None, column: str = "reading_date"
) -> DataFrame:
    """Inclusive range; an absent bound is the table's own minimum or maximum.

    Such a bound only removes missing dates, so no extra pass looks it up. Bounds are
    typed literals and reach the file scan; a text date column compares as ISO text.
    """
    key = F.col(column)
    kind = df.schema[column].dataType
    kept = df.filter(key.isNotNull())
    if start is not None:
        kept = kept.filter(key >= F.lit(start).cast(kind))
    if end is not None:
        kept = kept.filter(key <= F.lit(end).cast(kind))
    return kept


def daily_metrics(daily: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """All daily measures, newest first."""
    return date_range(daily, start, end).orderBy(F.desc("reading_date"))


def hourly_metrics(hourly: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """Hourly measures without the standard deviations, newest first."""
    shown = [name for name in hourly.columns if not name.startswith("stddev_")]
    return (
        date_range(hourly, start, end)
        .select(*shown)
        .orderBy(F.desc("reading_date"), F.desc("reading_hour"))
    )


def recent_readings(fct: DataFrame, limit: int = 1000) -> DataFrame:
    """The latest ``limit`` fact rows; ties in time are taken by descending id."""
    return (
        date_range(fct)
        .select(*FACT_READ_COLUMNS)
        .orderBy(F.desc("timestamp_key"), F.desc("reading_id"))
        .limit(limit)
    )


def equipment_usage_stats(
    daily: DataFrame, start: date | None = None, end: date | None = None
) -> DataFrame:
    """Daily readings with each actuator on, newest first."""
    return (
        date_range(daily, start, end)
        .select(
            "reading_date",
            F.col("total_ph_reducer_activations").alias("ph_reducer"),
            F.col("total_water_additions").alias("water_addition"),
            F.col("total_nutrient_additions").alias("nutrients"),
            F.col("total_humidifier_activations").alias("humidifier"),
            F.col("total_fan_activations").alias("exhaust_fan"),
            "total_readings",
        )
        .orderBy(F.desc("reading_date"))
    )


def optimality_trends(
    daily: DataFrame, start: date | None = None, end: date | None = None
) -> DataFrame:
    """Daily optimality averages and the health score, newest first."""
    return (
        date_range(daily, start, end)
        .select(
            "reading_date",
            *[
                F.col(f"avg_{name}_optimality_pct").alias(f"{name}_optimality")
                for name in ("ph", "tds", "temp", "humidity", "environment")
            ],
            "daily_health_score",
        )
        .orderBy(F.desc("reading_date"))
    )


def _reference_day(daily: DataFrame, reference: date) -> DataFrame:
    """The reference day's row if it exists, else the newest one."""
    is_reference = F.col("reading_date") == F.lit(reference)
    return date_range(daily).orderBy(F.desc(is_reference), F.desc("reading_date")).limit(1)


def kpi_snapshot(daily: DataFrame, reference: date = KPI_REFERENCE_DATE) -> DataFrame:
    """Health score, efficiency and readings of the reference day, with target deltas.

    A delta is only given for a positive value.
    """
    score = F.coalesce("daily_health_score", F.lit(0.0))
    efficiency = F.coalesce("daily_environment_efficiency_pct", F.lit(0.0))
    return _reference_day(daily, reference).select(
        "reading_date",
        score.alias("daily_health_score"),
        F.when(score > 0, score - HEALTH_TARGET).alias("health_score_delta"),
        efficiency.alias("daily_environment_efficiency_pct"),
        F.when(efficiency > 0, efficiency - EFFICIENCY_TARGET).alias("efficiency_delta"),
        "total_readings",
    )


def kpi_breakdown(daily: DataFrame, reference: date = KPI_REFERENCE_DATE) -> DataFrame:
    """The four optimality averages and the share of all-optimal readings of that day."""
    total = F.col("total_readings")
    return _reference_day(daily, reference).select(
        "reading_date",
        *[f"avg_{name}_optimality_pct" for name in ("ph", "tds", "temp", "humidity")],
        "total_environment_optimal",
        "total_readings",
        F.when(total > 0, F.col("total_environment_optimal").cast("double") / total * 100).alias(
            "environment_optimality"
        ),
    )


def health_watchlist(health: DataFrame, levels: tuple[str, ...] = ("Poor", "Critical")) -> DataFrame:
    """Readings in the given health levels, newest first."""
    return (
        health.filter(F.col("health_status").isin(*levels))
        .select(
            "reading_id",
            "timestamp_key",
            "health_score",
            "health_status",
            "ph_alert",
            "tds_alert",
            "temp_alert",
            "ph_action_required",
        )
        .orderBy(F.desc("timestamp_key"), F.desc("reading_id"))
    )


def recent_status(fct: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """Status texts of the readings since ``days`` before ``as_of``, newest first."""
    first = F.date_sub(F.lit(as_of), days).cast("string")
    return (
        fct.filter(F.col("reading_date").cast("string") >= first)
        .select(
            "reading_id",
            "timestamp_key",
            "reading_date",
            "ph_value",
            "ph_status",
            "tds_value",
            "tds_status",
            "air_temp_celsius",
            "temperature_status",
            "is_environment_optimal",
        )
        .orderBy(F.desc("timestamp_key"), F.desc("reading_id"))
    )


def hours_of_day(hourly: DataFrame, day: date) -> DataFrame:
    """Hourly pH and optimality of one day, in hour order."""
    return (
        hourly.filter(F.col("reading_date") == F.lit(day))
        .select(
            "reading_date",
            "reading_hour",
            "avg_ph",
            "ph_optimality_pct",
            "environment_optimality_pct",
            "ph_reducer_activations",
        )
        .orderBy("reading_hour")
    )


def recent_days(daily: DataFrame, limit: int | None = None) -> DataFrame:
    """KPIs by day, newest first; ``limit`` keeps the latest days."""
    ordered = (
        daily.select(
            "reading_date",
            "daily_health_score",
            "daily_environment_efficiency_pct",
            "total_environment_optimal",
            "total_readings",
            "daily_avg_ph",
            "daily_avg_tds",
        )
        .orderBy(F.desc("reading_date"))
    )
    return ordered if limit is None else ordered.limit(limit)


def lowercase_columns(df: DataFrame) -> DataFrame:
    """Result columns in lower case, whatever case the source reports."""
    return df.toDF(*[name.lower() for name in df.columns])


def global_bounds(df: DataFrame, column: str = "timestamp_key") -> DataFrame:
    """Earliest and latest value and the row count, in one pass."""
    return df.agg(
        F.min(column).alias("earliest"),
        F.max(column).alias("latest"),
        F.count(F.lit(1)).alias("total_records"),
    )
