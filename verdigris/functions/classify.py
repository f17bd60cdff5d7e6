"""Rule-based flags, scores and status texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from verdigris.schemas import BandProfile, STANDARD_BANDS

# Status limits and texts.
PH_STATUS = (5.5, 6.5, "Too Acidic", "Too Alkaline")
TDS_STATUS = (800, 1200, "Low Nutrients", "High Nutrients")
TEMPERATURE_STATUS = (20, 30, "Too Cold", "Too Hot")
PH_ACTION = (5.0, 7.0)
TDS_ACTION = (600, 1400)


def range_indicator(value: Column, band: tuple[float, float]) -> Column:
    """Inside the inclusive band; a missing value counts as outside."""
    return F.coalesce(value.between(*band), F.lit(False))


def indicators(
    ph: Column,
    tds: Column,
    temperature: Column,
    humidity: Column,
    bands: BandProfile = STANDARD_BANDS,
) -> list[Column]:
    """The four optimality flags under one band profile."""
    return [
        range_indicator(ph, bands.ph).alias("is_ph_optimal"),
        range_indicator(tds, bands.tds).alias("is_tds_optimal"),
        range_indicator(temperature, bands.temperature).alias("is_temp_optimal"),
        range_indicator(humidity, bands.humidity).alias("is_humidity_optimal"),
    ]


def all_true(*flags: Column) -> Column:
    """True only when every flag is true; null counts as false."""
    return F.coalesce(reduce(lambda a, b: a & b, flags), F.lit(False))


def status_class(value: Column, rule: tuple[float, float, str, str]) -> Column:
    """Low / high / 'Optimal'; a missing value reads as 'Optimal'."""
    low, high, below, above = rule
    return F.when(value < low, below).when(value > high, above).otherwise("Optimal")


def _health_levels(ph: Column, tds: Column, temp: Column, environment: Column) -> list[Column]:
    return [environment, ph & tds & temp, ph & tds, ph | tds]


def health_score(ph: Column, tds: Column, temp: Column, environment: Column) -> Column:
    """100 / 75 / 50 / 25 / 0, first satisfied level wins."""
    best, good, fair, poor = _health_levels(ph, tds, temp, environment)
    return F.when(best, 100).when(good, 75).when(fair, 50).when(poor, 25).otherwise(0)


def health_status(ph: Column, tds: Column, temp: Column, environment: Column) -> Column:
    """Text form of ``health_score``."""
    best, good, fair, poor = _health_levels(ph, tds, temp, environment)
    return (
        F.when(best, "Excellent")
        .when(good, "Good")
        .when(fair, "Fair")
        .when(poor, "Poor")
        .otherwise("Critical")
    )


def alert_flag(optimal: Column) -> Column:
    """1 when known not to be optimal, else 0."""
    return F.when(~optimal, 1).otherwise(0)


def action_flag(value: Column, limits: tuple[float, float]) -> Column:
    """1 when outside the exclusive limits, 0 when inside or missing."""
    low, high = limits
    return F.when((value < low) | (value > high), 1).otherwise(0)


def pct_round(part: Column, total: Column) -> Column:
    """Share in percent, two decimals."""
    return F.round(part.cast("double") / total * 100, 2)
