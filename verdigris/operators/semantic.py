"""Semantic models over gold: staging, hourly and daily roll-ups, marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from verdigris.functions.calendar import calendar
from verdigris.functions.classify import (
    PH_ACTION,
    PH_STATUS,
    TDS_ACTION,
    TDS_STATUS,
    TEMPERATURE_STATUS,
    action_flag,
    alert_flag,
    all_true,
    health_score,
    health_status,
    pct_round,
    status_class,
)
from verdigris.functions.cleaning import parse_bool_text
from verdigris.schemas import ACTUATOR_NAMES, INDICATORS, MEASURES

# optimality flag -> prefix of its counts and shares
_OPTIMAL = {
    "is_ph_optimal": "ph",
    "is_tds_optimal": "tds",
    "is_temp_optimal": "temp",
    "is_humidity_optimal": "humidity",
    "is_environment_optimal": "environment",
}
# staging actuator -> hourly count of readings with it on
_ACTIVATIONS = {
    "ph_reducer_on": "ph_reducer_activations",
    "add_water_on": "water_additions",
    "nutrients_adder_on": "nutrient_additions",
    "humidifier_on": "humidifier_activations",
    "ex_fan_on": "fan_activations",
}
_AVERAGES = {
    "ph_level": "ph",
    "tds_level": "tds",
    "air_temperature": "air_temp",
    "air_humidity": "air_humidity",
    "water_temperature": "water_temp",
    "water_level": "water_level",
}
_SPREADS = {"ph_level": "ph", "tds_level": "tds", "air_temperature": "air_temp"}


def conditional_count(flag: Column) -> Column:
    """Rows where the flag is true; null counts as not."""
    return F.count_if(flag)


def stg_iot_data(fact: DataFrame) -> DataFrame:
    """Staging view: flags as booleans, the all-four flag, date and hour.

    Flags that arrive as text (a warehouse load turns nullable booleans into text) are
    parsed; boolean flags pass unchanged.
    """
    kinds = {field.name: field.dataType for field in fact.schema.fields}

    def flag(name: str) -> Column:
        column = F.col(name)
        return column if isinstance(kinds[name], T.BooleanType) else parse_bool_text(column)

    ts = F.col("timestamp_key")
    return fact.select(
        "reading_id",
        "timestamp_key",
        *MEASURES,
        *[flag(name).alias(staged) for name, (staged, _, _) in ACTUATOR_NAMES.items()],
        *[flag(name).alias(name) for name in INDICATORS],
        "ingestion_timestamp",
        "source_file",
        all_true(*[flag(name) for name in INDICATORS]).alias("is_environment_optimal"),
        F.to_date(ts).alias("reading_date"),
        F.hour(ts).alias("reading_hour"),
    )


def stg_passthrough(table: DataFrame, view: str) -> DataFrame:
    """A view over a source table, registered under ``view``."""
    table.createOrReplaceTempView(view)
    return table.sparkSession.table(view)


def hourly_aggregates() -> list[Column]:
    """Aggregates of the hourly roll-up, shared by the batch and the stream job."""
    return [
        *[F.avg(c).alias(f"avg_{n}") for c, n in _AVERAGES.items()],
        *[f(c).alias(f"{p}_{n}") for c, n in _SPREADS.items() for p, f in (("min", F.min), ("max", F.max))],
        *[F.stddev_samp(c).alias(f"stddev_{n}") for c, n in _SPREADS.items()],
        F.count(F.lit(1)).alias("reading_count"),
        *[conditional_count(F.col(c)).alias(f"{n}_optimal_count") for c, n in _OPTIMAL.items()],
        *[conditional_count(F.col(c)).alias(n) for c, n in _ACTIVATIONS.items()],
    ]


def optimality_shares() -> list[Column]:
    """Percentages of the hourly roll-up."""
    return [
        pct_round(F.col(f"{n}_optimal_count"), F.col("reading_count")).alias(f"{n}_optimality_pct")
        for n in _OPTIMAL.values()
    ]


def int_sensor_metrics(staged: DataFrame) -> DataFrame:
    """Hourly roll-up. Aggregation is partial before the shuffle, so a busy hour costs
    one row per task."""
    hourly = staged.groupBy("reading_date", "reading_hour").agg(*hourly_aggregates())
    return hourly.select("*", *optimality_shares())


def hourly_partials(staged: DataFrame) -> DataFrame:
    """Mergeable aggregates of each hour: counts, sums, squared deviations and extremes."""
    return staged.groupBy("reading_date", "reading_hour").agg(
        F.count(F.lit(1)).alias("n"),
        *[f(c).alias(f"{p}_{n}") for c, n in _AVERAGES.items() for p, f in (("count", F.count), ("sum", F.sum))],
        *[(F.var_pop(c) * F.count(c)).alias(f"m2_{n}") for c, n in _SPREADS.items()],
        *[f(c).alias(f"{p}_{n}") for c, n in _SPREADS.items() for p, f in (("min", F.min), ("max", F.max))],
        *[conditional_count(F.col(c)).alias(f"{n}_optimal_count") for c, n in _OPTIMAL.items()],
        *[conditional_count(F.col(c)).alias(n) for c, n in _ACTIVATIONS.items()],
    )


def merge_partials(added: DataFrame, state: DataFrame, key: Sequence[str]) -> DataFrame:
    """The partial aggregates of ``added``, each merged with those ``state`` has for its key.

    Squared deviations of two parts add up with their means' squared distance, weighted
    by both sizes (the pairwise update of Chan, Golub and LeVeque).
    """
    met = added.alias("a").join(state.alias("b"), list(key), "left")
    merged = []  # as text: a batch merges fifty columns, and each call that builds one takes its time
    for name in added.columns:
        a, b = f"a.{name}", f"b.{name}"
        if name in key:
            continue
        if name.startswith("min_"):
            value = f"least({a}, {b})"
        elif name.startswith("max_"):
            value = f"greatest({a}, {b})"
        elif name.startswith("m2_"):
            of = name.removeprefix("m2_")
            na, nb = f"a.count_{of}", f"coalesce(b.count_{of}, 0)"
            apart = f"(a.sum_{of} / nullif({na}, 0) - b.sum_{of} / nullif({nb}, 0))"
            between = f"if({na} > 0 and {nb} > 0, {apart} * {apart} * {na} * {nb} / ({na} + {nb}), 0d)"
            value = f"coalesce({a}, 0d) + coalesce({b}, 0d) + {between}"
        elif name.startswith("sum_"):
            value = f"coalesce({a} + {b}, {a}, {b})"
        else:
            value = f"{a} + coalesce({b}, 0)"
        merged.append(f"{value} as {name}")
    return met.selectExpr(*key, *merged)


def hourly_values(partials: DataFrame) -> DataFrame:
    """The hourly roll-up from partial aggregates, with the columns of ``int_sensor_metrics``."""
    some = lambda n: F.nullif(F.col(f"count_{n}"), F.lit(0))
    hourly = partials.select(
        "reading_date",
        "reading_hour",
        *[(F.col(f"sum_{n}") / some(n)).alias(f"avg_{n}") for n in _AVERAGES.values()],
        *[F.col(f"{p}_{n}") for n in _SPREADS.values() for p in ("min", "max")],
        *[
            F.when(F.col(f"count_{n}") > 1, F.sqrt(F.col(f"m2_{n}") / (F.col(f"count_{n}") - 1))).alias(f"stddev_{n}")
            for n in _SPREADS.values()
        ],
        F.col("n").alias("reading_count"),
        *[F.col(f"{n}_optimal_count") for n in _OPTIMAL.values()],
        *_ACTIVATIONS.values(),
    )
    return hourly.select("*", *optimality_shares())


def daily_environment_metrics(hourly: DataFrame) -> DataFrame:
    """Daily roll-up of the hourly roll-up: averages are unweighted means of hourly means."""
    daily = hourly.groupBy("reading_date").agg(
        *[F.avg(f"avg_{n}").alias(f"daily_avg_{n}") for n in _AVERAGES.values()],
        *[
            f(f"{p}_{n}").alias(f"daily_{p}_{n}")
            for n in _SPREADS.values()
            for p, f in (("min", F.min), ("max", F.max))
        ],
        F.sum("reading_count").alias("total_readings"),
        *[F.sum(f"{n}_optimal_count").alias(f"total_{n}_optimal") for n in _OPTIMAL.values()],
        *[F.sum(n).alias(f"total_{n}") for n in _ACTIVATIONS.values()],
        *[F.avg(f"{n}_optimality_pct").alias(f"avg_{n}_optimality_pct") for n in _OPTIMAL.values()],
        daily_health_score().alias("daily_health_score"),
    )
    efficiency = pct_round(F.col("total_environment_optimal"), F.col("total_readings"))
    return daily.select(
        "*",
        efficiency.alias("daily_environment_efficiency_pct"),
    ).orderBy(F.desc("reading_date"))


def daily_health_score() -> Column:
    """Mean of the four optimality averages of a day's hours, two decimals, half up.

    Hourly shares have two decimals, so the sum is taken in whole hundredths and rounded
    once: exact, whatever the order of summation.
    """
    parts = [F.round(100 * F.col(f"{n}_optimality_pct")).cast("bigint") for n in ("ph", "tds", "temp", "humidity")]
    total = F.sum(parts[0] + parts[1] + parts[2] + parts[3])
    four = 4 * F.count(parts[0])
    return (F.floor((2 * total + four) / (2 * four)) / 100).cast("double")


def fct_sensor_readings(staged: DataFrame, time_dimension: DataFrame | None = None) -> DataFrame:
    """Fact mart: readings, time attributes, status texts.

    With a time dimension this is a left equi-join on the timestamp; both sides grow with
    the data, so the strategy is left to adaptive execution. It can split a hot timestamp
    only if the dimension is a stored table: a dimension computed in the same plan brings
    its own partitioning. Without one the attributes are derived from the timestamp itself, which
    gives the same rows for a dimension built from the same readings and needs no shuffle.
    """
    wanted = ["date", "hour", "day_name", "month_name", "day_type"]
    if time_dimension is None:
        attributes = calendar(F.col("timestamp_key"))
        rows = staged.withColumns({name: attributes[name] for name in wanted})
    else:
        rows = staged.join(time_dimension.select("timestamp_key", *wanted), "timestamp_key", "left")
    return rows.select(
        "reading_id",
        "timestamp_key",
        F.col("date").alias("reading_date"),
        F.col("hour").alias("reading_hour"),
        "day_name",
        "month_name",
        "day_type",
        F.col("ph_level").alias("ph_value"),
        F.col("tds_level").alias("tds_value"),
        F.col("air_temperature").alias("air_temp_celsius"),
        F.col("air_humidity").alias("air_humidity_pct"),
        F.col("water_temperature").alias("water_temp_celsius"),
        F.col("water_level").alias("water_level_pct"),
        *[staged_name for staged_name, _, _ in ACTUATOR_NAMES.values()],
        *INDICATORS,
        "is_environment_optimal",
        status_class(F.col("ph_level"), PH_STATUS).alias("ph_status"),
        status_class(F.col("tds_level"), TDS_STATUS).alias("tds_status"),
        status_class(F.col("air_temperature"), TEMPERATURE_STATUS).alias("temperature_status"),
        "ingestion_timestamp",
        "source_file",
    )


def dim_sensor_health(staged: DataFrame) -> DataFrame:
    """Health mart: score, status, alerts and required actions, one row for each reading.

    Readings are unique by id and time since silver, so no duplicates can arise.
    """
    flags = [F.col(n) for n in ("is_ph_optimal", "is_tds_optimal", "is_temp_optimal")]
    environment = F.col("is_environment_optimal")
    return staged.select(
        "reading_id",
        "timestamp_key",
        health_score(*flags, environment).alias("health_score"),
        health_status(*flags, environment).alias("health_status"),
        *[
            alert_flag(F.col(f"is_{name}_optimal")).alias(f"{name}_alert")
            for name in ("ph", "tds", "temp", "humidity")
        ],
        action_flag(F.col("ph_level"), PH_ACTION).alias("ph_action_required"),
        action_flag(F.col("tds_level"), TDS_ACTION).alias("tds_action_required"),
    )
