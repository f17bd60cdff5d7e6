"""Registry of queries and the SQL that must give the same result."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from verdigris.operators.features import ORDER, base_features, number_readings, sensor_features
from verdigris.operators.gold import dim_equipment, dim_time, gold_fact
from verdigris.operators.semantic import (
    daily_environment_metrics,
    dim_sensor_health,
    fct_sensor_readings,
    int_sensor_metrics,
    stg_iot_data,
)
from verdigris.operators.silver import build_silver, silver_project, silver_validate
from verdigris.session import materialize, use_utc
from verdigris.sources.readings import bronze_from_events


class Tables:
    """Lazy layers over one data folder; nothing runs until a query asks for it."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = use_utc(spark)
        self.folder = folder

    @cached_property
    def bronze(self) -> DataFrame:
        return bronze_from_events(self.spark, self.folder)

    @cached_property
    def typed(self) -> DataFrame:
        return silver_project(self.bronze)

    @cached_property
    def valid(self) -> DataFrame:
        return silver_validate(self.typed)

    @cached_property
    def silver(self) -> DataFrame:
        return build_silver(self.bronze)

    @cached_property
    def fact(self) -> DataFrame:
        return gold_fact(self.silver)

    @cached_property
    def stored_silver(self) -> DataFrame:
        """Silver written once, for queries that read it more than once."""
        return materialize(self.silver, "silver")

    @cached_property
    def stored_time(self) -> DataFrame:
        """The time dimension as a table: a join with it starts from a scan on both sides,
        so that adaptive execution can split a hot timestamp."""
        return materialize(dim_time(self.stored_silver), "dim-time")

    @cached_property
    def device_fact(self) -> DataFrame:
        return gold_fact(build_silver(self.bronze, keep=("device_id",)), keep=("device_id",))

    @cached_property
    def time(self) -> DataFrame:
        return dim_time(self.silver)

    @cached_property
    def equipment(self) -> DataFrame:
        return dim_equipment(self.spark)

    @cached_property
    def staged(self) -> DataFrame:
        return stg_iot_data(self.fact)

    @cached_property
    def hourly(self) -> DataFrame:
        return int_sensor_metrics(self.staged)

    @cached_property
    def daily(self) -> DataFrame:
        return daily_environment_metrics(self.hourly)

    @cached_property
    def fct(self) -> DataFrame:
        return fct_sensor_readings(self.staged)

    @cached_property
    def health(self) -> DataFrame:
        return dim_sensor_health(self.staged)

    @cached_property
    def features(self) -> DataFrame:
        return sensor_features(self.fact)

    @cached_property
    def base(self) -> DataFrame:
        return base_features(self.fact)

    def numbered(self, *columns: str) -> DataFrame:
        """Keys, the given feature columns and the position; only these are stored."""
        return number_readings(self.base.select(*ORDER, *columns))


    def from_stored_silver(self) -> Tables:
        """The same tables, every layer above silver starting from silver stored once."""
        self.silver = self.stored_silver
        return self


BUILDERS: dict[str, Callable[[Tables], DataFrame]] = {}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables``, with its SQL where the result has one."""

    def add(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        BUILDERS[name] = build
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


# Means of values with few decimals often lie exactly on a rounding tie, where the last
# bit of the sum decides. Both engines add this before rounding, which moves ties off it.
TIE_NUDGE = 1.3e-8


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Floating columns rounded: summation order differs between engines in the last bits."""
    kinds = (T.DoubleType, T.FloatType)
    return df.select(
        *[
            F.round(F.col(f.name).cast("double") + F.lit(TIE_NUDGE), digits).alias(f.name)
            if isinstance(f.dataType, kinds)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
