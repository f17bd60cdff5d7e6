"""Refresh of all layers by touched days, with a high-water mark of ingested files.

Bronze is append-only. Which of its files were ingested is the offset log of a file stream
over it, kept below the lake; a run takes the files that are new, cleans their rows and finds
the days they touch. Only those days are read from stored silver, deduplicated with the new
rows and rewritten, in silver and in every layer above it: all of them derive a day's rows
from that day's readings alone. Each layer is a versioned day table, so readers see a layer
before or after a refresh, and a refresh that died is taken up again at the layer it reached.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from verdigris.operators.gold import dim_time, gold_fact
from verdigris.operators.semantic import (
    daily_environment_metrics,
    dim_sensor_health,
    fct_sensor_readings,
    int_sensor_metrics,
    stg_iot_data,
)
from verdigris.operators.silver import silver_dedup
from verdigris.schemas import BRONZE_SCHEMA
from verdigris.session import materialize
from verdigris.sources.versions import DAY, DayTable
from verdigris.streaming.jobs import clean, run_available

SILVER = "silver.iot_data"
# Each layer above silver: the one it is built from, how, and the column that has its day.
LAYERS: dict[str, tuple[str, Callable[[DataFrame], DataFrame], str]] = {
    "gold.iot_data": (SILVER, gold_fact, "timestamp_key"),
    "gold.dim_time": (SILVER, dim_time, "timestamp_key"),
    "semantic.int_sensor_metrics": ("gold.iot_data", lambda f: int_sensor_metrics(stg_iot_data(f)), "reading_date"),
    "semantic.daily_environment_metrics": ("semantic.int_sensor_metrics", daily_environment_metrics, "reading_date"),
    "semantic.fct_sensor_readings": ("gold.iot_data", lambda f: fct_sensor_readings(stg_iot_data(f)), "timestamp_key"),
    "semantic.dim_sensor_health": ("gold.iot_data", lambda f: dim_sensor_health(stg_iot_data(f)), "timestamp_key"),
}


@dataclass(frozen=True)
class DailyLake:
    """Versioned layers below one folder, and the bronze files they were built from."""

    spark: SparkSession
    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/iot_data"

    @property
    def progress(self) -> str:
        return f"{self.root}/_progress"

    def table(self, name: str) -> DayTable:
        return DayTable(self.spark, f"{self.root}/{name.replace('.', '/')}")

    def read(self, name: str) -> DataFrame:
        table = self.table(name)
        return table.read(table.head()).drop(DAY)

    def land(self, rows: DataFrame) -> None:
        """Append bronze rows."""
        rows.select(*BRONZE_SCHEMA.names).write.mode("append").parquet(self.bronze)


def _apply(lake: DailyLake, batch: DataFrame, batch_id: int) -> None:
    fresh = clean(batch).withColumn(DAY, F.to_date("timestamp"))
    silver = lake.table(SILVER)
    head = silver.head()
    if not head.applied(batch_id):
        fresh = materialize(fresh, "fresh")
        days = [row.day for row in fresh.select(DAY).distinct().collect()]
        merged = silver.read(head, days).union(fresh) if head.parts else fresh
        head = silver.replace(silver_dedup(merged), days, batch_id, ["timestamp"])
    days = touched_days(lake, batch_id)
    for name, (below, build, time) in LAYERS.items():
        source = lake.table(below)
        rows = build(source.read(source.head(), days).drop(DAY))
        lake.table(name).replace(rows.withColumn(DAY, F.to_date(time)), days, batch_id)


def touched_days(lake: DailyLake, batch: int) -> list[date]:
    """The days that a batch rewrote in silver."""
    return sorted(d for part in lake.table(SILVER).head().parts if part.batch == batch for d in part.days)


def refresh(lake: DailyLake) -> list[date]:
    """Take in the bronze files that are new; returns the days that were rewritten."""
    before = lake.table(SILVER).head()
    stream = lake.spark.readStream.schema(BRONZE_SCHEMA).parquet(lake.bronze)
    run_available(
        stream.writeStream.option("checkpointLocation", lake.progress).foreachBatch(
            lambda batch, batch_id: _apply(lake, batch, batch_id)
        )
    )
    after = lake.table(SILVER).head()
    return touched_days(lake, after.batch) if after.number > before.number else []
