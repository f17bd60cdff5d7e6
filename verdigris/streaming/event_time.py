"""Deduplication by event-time state, with a bound on lateness and every late row counted.

State holds a key for as long as its reading may be sent again: ``lateness`` behind the latest
event time. Its size follows that span and not the history. Rows beyond the bound are dropped
by the stateful operator; how many, and how many repeated a key in state, is kept for every
micro-batch beside the output, so kept, repeated and late rows add up to all valid rows. For a
span of more than some million keys set the RocksDB state store.

The first copy that arrives in time stays. Where copies may come any number of days late,
``jobs.first_copy_stream`` keeps them apart without a bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from verdigris.operators.silver import silver_project, validate_once
from verdigris.streaming.jobs import listed_in_few_tasks

KEY = ["id", "timestamp"]
LATENESS = "1 hour"
COUNTS_SCHEMA = "batch long, kept long, repeated long, late long, watermark string"


def first_in_time(bronze: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """The first valid copy of each reading, within the bound on lateness."""
    valid = validate_once(silver_project(bronze))
    return valid.withWatermark("timestamp", lateness).dropDuplicatesWithinWatermark(KEY)


def event_time_stream(bronze: DataFrame, path: str, checkpoint: str, lateness: str = LATENESS) -> DataStreamWriter:
    """Append the first copies to a silver path partitioned by day."""
    return (
        first_in_time(bronze, lateness)
        .withColumn("day", F.to_date("timestamp"))
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("day")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def _outcome(progress) -> tuple:
    state = progress["stateOperators"][0]
    return (
        progress["batchId"],
        state["numRowsUpdated"],
        state["customMetrics"]["numDroppedDuplicateRows"],
        state["numRowsDroppedByWatermark"],
        progress["eventTime"].get("watermark"),
    )


def run_counted(spark: SparkSession, writer: DataStreamWriter, counts: str) -> StreamingQuery:
    """Process what has landed, then append the outcome of each micro-batch to ``counts``."""
    found: dict[int, tuple] = {}
    ended = False
    with listed_in_few_tasks(spark):
        query = writer.trigger(availableNow=True).start()
        while not ended:  # only the last hundred reports are kept for a query
            ended = query.awaitTermination(1)
            found |= {row[0]: row for p in query.recentProgress if p["stateOperators"] for row in [_outcome(p)]}
    rows = spark.createDataFrame([found[batch] for batch in sorted(found)], COUNTS_SCHEMA)
    rows.coalesce(1).write.mode("append").parquet(counts)
    return query


def never_kept(valid: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of readings of which no copy came in time."""
    return valid.join(kept.select(*KEY), KEY, "left_anti")
