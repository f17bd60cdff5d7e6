"""File-source streams over landed request files, merged by rewriting the days they touch.

``merge`` has the jobs whose writes follow the batch and whose replacements are atomic.

Every job takes its own checkpoint folder, which together with the file source and the
sinks makes the output exactly-once across restarts. Deduplication and roll-ups work
against what is stored for the days a batch touches, not against a watermark: re-sent
readings may arrive a day or more late, and results do not depend on how files are dealt
to batches.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from verdigris.operators.gold import gold_fact
from verdigris.operators.semantic import int_sensor_metrics, stg_iot_data
from verdigris.operators.silver import silver_dedup, silver_project, validate_and_dedup
from verdigris.schemas import ENVELOPE_SCHEMA
from verdigris.session import materialize
from verdigris.sources.scans import add_ingest_metadata, explode_envelope, normalize_strings

MOST_BATCHES = 4
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def read_landed(
    spark: SparkSession,
    path: str,
    source: str = "api_ingestion",
    files_per_batch: int | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Landed JSON lines as a stream of bronze rows. ``files_per_batch`` bounds a batch.

    ``multi_line`` reads one document per file instead; such files cannot be split.
    """
    reader = spark.readStream.schema(ENVELOPE_SCHEMA).option("multiLine", multi_line)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return add_ingest_metadata(normalize_strings(explode_envelope(reader.json(path))), source)


def files_per_batch(spark: SparkSession, path: str, least: int, most_batches: int = MOST_BATCHES) -> int:
    """Files of a micro-batch, ``least`` or more, that deal all landed files to ``most_batches`` at most.

    Every micro-batch plans, commits and merges anew. With batches of a fixed size their number
    grows with the landing, and that cost soon exceeds the work on the rows.
    """
    landed = spark.read.format("binaryFile").load(path).select("path").count()
    return max(least, -(-landed // most_batches))


def clean(bronze: DataFrame) -> DataFrame:
    """Typed, valid rows of one batch, the latest of each key; each field is parsed once."""
    return validate_and_dedup(silver_project(bronze))


def to_parquet(stream: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append-mode Parquet sink."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


@contextmanager
def listed_in_few_tasks(spark: SparkSession):
    """Bounds the tasks that list files by the cores, until the block ends.

    A micro-batch names its files one by one, and Spark lists them again with a task for each
    file, up to this setting. It is read from the session whenever a batch starts.
    """
    usual = spark.conf.get(_LISTING)
    spark.conf.set(_LISTING, min(int(usual), 4 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(_LISTING, usual)


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Process what has landed, then stop."""
    with listed_in_few_tasks(SparkSession.active()):
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
    return query


def _touched_days(batch: DataFrame) -> list:
    """Days of a stored batch: a list as long as the calendar span of its readings at most."""
    return [row.day for row in batch.select("day").distinct().collect()]


def _stored(batch: DataFrame, path: str, days: list) -> DataFrame | None:
    """Rows stored for these days, read through a partition filter; None without a path."""
    try:
        found = batch.sparkSession.read.schema(batch.schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return found.filter(F.col("day").isin(days))


def _with_day(batch: DataFrame) -> DataFrame:
    """One batch, evaluated once and stored in the shared folder."""
    return materialize(batch.withColumn("day", F.to_date("timestamp")), "batch")


def _replace_days(rows: DataFrame, path: str) -> None:
    (
        rows.hint("rebalance", "day")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(path)
    )


def upsert_latest(batch: DataFrame, path: str) -> list:
    """Merge one batch of valid rows into a silver path partitioned by ``day``.

    Only the days the batch touches are read, deduplicated together with the new rows
    and replaced. Applying the same batch twice changes nothing, so a retried batch is
    safe. The merged rows are stored in the shared folder before any day is replaced.
    Returns the days.
    """
    fresh = _with_day(batch)
    days = _touched_days(fresh)
    stored = _stored(fresh, path, days)
    merged = fresh if stored is None else stored.unionByName(fresh)
    _replace_days(materialize(silver_dedup(merged), "upsert"), path)
    return days


def append_first(batch: DataFrame, path: str) -> None:
    """Add the rows of a batch whose key is not stored yet: the first copy to arrive stays.

    New rows join the stored rows of their days, which are then replaced as a whole, so a
    retried batch is safe.
    """
    fresh = _with_day(batch)
    stored = _stored(fresh, path, _touched_days(fresh))
    if stored is None:
        merged = fresh
    else:
        merged = stored.unionByName(fresh.join(stored, ["id", "timestamp"], "left_anti"))
    _replace_days(materialize(merged, "append"), path)


def refresh_hours(spark: SparkSession, silver: str, path: str, days: list) -> None:
    """Roll up the given days of a stored silver path again and replace them."""
    rows = spark.read.parquet(silver).filter(F.col("day").isin(days))
    hours = int_sensor_metrics(stg_iot_data(gold_fact(rows.drop("day"))))
    _replace_days(hours.withColumn("day", F.col("reading_date")), path)


def _for_each_batch(bronze: DataFrame, checkpoint: str, apply) -> DataStreamWriter:
    return (
        bronze.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, _: apply(clean(batch)))
    )


def upsert_stream(bronze: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Keep a silver path at the latest copy of every reading."""
    return _for_each_batch(bronze, checkpoint, lambda rows: upsert_latest(rows, path))


def first_copy_stream(bronze: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Keep a silver path at the first copy of every reading."""
    return _for_each_batch(bronze, checkpoint, lambda rows: append_first(rows, path))


def hourly_stream(bronze: DataFrame, silver: str, path: str, checkpoint: str) -> DataStreamWriter:
    """Keep silver, and the hourly roll-up of all days a batch touches."""

    def apply(rows: DataFrame) -> None:
        days = upsert_latest(rows, silver)
        refresh_hours(rows.sparkSession, silver, path, days)

    return _for_each_batch(bronze, checkpoint, apply)
