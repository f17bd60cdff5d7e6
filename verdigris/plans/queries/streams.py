"""Streaming jobs run to completion over landed request files."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from verdigris.operators.silver import validate_once
from verdigris.plans.oracle import HOURLY_MEANS, replace_rounded, using
from verdigris.plans.queries.sources import REPLAY_ORDER
from verdigris.plans.registry import Tables, query, rounded
from verdigris.schemas import PHYSICAL_RANGES, RAW_COLUMNS
from verdigris.session import scratch_path
from verdigris.sources.routing import replay_pack, write_requests
from verdigris.sources.versions import DayTable
from verdigris.streaming.event_time import KEY, event_time_stream, never_kept, run_counted
from verdigris.streaming.jobs import (
    MOST_BATCHES,
    files_per_batch,
    first_copy_stream,
    read_landed,
    run_available,
    to_parquet,
)
from verdigris.streaming.merge import hourly_metrics, hourly_state_stream, latest_rows, latest_stream

# Requests of 500 readings, four to a file of JSON lines, two files or more to a micro-batch.
REQUEST_READINGS, FILE_REQUESTS, BATCH_FILES = 500, 4, 2
# A batch of the hourly job stores readings and hours, at a multiple of the other jobs' cost before its first row.
HOURLY_BATCHES = 2
_RAW_SQL = ", ".join(f'"{n}"' for n in RAW_COLUMNS)
_SILVER = (
    "id timestamp pH TDS water_level DHT_temp DHT_humidity water_temp pH_reducer add_water nutrients_adder "
    "humidifier ex_fan"
).split()
_SILVER_SQL = ", ".join(f'"{n}"' for n in _SILVER)


def _land(rows: DataFrame, path: str) -> str:
    packed = replay_pack(rows, REPLAY_ORDER, batch_size=REQUEST_READINGS)
    return write_requests(packed, path, per_file=FILE_REQUESTS, mode="append")


def _dealt(t: Tables, landed: str, most_batches: int = MOST_BATCHES) -> DataFrame:
    files = files_per_batch(t.spark, landed, BATCH_FILES, most_batches)
    return read_landed(t.spark, landed, files_per_batch=files)


def _run_landings(t: Tables, name: str, start, most_batches: int = MOST_BATCHES) -> None:
    """Run a stream over the readings, then restart it over those sent again later."""
    landed = scratch_path(t.spark, f"{name}-landed")
    state = scratch_path(t.spark, f"{name}-state")
    late = F.col("source_file") == "late.parquet"
    for rows in (t.bronze.filter(~late), t.bronze.filter(late)):
        _land(rows, landed)
        run_available(start(_dealt(t, landed, most_batches), state))


@query("stream_json_ingest", using("bronze", f"select {_RAW_SQL}, 'api_ingestion' as source_file from bronze"))
def _(t: Tables):
    landed, path = scratch_path(t.spark, "landed"), scratch_path(t.spark, "ingest")
    stream = _dealt(t, _land(t.bronze, landed))
    run_available(to_parquet(stream, path, scratch_path(t.spark, "ingest-state")))
    return t.spark.read.schema(stream.schema).parquet(path).drop("ingestion_timestamp")


@query(
    "stream_silver_dedup",
    using(
        "valid",
        f"""select {_SILVER_SQL} from (select *, row_number() over (partition by id, "timestamp"
            order by ingestion_timestamp) as copy from valid) where copy = 1""",
    ),
)
def _(t: Tables):
    """The first valid copy of each reading to arrive stays."""
    path = scratch_path(t.spark, "first")
    _run_landings(t, "first", lambda stream, state: first_copy_stream(stream, path, state))
    return t.spark.read.parquet(path).select(*_SILVER)


@query("stream_hourly_metrics", using("hourly", f"select {replace_rounded(HOURLY_MEANS)} from hourly"))
def _(t: Tables):
    """The full batch roll-up, kept as partial aggregates of each hour."""
    path, silver = scratch_path(t.spark, "hours"), scratch_path(t.spark, "hours-silver")
    _run_landings(t, "hours", lambda stream, state: hourly_state_stream(stream, silver, path, state), HOURLY_BATCHES)
    return rounded(hourly_metrics(DayTable(t.spark, path)))


@query("stream_upsert_latest", using("silver", f"select {_SILVER_SQL} from silver"))
def _(t: Tables):
    """The latest copy of each reading, all columns but those of the ingestion itself."""
    path = scratch_path(t.spark, "silver")
    _run_landings(t, "upsert", lambda stream, state: latest_stream(stream, path, state))
    return latest_rows(DayTable(t.spark, path)).select(*_SILVER)


@query(
    "stream_event_time_dedup",
    using(
        "valid",
        """select * from (with v as (select id, "timestamp", source_file = 'late.parquet' as again from valid),
           w as (select max("timestamp") - interval 1 hour as mark from v where not again),
           judged as (select v.*, again and "timestamp" <= mark as late from v, w),
           kept as (select distinct id, "timestamp" from judged where not late),
           n as (select (select count(*) from v) as every, (select count(*) from kept) as kept,
             (select count(*) from judged where late) as late)
           select 'kept' as outcome, kept as readings from n
           union all select 'late', late from n
           union all select 'repeated', every - kept - late from n
           union all select 'never_kept', count(*) from v anti join kept using (id, "timestamp"))""",
    ),
)
def _(t: Tables):
    """What became of each valid row: kept, repeated within an hour, late; and readings lost to lateness."""
    landed, path, state, counts = (scratch_path(t.spark, f"timed-{n}") for n in ("landed", "rows", "state", "counts"))
    late = F.col("source_file") == "late.parquet"
    for rows in (t.bronze.filter(~late), t.bronze.filter(late)):
        _land(rows, landed)
        run_counted(t.spark, event_time_stream(read_landed(t.spark, landed), path, state), counts)
    found = t.spark.read.parquet(counts).agg(*[F.sum(n).alias(n) for n in ("kept", "late", "repeated")])
    found = found.unpivot([], ["kept", "late", "repeated"], "outcome", "readings")
    judged = validate_once(t.typed.select(*KEY, *PHYSICAL_RANGES))
    lost = never_kept(judged, t.spark.read.parquet(path))
    return found.union(lost.agg(F.lit("never_kept"), F.count(F.lit(1))))
