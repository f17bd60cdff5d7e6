"""Streaming merges whose writes are in proportion to the batch.

Both targets are versioned day tables. A batch adds the rows it brings; stored rows are not
rewritten. Silver keeps every copy that was the latest of its batch and is resolved to the
latest of all by its readers, or by compaction. Hourly metrics keep mergeable partial
aggregates of each hour (counts, sums, sums of squared deviations, extremes), so a batch
reads the state of the hours it touches and merges its own. An hour in which a reading
replaces a stored copy is aggregated again from its readings: an extreme, and without
rounding errors a deviation, cannot be taken back out of an aggregate.

A batch is known by its id. Silver and hours are committed one after the other; a batch run
again after a failure between the two finds silver as it was before it, by batch.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

from verdigris.operators.gold import gold_fact
from verdigris.operators.semantic import hourly_partials, hourly_values, merge_partials, stg_iot_data
from verdigris.operators.silver import silver_dedup
from verdigris.session import materialize
from verdigris.sources.versions import DAY, DayTable, Version
from verdigris.streaming.jobs import clean

KEY = ["id", "timestamp"]
HOUR = ["reading_date", "reading_hour"]
MOST_RANGES = 200
_HOUR_OF_ROW = "unix_date(to_date(timestamp)) * 24 + hour(timestamp)"
_HOUR_OF_STATE = "unix_date(reading_date) * 24 + reading_hour"


def merge_latest(rows: DataFrame, table: DayTable, batch: int | None = None) -> Version:
    """Add the valid, deduplicated rows of one batch."""
    return table.append(rows.withColumn(DAY, F.to_date("timestamp")), batch, ["timestamp"])


def latest_rows(table: DayTable, version: Version | None = None) -> DataFrame:
    """The latest copy of each reading."""
    return table.merged(version or table.head(), silver_dedup).drop(DAY)


def compact_latest(table: DayTable) -> Version:
    return table.compact(silver_dedup, ["timestamp"])


def latest_stream(bronze: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Keep a versioned silver table at the latest copy of every reading."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        merge_latest(clean(batch), DayTable(batch.sparkSession, path), batch_id)

    return _started(bronze, checkpoint, apply)


def time_ranges(hours: Sequence[datetime], most: int = MOST_RANGES) -> list[tuple[datetime, datetime]]:
    """Ranges [from, to) that cover the given hours, neighbours joined, ``most`` at most."""
    ranges: list[tuple[datetime, datetime]] = []
    step = timedelta(hours=1)
    for hour in sorted(hours):
        if ranges and ranges[-1][1] == hour:
            ranges[-1] = (ranges[-1][0], hour + step)
        else:
            ranges.append((hour, hour + step))
    width = -(-len(ranges) // most) if ranges else 1
    return [(ranges[i][0], ranges[min(i + width, len(ranges)) - 1][1]) for i in range(0, len(ranges), width)]


def _micros(time: datetime) -> str:
    """A collected timestamp as the literal it came from."""
    return f"timestamp_micros({round(time.timestamp() * 1e6)})"


def _in_ranges(ranges: Sequence[tuple[datetime, datetime]]) -> Column:
    """One text to parse: hundreds of columns joined by calls take a second or two to build."""
    spans = [f"(timestamp >= {_micros(start)} and timestamp < {_micros(end)})" for start, end in ranges]
    return F.expr(" or ".join(spans) or "false")


def _partials(rows: DataFrame) -> DataFrame:
    return hourly_partials(stg_iot_data(gold_fact(rows)))


def stored_copies(silver: DayTable, before: Version, fresh: DataFrame) -> tuple[DataFrame, list[date]]:
    """Stored rows of the hours of ``fresh``, read through filters on day and time, and the days."""
    hours = [r.hour for r in fresh.select(F.date_trunc("hour", "timestamp").alias("hour")).distinct().collect()]
    days = sorted({h.date() for h in hours})
    return silver.read(before, days, _in_ranges(time_ranges(hours))), days


def _revised(old: DataFrame, fresh: DataFrame) -> list[int]:
    """Hours in which a reading of ``fresh`` replaces a stored copy, as whole hours since 1970.

    A part of the batch's hours, which ``stored_copies`` collects as well.
    """
    copies = old.join(fresh.select(*KEY), KEY, "left_semi")
    return [r.hour for r in copies.select(F.expr(_HOUR_OF_ROW).alias("hour")).distinct().collect()]


def _among(hour: str, found: Sequence[int]) -> Column:
    return F.expr(f"{hour} in ({', '.join(map(str, found))})")


def merge_hours(fresh: DataFrame, silver: DayTable, hours: DayTable, batch: int | None = None) -> Version:
    """Bring the partial aggregates of the hours of one batch up to date.

    ``fresh`` holds the stored valid rows of the batch, which silver holds as well. All rows to
    aggregate, those of revised hours and the batch's own, go through one aggregation, and what
    a batch does not meet (stored rows, stored hours, revised hours) is not planned: building and
    planning the steps takes longer than a batch's rows do.
    """
    head = hours.head()
    if head.applied(batch):
        return head
    before = silver.head().before(batch)
    if not before.parts and not head.parts:
        rows = _partials(fresh)
    else:
        old, days = stored_copies(silver, before, fresh)
        old = old.select(*fresh.columns)
        revised = _revised(old, fresh)
        if revised:
            again = silver_dedup(old.union(fresh).filter(_among(_HOUR_OF_ROW, revised)))
            fresh = fresh.filter(~_among(_HOUR_OF_ROW, revised)).union(again)
        rows = _partials(fresh)
        if head.parts:
            state = current_hours(hours, head, days)
            if revised:  # aggregated as a whole
                state = state.filter(~_among(_HOUR_OF_STATE, revised))
            rows = merge_partials(rows, state.select(*rows.columns), HOUR).select(*rows.columns)
    # The number tells which state of an hour is the newest.
    rows = rows.withColumns({"version": F.lit(head.number + 1), DAY: F.col("reading_date")})
    return hours.append(rows, batch)


def _newest(states: DataFrame) -> DataFrame:
    columns = [c for c in states.columns if c not in HOUR]
    newest = F.max_by(F.struct(*columns), "version").alias("newest")
    return states.groupBy(*HOUR).agg(newest).select(*HOUR, "newest.*")


def current_hours(hours: DayTable, version: Version | None = None, days: Sequence[date] | None = None) -> DataFrame:
    """The newest partial aggregates of each hour."""
    return hours.merged(version or hours.head(), _newest, days)


def hourly_metrics(hours: DayTable, version: Version | None = None) -> DataFrame:
    """The hourly roll-up, with the columns of the batch job."""
    return hourly_values(current_hours(hours, version))


def hourly_state_stream(bronze: DataFrame, silver: str, path: str, checkpoint: str) -> DataStreamWriter:
    """Keep versioned silver and the hourly partial aggregates."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        table = DayTable(batch.sparkSession, silver)
        rows = clean(batch)
        if table.head().applied(batch_id):
            fresh = materialize(rows, "batch")  # run again: the folder may have been compacted since
        else:
            own = merge_latest(rows, table, batch_id).only(batch_id)
            fresh = table.read(own).select(*rows.columns)  # what was just stored, not a second copy
        merge_hours(fresh, table, DayTable(batch.sparkSession, path), batch_id)

    return _started(bronze, checkpoint, apply)


def _started(bronze: DataFrame, checkpoint: str, apply) -> DataStreamWriter:
    return bronze.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(apply)
