"""Split raw rows by date range, and pack rows into request-sized JSON documents."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from verdigris.functions.cleaning import parse_timestamp
from verdigris.operators.ordering import number_rows
from verdigris.schemas import RAW_COLUMNS
from verdigris.sources.sinks import CSV_OPTIONS


@dataclass(frozen=True)
class Route:
    """An inclusive date range; ``daily`` routes are kept apart per day."""

    name: str
    first: date
    last: date
    daily: bool


# The default ingestion plan.
DEFAULT_ROUTES = (
    Route("batch_backfill", date(2023, 11, 26), date(2023, 12, 19), False),
    Route("incremental_batch", date(2023, 12, 20), date(2023, 12, 23), True),
    Route("api_streaming_replay", date(2023, 12, 24), date(2023, 12, 26), True),
)
OTHER_ROUTE = "other"


def route_by_date(
    raw: DataFrame, routes: tuple[Route, ...] = DEFAULT_ROUTES, column: str = "timestamp"
) -> DataFrame:
    """Add ``route`` and, for daily routes, ``day``.

    Rows whose time is missing, unparsable or in no range go to ``other``. When the scan
    kept malformed lines in ``_corrupt_record``, lines too short to reach the time field
    are left out.
    """
    if "_corrupt_record" in raw.columns:
        short = F.col(column).isNull() & F.col("_corrupt_record").isNotNull()
        raw = raw.filter(~short).drop("_corrupt_record")
    day = F.to_date(parse_timestamp(F.trim(F.col(column), F.lit('"'))))
    route: Column = F.lit(OTHER_ROUTE)
    daily: Column = F.lit(False)
    for rule in reversed(routes):
        inside = day.between(F.lit(rule.first), F.lit(rule.last))
        route = F.when(inside, rule.name).otherwise(route)
        daily = F.when(inside, rule.daily).otherwise(daily)
    return raw.withColumns(
        {"route": route, "day": F.when(daily, F.date_format(day, "yyyy-MM-dd"))}
    )


def write_routes(routed: DataFrame, path: str) -> str:
    """Headed CSV below ``route=.../day=...``.

    The rebalance hint gathers small partitions into few files and splits large ones.
    """
    (
        routed.hint("rebalance", "route", "day")
        .write.mode("overwrite")
        .partitionBy("route", "day")
        .options(**CSV_OPTIONS)
        .csv(path)
    )
    return path


def replay_pack(
    raw: DataFrame,
    order_by: list[str],
    batch_size: int = 1,
    start: int = 0,
    max_records: int | None = None,
) -> DataFrame:
    """Rows to request bodies: ``(request, records, body)``.

    Rows are taken in ``order_by`` order from position ``start``. A batch size of one
    gives bare records, otherwise ``{"records": [...]}``; the last batch may be short.
    ``max_records`` is tested before a batch starts, so a batch that has begun is filled:
    the cap rounds up to whole batches. A group never exceeds ``batch_size`` rows.
    """
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    offset = F.col("_row") - F.lit(start)
    rows = number_rows(raw, order_by, "_row").filter(offset >= 0)
    if max_records:
        taken = -(-max_records // batch_size) * batch_size
        rows = rows.filter(offset < taken)
    record = F.struct(*[F.col(name) for name in RAW_COLUMNS])
    options = {"ignoreNullFields": "false"}
    if batch_size == 1:
        return rows.select(
            offset.alias("request"),
            F.lit(1).alias("records"),
            F.to_json(record, options).alias("body"),
        )
    packed = rows.groupBy(F.floor(offset / batch_size).alias("request")).agg(
        F.sort_array(F.collect_list(F.struct("_row", record.alias("record")))).alias("items")
    )
    return packed.select(
        "request",
        F.size("items").alias("records"),
        F.to_json(F.struct(F.col("items.record").alias("records")), options).alias("body"),
    )


def write_requests(packed: DataFrame, path: str, per_file: int | None = None, mode: str = "overwrite") -> str:
    """Land the bodies as JSON lines, at most ``per_file`` requests to a file."""
    writer = packed.select("body").write.mode(mode)
    if per_file:
        writer = writer.option("maxRecordsPerFile", per_file)
    writer.text(path)
    return path
