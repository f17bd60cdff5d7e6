"""Lag and rolling features over the ordered readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec, functions as F

from verdigris.functions.cleaning import bool_to_int
from verdigris.operators.ordering import CHUNK_ROWS, in_chunks, number_rows
from verdigris.schemas import ACTUATOR_NAMES, INDICATORS, MEASURES

# Frames count rows, not minutes, and include the current row, so the
# "1h" frame spans 61 rows and the "6h" frame 361.
ROWS_1H = 60
ROWS_6H = 360
BLOCK = 19  # 19 * 19 == ROWS_6H + 1

# measure -> (feature prefix, has previous value and extremes)
ROLLED = {
    "ph_level": ("ph", True),
    "tds_level": ("tds", True),
    "air_temperature": ("temp", True),
    "air_humidity": ("humidity", True),
    "water_temperature": ("water_temp", False),
}

ORDER = ("timestamp", "reading_id")


def base_features(fact: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Keys, raw measures, actuator states and indicators as 0/1/null."""
    return fact.select(
        "reading_id",
        F.col("timestamp_key").alias("timestamp"),
        *MEASURES,
        *[bool_to_int(F.col(name)).alias(state) for name, (_, _, state) in ACTUATOR_NAMES.items()],
        *[bool_to_int(F.col(name)).alias(name) for name in INDICATORS],
        *keep,
    )


def lag_columns(window: WindowSpec) -> list[Column]:
    """Previous value of the four main measures; null on the first row."""
    return [
        F.lag(measure, 1).over(window).alias(f"{prefix}_lag_1")
        for measure, (prefix, full) in ROLLED.items()
        if full
    ]


def short_frame_columns(window: WindowSpec) -> list[Column]:
    """Moving averages, maxima and minima of the short frame. Missing values are skipped;
    frames at the start are partial."""
    short = window.rowsBetween(-ROWS_1H, 0)
    columns = []
    for measure, (prefix, full) in ROLLED.items():
        columns.append(F.avg(measure).over(short).alias(f"{prefix}_avg_1h"))
        if full:
            columns.append(F.max(measure).over(short).alias(f"{prefix}_max_1h"))
            columns.append(F.min(measure).over(short).alias(f"{prefix}_min_1h"))
    return columns


def block_columns(window: WindowSpec) -> list[Column]:
    """Sum and count of the last 19 rows, the building blocks of the long frame."""
    block = window.rowsBetween(-(BLOCK - 1), 0)
    return [
        f(measure).over(block).alias(f"_{kind}_{prefix}")
        for measure, (prefix, _) in ROLLED.items()
        for kind, f in (("sum", F.sum), ("count", F.count))
    ]


def long_frame_columns(strided: WindowSpec) -> list[Column]:
    """Averages of the long frame as 19 blocks of 19 rows.

    A frame of 361 rows costs 361 updates per row and measure. ``strided`` orders every
    19th row behind each other, so 19 blocks that lie end to end are 19 adjacent rows:
    two passes of 19 updates give the same average.
    """
    blocks = strided.rowsBetween(-(BLOCK - 1), 0)
    columns = []
    for prefix, _ in ROLLED.values():
        total = F.sum(f"_sum_{prefix}").over(blocks)
        count = F.sum(f"_count_{prefix}").over(blocks)
        average = total / F.when(count != 0, count)
        columns.append(average.alias(f"{prefix}_avg_6h"))
    return columns


def number_readings(base: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """Readings with their position in (timestamp, id) order."""
    return number_rows(base, [*partition_by, *ORDER])


def lag_features(
    fact: DataFrame, partition_by: Sequence[str] = (), chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Keys and previous values."""
    rows = base_features(fact, partition_by).select(*partition_by, *ORDER, *ROLLED)
    numbered = number_readings(rows, partition_by)
    found = in_chunks(numbered, lag_columns, 1, "position", partition_by, chunk_rows)
    return found.drop("position", *ROLLED)


def _framed(
    numbered: DataFrame, partition_by: Sequence[str], chunk_rows: int, with_lags: bool
) -> DataFrame:
    """Add rolling columns, and lags if asked, in one exchange by chunk."""

    def frames(window: WindowSpec) -> list[Column]:
        lags = lag_columns(window) if with_lags else []
        return [*lags, *short_frame_columns(window), *block_columns(window)]

    return in_chunks(
        numbered,
        frames,
        ROWS_6H,
        "position",
        partition_by,
        chunk_rows,
        stride=BLOCK,
        strided=long_frame_columns,
    )


def rolling_names() -> list[str]:
    """The 18 rolling features, by measure."""
    names = []
    for prefix, full in ROLLED.values():
        kinds = ("avg_1h", "avg_6h", "max_1h", "min_1h") if full else ("avg_1h", "avg_6h")
        names += [f"{prefix}_{kind}" for kind in kinds]
    return names


def rolling_features(
    fact: DataFrame, partition_by: Sequence[str] = (), chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Keys and rolling statistics."""
    rows = base_features(fact, partition_by).select(*partition_by, *ORDER, *ROLLED)
    framed = _framed(number_readings(rows, partition_by), partition_by, chunk_rows, False)
    return framed.select(*partition_by, *ORDER, *rolling_names())


def sensor_features(
    fact: DataFrame,
    partition_by: Sequence[str] = (),
    chunk_rows: int = CHUNK_ROWS,
    position: str | None = None,
) -> DataFrame:
    """The feature table: 2 keys, 6 measures, 5 states, 4 indicators, 4 lags, 18 rolling.

    ``partition_by`` keeps the series of several devices apart; ``position`` keeps the
    global row number under that name.
    """
    base = base_features(fact, partition_by)
    framed = _framed(number_readings(base, partition_by), partition_by, chunk_rows, True)
    lags = [f"{prefix}_lag_1" for prefix, full in ROLLED.values() if full]
    numbered = [F.col("position").alias(position)] if position else []
    return framed.select(*base.columns, *lags, *rolling_names(), *numbered)
