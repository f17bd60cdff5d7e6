"""Dense global positions and fixed-size chunks of an ordered table.

Row-count frames over a whole table need a total order but must not run in one task.
The table is range-sorted once on a unique key and stored; a row's position is its index
inside its range plus the number of rows in earlier ranges. Frames then run per chunk of
consecutive positions, each chunk preceded by a copy of the rows its frames reach back
to. Ranges come from a sample of the full sort key and chunks have a fixed number of
rows, so a time span (or one single timestamp) that holds much of the data is split like
any other.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from verdigris.session import materialize

# ``monotonically_increasing_id`` keeps the partition number above bit 33.
_SHIFT = 33
_MASK = (1 << _SHIFT) - 1

CHUNK_ROWS = 3_600

SLOT = "_slot"
RANGE = "_range"


def store_sorted(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Range-sort and store; ``_slot`` grows in sort order, ``_range`` is the sorted part.

    ``order_by`` must identify rows, otherwise ties take an arbitrary (but stored) order.
    """
    tagged = df.orderBy(*order_by).withColumn(SLOT, F.monotonically_increasing_id())
    stored = materialize(tagged, "sorted")
    return stored.withColumn(RANGE, F.shiftright(SLOT, _SHIFT))


def range_offsets(stored: DataFrame) -> DataFrame:
    """Rows before each range and in total: one row per range.

    The number of ranges is the partition count of the sort, not a function of the row
    count, so this table is small enough for one task and for broadcasting.
    """
    before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(RANGE).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    return (
        stored.groupBy(RANGE)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(
            RANGE,
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
            F.sum("_rows").over(whole).alias("_total"),
        )
    )


def dense_position() -> Column:
    """Position of a stored row once the rows before its range (``_before``) are joined."""
    return F.col("_before") + F.col(SLOT).bitwiseAND(_MASK)


def number_rows(
    df: DataFrame, order_by: Sequence[str], name: str = "position", total: str | None = None
) -> DataFrame:
    """Add the dense 0-based position in ``order_by`` order, and optionally the row count."""
    stored = store_sorted(df, order_by)
    columns = [*df.columns, dense_position().alias(name)]
    if total:
        columns.append(F.col("_total").alias(total))
    return stored.join(F.broadcast(range_offsets(stored)), RANGE).select(*columns)


def in_chunks(
    numbered: DataFrame,
    frames: Callable[[WindowSpec], Sequence[Column]],
    reach: int,
    position: str = "position",
    partition_by: Sequence[str] = (),
    chunk_rows: int = CHUNK_ROWS,
    stride: int = 1,
    strided: Callable[[WindowSpec], Sequence[Column]] | None = None,
) -> DataFrame:
    """Evaluate frame expressions that look back at most ``reach`` rows.

    ``frames`` receives the ordered window and returns the columns to add. ``strided``
    may add columns computed from those, over a window in which each row follows the one
    ``stride`` positions before it; it reuses the exchange and only sorts again. With
    ``partition_by`` frames stop at partition borders; positions must then be numbered
    with the partition columns first in the order.
    """
    size = max(chunk_rows, reach, 1)
    row = F.col(position)
    own = F.floor(row / size)
    copies = F.when(row % size >= size - reach, F.array(own, own + 1)).otherwise(F.array(own))
    keys = [*partition_by, "_chunk"]
    spread = numbered.select("*", own.alias("_own"), F.explode(copies).alias("_chunk"))
    framed = spread.select("*", *frames(Window.partitionBy(*keys).orderBy(position)))
    if strided is not None:
        framed = framed.withColumn("_lane", row % stride)
        lanes = Window.partitionBy(*keys, "_lane").orderBy(position)
        framed = framed.select("*", *strided(lanes)).drop("_lane")
    return framed.filter(F.col("_chunk") == F.col("_own")).drop("_own", "_chunk")
