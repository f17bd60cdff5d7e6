"""Sliding windows, gap filling and chronological splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from verdigris.operators.ordering import (
    CHUNK_ROWS,
    RANGE,
    SLOT,
    dense_position,
    in_chunks,
    store_sorted,
)
from verdigris.session import materialize

RANGE_ROWS = 32_768


def sequence_windows(
    numbered: DataFrame,
    inputs: Sequence[str],
    length: int,
    target: str | Sequence[str] | None = None,
    horizon: int = 1,
    position: str = "position",
    keep: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``(sample, x, y)``: ``length`` consecutive rows and the ``horizon`` rows after them.

    Rows are labelled by their last target row, so a sample only looks back and needs no
    second halo. N rows give N - length - horizon + 1 samples. ``x`` is an array of rows,
    each an array of ``inputs``; a single target column is left out of the inputs. ``y``
    is a value for horizon 1, else an array; without a target it predicts all inputs.
    The windows multiply the data by ``length``: build them right before they are used.
    """
    if length < 1 or horizon < 1:
        raise ValueError("length and horizon must be at least 1")
    columns = [name for name in inputs if name != target]
    row = F.array(*[F.col(name).cast("double") for name in columns])
    if target is None:
        goal: Column = row
    elif isinstance(target, str):
        goal = F.col(target).cast("double")
    else:
        goal = F.array(*[F.col(name).cast("double") for name in target])
    span = length + horizon - 1

    # Both sides are wrapped in a struct because collect_list skips nulls.
    def frames(window):
        past = window.rowsBetween(-span, -horizon)
        ahead = window.rowsBetween(-(horizon - 1), 0)
        return [
            F.collect_list(F.struct(F.col("_x").alias("v"))).over(past).alias("_past"),
            F.collect_list(F.struct(F.col("_y").alias("v"))).over(ahead).alias("_ahead"),
        ]

    slim = numbered.select(
        position, *partition_by, *keep, row.alias("_x"), goal.alias("_y")
    )
    framed = in_chunks(slim, frames, span, position, partition_by, chunk_rows)
    y = F.col("_ahead.v")
    return framed.filter(F.size("_past") == length).select(
        *partition_by,
        *keep,
        (F.col(position) - span).alias("sample"),
        F.col("_past.v").alias("x"),
        (y[0] if horizon == 1 else y).alias("y"),
    )


def inference_row(inputs: Sequence[str]) -> Column:
    """A row's inputs as 32-bit values with gaps set to 0."""
    return F.array(*[F.coalesce(F.col(n).cast("float"), F.lit(0).cast("float")) for n in inputs])


def inference_windows(
    numbered: DataFrame,
    inputs: Sequence[str],
    length: int,
    position: str = "position",
    keep: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """The ``length`` rows before each row, as 32-bit values with gaps set to 0.

    N rows give N - length windows. Each stays on the row it predicts, so scoring
    needs no join back; ``sample`` is the position of its first row.
    """
    slim = numbered.select(position, *partition_by, *keep, inference_row(inputs).alias("_x"))

    def frames(window):
        return [F.collect_list("_x").over(window.rowsBetween(-length, -1)).alias("x")]

    framed = in_chunks(slim, frames, length, position, partition_by, chunk_rows)
    return framed.filter(F.size("x") == length).select(
        *partition_by, *keep, (F.col(position) - length).alias("sample"), "x"
    )


def fill_gaps(
    df: DataFrame,
    columns: Sequence[str],
    order_by: Sequence[str],
    default: float = 0,
    position: str | None = None,
    numbered: str | None = None,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Last value before, else next value after, else ``default``.

    Fills may reach arbitrarily far, so no halo suffices. Each sorted range is filled on
    its own; the last and first value of every range (one row per range) are carried
    over to its neighbours. A backward fill is a running fill in descending order.
    ``position`` adds the dense row number, which the same sort provides. Rows that carry
    theirs already (``numbered``) need no sort: a range is ``range_rows`` positions.
    """
    if numbered:
        place = F.col(numbered)
        stored = materialize(df, "numbered").withColumns({SLOT: place, RANGE: F.floor(place / range_rows)})
    else:
        stored = store_sorted(df, order_by)

    def edge(pick, name: str) -> Column:
        return pick(name, F.when(F.col(name).isNotNull(), F.col(SLOT)))

    edges = stored.groupBy(RANGE).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[edge(F.max_by, name).alias(f"_last_{name}") for name in columns],
        *[edge(F.min_by, name).alias(f"_first_{name}") for name in columns],
    )
    earlier = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    later = Window.orderBy(F.desc(RANGE)).rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.select(
        RANGE,
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        *[F.last(f"_last_{name}", True).over(earlier).alias(f"_before_{name}") for name in columns],
        *[F.last(f"_first_{name}", True).over(later).alias(f"_after_{name}") for name in columns],
    )
    running = (Window.unboundedPreceding, 0)
    forward = Window.partitionBy(RANGE).orderBy(SLOT).rowsBetween(*running)
    backward = Window.partitionBy(RANGE).orderBy(F.desc(SLOT)).rowsBetween(*running)
    kinds = {field.name: field.dataType for field in df.schema.fields}

    def filled(name: str) -> Column:
        return F.coalesce(
            F.col(f"_ffill_{name}"),
            F.col(f"_before_{name}"),
            F.col(f"_bfill_{name}"),
            F.col(f"_after_{name}"),
            F.lit(default).cast(kinds[name]),
        ).alias(name)

    # One carried row per sorted range: the sort's partition count bounds the broadcast.
    result = stored.select(
        "*",
        *[F.last(name, True).over(forward).alias(f"_ffill_{name}") for name in columns],
        *[F.last(name, True).over(backward).alias(f"_bfill_{name}") for name in columns],
    ).join(F.broadcast(carried), RANGE)
    added = [dense_position().alias(position)] if position else []
    return result.select(
        *[filled(name) if name in columns else F.col(name) for name in df.columns], *added
    )


def split_index(samples: Column | int, share: float = 0.8) -> Column:
    """Number of leading samples in the training part."""
    count = samples if isinstance(samples, Column) else F.lit(samples)
    return F.floor(count * F.lit(share)).cast("bigint")


def chrono_split(
    samples: DataFrame, total: Column | int, share: float = 0.8, index: str = "sample"
) -> DataFrame:
    """Mark the first ``share`` of the ordered samples as training rows."""
    return samples.withColumn("is_train", F.col(index) < split_index(total, share))


def window_weight(position: Column, windows: Column | int, length: int) -> Column:
    """In how many of the first ``windows`` windows a row occurs."""
    count = windows if isinstance(windows, Column) else F.lit(windows)
    first = F.greatest(F.lit(0), position - (length - 1))
    last = F.least(position, count - 1)
    return F.greatest(F.lit(0), last - first + 1)
