"""Mean and covariance of flattened sliding windows, without building a window.

Windows of ``length`` rows that start at every position share almost all their products: the
product sum of steps l and m is that of steps 0 and m - l, less the products before position l
and with those behind the last window (a block Toeplitz matrix with corrections at both ends).
So one product sum for each pair of columns and each distance is enough, ``length + 1`` small
matrices for all rows, where flattened windows need ``length`` squared of them.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

CHUNK_ROWS = 65_536


def _lagged_products(numbered: DataFrame, length: int, windows: int, chunk_rows: int) -> DataFrame:
    """One array for each chunk: product sums by distance, and sums, over rows before ``windows``."""
    size = max(chunk_rows, length)
    own = F.floor(F.col("position") / size)
    # The first rows of a chunk also end the one before it.
    heads = (F.col("position") % size < length) & (own > 0)
    copies = F.when(heads, F.array(own, own - 1)).otherwise(F.array(own))
    spread = numbered.select("position", "_z", F.explode(copies).alias("_chunk"))

    def products(key, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("position")
        rows = np.stack(frame["_z"].to_numpy()).astype(np.float64)
        place = frame["position"].to_numpy()
        base = int(np.searchsorted(place, min(windows, (int(key[0]) + 1) * size)))
        if not base:
            return pd.DataFrame({"sums": pd.Series([], dtype=object)})
        sums = [(rows[:base].T @ rows[lag : base + lag]).ravel() for lag in range(length + 1)]
        return pd.DataFrame({"sums": [np.concatenate([*sums, rows[:base].sum(axis=0)])]})

    return spread.groupBy("_chunk").applyInPandas(products, "sums array<double>")


def window_moments(
    numbered: DataFrame, inputs: Sequence[str], target: str, length: int, windows: int, chunk_rows: int = CHUNK_ROWS
) -> tuple[np.ndarray, np.ndarray]:
    """Mean and population covariance of (flattened window, target of the next row).

    ``numbered`` has a dense ``position`` and no gaps; the first ``windows`` windows count.
    The result has ``length * len(inputs) + 1`` columns, whatever the number of rows. A chunk
    leaves its task as sums only, added up per entry before the shuffle.
    """
    columns = [*inputs, target]
    width = len(columns)
    row = F.array(*[F.col(n).cast("double") for n in columns])
    slim = numbered.filter(F.col("position") < windows + length).select("position", row.alias("_z"))
    sums = _lagged_products(slim, length, windows, chunk_rows).select(F.posexplode("sums").alias("entry", "value"))
    # (length + 1) * width^2 + width entries and 2 * length edge rows.
    found = sums.groupBy("entry").agg(F.sum("value").alias("value")).orderBy("entry").collect()
    flat = np.array([r["value"] for r in found], np.float64)
    if len(flat) != (length + 1) * width * width + width or not np.isfinite(flat).all():
        raise ValueError("the series has gaps or is too short")
    at = F.col("position")
    edges = slim.filter((at < length) | (at >= windows)).orderBy("position").collect()
    rows = {r["position"]: np.array(r["_z"], np.float64) for r in edges}

    products = np.zeros((length + 1, width, length + 1, width))
    for lag, current in enumerate(flat[:-width].reshape(length + 1, width, width)):
        for step in range(length + 1 - lag):
            products[step, :, step + lag, :] = current
            products[step + lag, :, step, :] = current.T
            if step + lag < length:
                first, last = step, step + windows
                current = current - np.outer(rows[first], rows[first + lag]) + np.outer(rows[last], rows[last + lag])
    totals = np.zeros((length + 1, width))
    totals[0] = flat[-width:]
    for step in range(length):
        totals[step + 1] = totals[step] - rows[step] + rows[step + windows]

    chosen = np.zeros((length + 1, width), bool)
    chosen[:length, :-1] = True
    chosen[length, -1] = True
    chosen = chosen.ravel()
    mean = totals.ravel()[chosen] / windows
    square = products.reshape(chosen.size, chosen.size)[np.ix_(chosen, chosen)]
    return mean, square / windows - np.outer(mean, mean)


def rows_with_moments(spark: SparkSession, mean: np.ndarray, covariance: np.ndarray) -> DataFrame:
    """``(x, y)`` with exactly this mean and population covariance; ``y`` is the last column.

    Two rows for each principal axis, on both sides of the mean. Every least-squares fit,
    penalised or not, is the same on them as on the rows that the moments came from.
    """
    own = np.diag(covariance)
    # A constant column has rounding errors for a variance; a penalty on its scale would act on them.
    moves = own > 1e-12 * mean**2 + 1e-20 * own.max()
    covariance = np.where(np.outer(moves, moves), (covariance + covariance.T) / 2, 0.0)
    spread, axes = np.linalg.eigh(covariance)
    found = spread > 1e-13 * max(spread.max(), 0.0)
    steps = axes[:, found].T * np.sqrt(spread[found] * max(found.sum(), 1))[:, None]
    steps[:, ~moves] = 0.0
    points = np.concatenate([mean + steps, mean - steps]) if found.any() else mean[None, :]
    return spark.createDataFrame(pa.table({"x": pa.array(list(points[:, :-1]), pa.list_(pa.float64())), "y": points[:, -1]}))
