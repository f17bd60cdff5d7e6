"""Chunked frames equal plain windows, whatever the distribution of the data."""

from __future__ import annotations

import pytest
from pyspark.sql import Window, functions as F

from tests.conftest import plan_of
from verdigris.operators.features import base_features, sensor_features
from verdigris.operators.ordering import in_chunks, number_rows
from verdigris.operators.sequences import fill_gaps


def hot_series(spark, n=4000):
    """A third of the rows share one timestamp; values have gaps."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(500)).otherwise(F.col("id") % 1000).alias("ts"),
        F.col("id"),
        F.when(F.col("id") % 7 != 0, (F.col("id") * 37 % 101) / 4).alias("v"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5).alias("dev"),
    )


def test_positions_are_dense_and_ordered(spark):
    rows = number_rows(hot_series(spark), ["ts", "id"], "p", total="n").collect()
    ordered = sorted(rows, key=lambda r: (r.ts, r.id))
    assert [r.p for r in ordered] == list(range(4000))
    assert {r.n for r in rows} == {4000}


def test_hot_timestamp_is_split(spark):
    """Ranges stay balanced although a third of the rows share a timestamp."""
    from verdigris.operators.ordering import RANGE, store_sorted

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in store_sorted(hot_series(spark), ["ts", "id"]).groupBy(RANGE).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 4 and max(sizes) < 2 * 4000 / 4


@pytest.mark.parametrize("chunk,partition", [(50, []), (64, ["dev"]), (100_000, ["dev"])])
def test_chunked_frames_equal_plain_windows(spark, chunk, partition):
    df = hot_series(spark)

    def frames(w):
        frame = w.rowsBetween(-40, 0)
        return [F.lag("v").over(w).alias("l"), F.avg("v").over(frame).alias("a"), F.count("v").over(frame).alias("c")]

    numbered = number_rows(df, [*partition, "ts", "id"])
    got = {r.id: (r.l, r.a and round(r.a, 9), r.c) for r in in_chunks(numbered, frames, 40, "position", partition, chunk).collect()}
    plain = df.select("*", *frames(Window.partitionBy(*partition).orderBy("ts", "id")))
    want = {r.id: (r.l, r.a and round(r.a, 9), r.c) for r in plain.collect()}
    assert got == want


def test_block_average_equals_361_row_frame(tables):
    got = sensor_features(tables.fact, chunk_rows=400)
    w = Window.orderBy("timestamp", "reading_id").rowsBetween(-360, 0)
    want = base_features(tables.fact).select("reading_id", "timestamp", F.avg("ph_level").over(w).alias("e"))
    bad = got.join(want, ["reading_id", "timestamp"]).filter(~(F.abs(F.col("ph_avg_6h") - F.col("e")) < 1e-9))
    assert got.count() == 973 and bad.count() == 0


def test_no_large_single_partition(tables):
    """The only one-task exchange holds one row per sorted range."""
    plan = plan_of(sensor_features(tables.fact))
    assert plan.count("SinglePartition") <= 2
    for part in plan.split("Exchange SinglePartition")[1:]:
        assert "HashAggregate" in part[:400]
    assert "Python" not in plan


@pytest.mark.parametrize("partitions", ["1", "4", "9"])
def test_fills_cross_range_borders(spark, partitions):
    n = 600
    df = spark.range(n).select(
        "id",
        F.when(F.col("id") % 200 == 150, F.col("id")).alias("sparse"),
        F.lit(None).cast("double").alias("never"),
        F.when(F.col("id") >= 5, F.col("id") % 3).alias("late"),
    )
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = fill_gaps(df, ["sparse", "never", "late"], ["id"], position="p").orderBy("id").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    expected = [150 if i < 350 else 350 if i < 550 else 550 for i in range(n)]
    assert [r.sparse for r in rows] == expected
    assert {r.never for r in rows} == {0.0}
    assert [r.late for r in rows] == [2 if i < 5 else i % 3 for i in range(n)]
    assert [r.p for r in rows] == list(range(n))
