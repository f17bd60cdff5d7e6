"""Row counts are observed during writes; each source plan runs once."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from verdigris.operators.silver import silver_dedup
from verdigris.plans.batch import Lake, refresh_gold, refresh_silver
from verdigris.sources.counted import (
    count_while_writing,
    publish_verified,
    recorded_counts,
    seen,
    stored_rows,
    watch,
    write_counted,
)


@pytest.fixture
def evaluations(spark):
    """A frame of ten rows that counts how often it is evaluated."""
    total = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def touch(value):
        total.add(1)
        return value

    return spark.range(10).repartition(3).select(touch.asNondeterministic()("id").alias("id")), total


def test_a_write_counts_its_rows_in_the_same_run(evaluations, fresh):
    df, total = evaluations
    assert write_counted(df, fresh()) == 10
    assert total.value == 10


def test_publishing_reads_each_source_once(evaluations, spark, fresh):
    df, total = evaluations
    paths, report = publish_verified({"a": df}, fresh())
    assert [tuple(r) for r in report.collect()] == [("a", 10, 10, True)]
    assert total.value == 10 and stored_rows(spark, paths["a"]) == 10


def test_rows_before_and_after_one_step(evaluations, fresh):
    df, total = evaluations
    before, observation = watch(df)
    _, report = publish_verified({"a": before.filter("id % 2 = 0")}, fresh(), {"a": observation})
    assert [tuple(r) for r in report.collect()] == [("a", 10, 5, False)]
    assert total.value == 10 and seen(observation) == 10


def test_empty_tables_count_zero(spark, fresh):
    assert write_counted(spark.createDataFrame([], "a int"), fresh()) == 0
    assert count_while_writing({"a": spark.range(5).filter("id > 9")}, fresh()).collect()[0].row_count == 0


def test_partitioned_and_appended_writes(spark, fresh):
    path = fresh()
    rows = spark.range(20).withColumn("p", F.col("id") % 3)
    assert write_counted(rows, path, partition_by=["p"]) == 20
    assert write_counted(rows.limit(4), path, "append", ["p"]) == 4
    assert stored_rows(spark, path) == 24


def test_counts_are_kept_with_the_lake(tables, spark, fresh):
    lake = Lake(fresh("lake"))
    bronze = lake.write(tables.bronze.drop("device_id"), "bronze", "iot_data", "append")
    lake.write(tables.bronze.drop("device_id").limit(7), "bronze", "iot_data", "append")
    refresh_gold(refresh_silver(bronze, lake), lake)
    found = {r.table_name: r.row_count for r in lake.counts(spark).collect()}
    for table in ("bronze.iot_data", "silver.iot_data", "gold.iot_data", "gold.dim_time", "gold.dim_equipment"):
        assert found[table] == stored_rows(spark, lake.path(*table.split(".")))
    refresh_silver(bronze, lake)  # an overwrite replaces its count
    assert {r.table_name: r.row_count for r in recorded_counts(spark, f"{lake.root}/_counts").collect()} == found


def test_dedup_is_seen_on_both_sides(tables, fresh):
    valid, before = watch(tables.valid)
    assert write_counted(silver_dedup(valid), fresh()) == 973
    assert seen(before) == tables.valid.count()
