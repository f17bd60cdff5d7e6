"""Properties of physical plans that matter at scale."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.conftest import SMALL, plan_of
from verdigris.operators import bi
from verdigris.operators.gold import dim_time
from verdigris.operators.semantic import daily_environment_metrics, fct_sensor_readings, stg_iot_data
from verdigris.plans.batch import Lake, refresh_gold, refresh_semantic
from verdigris.session import materialize, shared_folder


@pytest.fixture(scope="module")
def stored(tables, spark):
    from verdigris.session import scratch_path

    lake = Lake(scratch_path(spark, "lake"))
    gold = refresh_gold(materialize(tables.silver, "silver"), lake)
    return gold, refresh_semantic(gold, lake)


def test_dedup_limits_groups_before_the_shuffle(tables):
    plan = plan_of(tables.silver)
    assert plan.count("WindowGroupLimit") == 2
    final, partial = plan.index("row_number(), 1, Final"), plan.index("row_number(), 1, Partial")
    assert final < plan.index("Exchange hashpartitioning(id") < partial


def test_silver_parses_each_field_once(tables):
    """Validity is computed from parsed columns, not by parsing again."""
    plan = plan_of(tables.silver)
    assert plan.count("try_cast(replace(DHT_temp") == 1


def test_rollups_aggregate_before_the_shuffle(tables):
    plan = plan_of(tables.hourly)
    head, tail = plan.split("Exchange hashpartitioning(reading_date", 1)
    assert "HashAggregate" in head and "partial_avg" in tail


def test_derived_time_needs_no_join(tables):
    assert "Join" not in plan_of(fct_sensor_readings(tables.staged))
    assert "Join" in plan_of(fct_sensor_readings(tables.staged, tables.time))


def test_time_dimension_shuffles_one_column(tables, spark):
    silver = materialize(tables.silver, "silver")
    plan = plan_of(dim_time(silver))
    assert "ReadSchema: struct<timestamp:timestamp>" in plan


def test_date_filters_reach_the_files(stored):
    gold, semantic = stored
    plan = plan_of(bi.daily_metrics(semantic["daily_environment_metrics"], date(2024, 1, 8), date(2024, 1, 9)))
    assert "GreaterThanOrEqual(reading_date,2024-01-08)" in plan
    usage = plan_of(bi.equipment_usage_stats(semantic["daily_environment_metrics"]))
    assert "daily_avg_ph" not in usage


def test_fact_is_pruned_by_day(stored, spark):
    gold, _ = stored
    path = gold["iot_data"].inputFiles()[0].split("/partition_day=")[0]
    plan = plan_of(spark.read.parquet(path).filter(F.col("partition_day") == F.lit(date(2024, 1, 8))))
    assert "PartitionFilters: [isnotnull(partition_day" in plan


def test_recent_readings_is_a_top_k(stored):
    assert "TakeOrderedAndProject" in plan_of(bi.recent_readings(stored[1]["fct_sensor_readings"]))


def test_stored_models_equal_lazy_models(stored, tables):
    staged = stg_iot_data(tables.fact)
    lazy = fct_sensor_readings(staged, tables.time)
    assert lazy.exceptAll(stored[1]["fct_sensor_readings"].select(*lazy.columns)).count() == 0
    days = stored[1]["daily_environment_metrics"]
    assert days.count() == daily_environment_metrics(tables.hourly).count() == 30


PYTHON_FREE = ["silver_dedup", "daily_environment_metrics", "fct_sensor_readings", "dim_sensor_health", "dq_report",
               "sequence_windows", "inference_windows", "scale_standard_windows"]


@pytest.mark.parametrize("name", PYTHON_FREE)
def test_no_python_workers_and_no_cross_joins(spark, name):
    plan = plan_of(entry.queries()[name](spark, SMALL))
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


def test_shared_folder_must_be_named_on_a_cluster():
    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf(values)

    assert shared_folder(Session(**{"spark.checkpoint.dir": "hdfs:///c/"})) == "hdfs:///c"
    assert shared_folder(Session(**{"spark.master": "local[2]"}))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session(**{"spark.master": "spark://host:7077"}))


def test_registry_is_consistent():
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries)
    assert len(queries) >= 120


def test_hot_timestamp_can_be_split(spark, tables):
    """Both sides of the fact/time join are shuffled scans, which the skew rule needs."""
    from verdigris.operators.gold import dim_time, gold_fact
    from verdigris.operators.semantic import fct_sensor_readings, stg_iot_data
    from verdigris.session import materialize

    time = materialize(dim_time(tables.stored_silver), "time")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(fct_sensor_readings(stg_iot_data(gold_fact(tables.stored_silver)), time))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and plan.count("ENSURE_REQUIREMENTS") == 2
    assert "Aggregate" not in plan and "Window" not in plan
