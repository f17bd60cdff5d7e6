"""Streams agree with batch, survive restarts and reruns."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tests.test_cleaning import bronze
from verdigris.operators.silver import build_silver, silver_project, silver_validate
from verdigris.sources.routing import replay_pack, write_requests
from verdigris.operators.semantic import int_sensor_metrics, stg_iot_data
from verdigris.operators.gold import gold_fact
from verdigris.streaming.jobs import (
    first_copy_stream,
    hourly_stream,
    read_landed,
    run_available,
    to_parquet,
    upsert_latest,
    upsert_stream,
)


def _land(rows, path, mode="append"):
    packed = replay_pack(rows, ["id", "pH"], batch_size=3)
    packed.select("body").write.mode(mode).option("maxRecordsPerFile", 1).text(path)


def test_restart_reads_only_new_files(spark, fresh):
    landed, out, state = fresh("landed"), fresh("out"), fresh("state")
    for first in (0, 10):
        _land(bronze(spark, *[dict(id=str(i)) for i in range(first, first + 10)]), landed)
        stream = read_landed(spark, landed, files_per_batch=2)
        run_available(to_parquet(stream, out, state))
    ids = [int(r.id) for r in spark.read.parquet(out).collect()]
    assert sorted(ids) == list(range(20))


def test_stream_keeps_one_copy_per_key(spark, fresh):
    landed, out = fresh("landed"), fresh("out")
    _land(bronze(spark, *[dict(id=str(i % 7), pH=str(5 + i / 100)) for i in range(30)]), landed)
    run_available(first_copy_stream(read_landed(spark, landed), out, fresh("state")))
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(7))


def test_upsert_equals_batch_and_is_idempotent(tables, spark, fresh):
    path = fresh("silver")
    valid = silver_validate(silver_project(tables.bronze))
    late = F.col("source_file") == "late.parquet"
    batches = [valid.filter(late), valid.filter(~late & (F.col("id") < 500)), valid.filter(~late & (F.col("id") >= 500))]
    for batch in [*batches, batches[0], batches[2]]:
        upsert_latest(batch, path)
    stored = spark.read.parquet(path).drop("day")
    want = build_silver(tables.bronze)
    assert stored.count() == 973
    assert want.exceptAll(stored.select(*want.columns)).count() == 0


def test_upsert_leaves_other_days_alone(spark, fresh):
    path = fresh("silver")
    day = lambda d, **k: dict(timestamp=f"2023-11-{d} 10:00:00", **k)
    first = bronze(spark, day(26, id="1", pH="5"), day(27, id="2", pH="5"))
    second = bronze(spark, day(27, id="2", pH="7"), at=datetime(2024, 2, 1))
    for rows in (first, second):
        upsert_latest(silver_validate(silver_project(rows)), path)
    assert {r.id: r.pH for r in spark.read.parquet(path).collect()} == {1: 5.0, 2: 7.0}


def test_requests_file_count(spark, fresh):
    path = write_requests(replay_pack(bronze(spark, *[dict(id=str(i)) for i in range(7)]), ["id"], 3), fresh(), per_file=1)
    assert len(spark.read.text(path).inputFiles()) == 3


@pytest.mark.parametrize("files", [1, 3, None])
def test_results_do_not_depend_on_batch_size(tables, spark, fresh, files):
    rows = tables.bronze.drop("device_id")
    landed, late = fresh("landed"), F.col("source_file") == "late.parquet"
    silver, hours, states = fresh("silver"), fresh("hours"), (fresh("s"), fresh("h"))
    for part in (rows.filter(~late), rows.filter(late)):
        packed = replay_pack(part, ["ingestion_timestamp", "id", "source_file"], batch_size=100)
        write_requests(packed, landed, per_file=2, mode="append")
        run_available(upsert_stream(read_landed(spark, landed, files_per_batch=files), silver, states[0]))
    run_available(hourly_stream(read_landed(spark, landed, files_per_batch=files), fresh("own"), hours, states[1]))
    want = build_silver(rows).drop("ingestion_timestamp", "source_file")
    stored = spark.read.parquet(silver).select(*want.columns)
    assert stored.count() == 973 and want.exceptAll(stored).count() == 0
    counted = int_sensor_metrics(stg_iot_data(gold_fact(build_silver(rows)))).select("reading_date", "reading_hour", "reading_count")
    assert counted.exceptAll(spark.read.parquet(hours).select(*counted.columns)).count() == 0


def test_stored_days_are_read_through_a_partition_filter(spark, fresh):
    from verdigris.streaming import jobs

    path = fresh("silver")
    rows = silver_validate(silver_project(bronze(spark, dict(id="1", timestamp="2023-11-26 10:00:00"))))
    days = upsert_latest(rows, path)
    stored = jobs._stored(rows.withColumn("day", F.to_date("timestamp")), path, days)
    assert "PartitionFilters: [isnotnull(day" in plan_of(stored) and "2023-11-26" in plan_of(stored)


def test_ids_beyond_32_bits_are_kept(spark, fresh):
    big = str(3 * 10**9)
    rows = bronze(spark, dict(id=big), dict(id="not a number"))
    assert [r.id for r in build_silver(rows).collect()] == [int(big)]
    path = fresh("silver")
    upsert_latest(silver_validate(silver_project(rows)), path)
    assert [r.id for r in spark.read.parquet(path).collect()] == [int(big)]


def test_micro_batches_do_not_grow_with_the_landing(spark, fresh, monkeypatch):
    from types import SimpleNamespace

    from verdigris.plans.queries import streams
    from verdigris.sources.versions import DayTable
    from verdigris.streaming.merge import latest_rows, latest_stream

    monkeypatch.setattr(streams, "REQUEST_READINGS", 2)
    monkeypatch.setattr(streams, "FILE_REQUESTS", 1)
    rows = bronze(spark, *[dict(id=str(i)) for i in range(60)])
    path = fresh("silver")
    streams._run_landings(SimpleNamespace(spark=spark, bronze=rows), "t", lambda s, state: latest_stream(s, path, state))
    table = DayTable(spark, path)
    # Thirty files and more: by twos this took fifteen batches.
    assert latest_rows(table).count() == 60 and len(table.head().parts) <= 4
