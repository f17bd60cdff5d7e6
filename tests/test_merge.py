"""Versioned merges: snapshots, failures, idempotent batches, and states equal to the batch job."""

from __future__ import annotations

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tests.test_cleaning import bronze
from verdigris.operators.gold import gold_fact
from verdigris.operators.semantic import (
    hourly_partials,
    hourly_values,
    int_sensor_metrics,
    merge_partials,
    stg_iot_data,
)
from verdigris.operators.silver import build_silver, silver_dedup, silver_project, silver_validate, validate_once
from verdigris.session import materialize
from verdigris.sources.routing import replay_pack, write_requests
from verdigris.sources.versions import DayTable
from verdigris.streaming import merge as m
from verdigris.streaming.event_time import event_time_stream, never_kept, run_counted
from verdigris.streaming.jobs import clean, read_landed, run_available


def valid(spark, *rows, **kw):
    return silver_dedup(silver_validate(silver_project(bronze(spark, *rows, **kw))))


def ids(df):
    return {r.id: r.pH for r in df.collect()}


def rounded(df):
    return [
        tuple(round(v + 1.3e-8, 6) if isinstance(v, float) else v for v in r)
        for r in df.select(*sorted(df.columns)).orderBy("reading_date", "reading_hour").collect()
    ]


def batch_hours(rows):
    return int_sensor_metrics(stg_iot_data(gold_fact(rows)))


@pytest.mark.parametrize("files", [1, 3, None])
def test_streams_equal_batch_for_any_batch_size(tables, spark, fresh, files):
    rows = tables.bronze.drop("device_id")
    landed, silver, hours, state = (fresh(n) for n in ("landed", "silver", "hours", "state"))
    late = F.col("source_file") == "late.parquet"
    for part in (rows.filter(~late), rows.filter(late)):
        packed = replay_pack(part, ["ingestion_timestamp", "id", "source_file"], batch_size=100)
        write_requests(packed, landed, per_file=3, mode="append")
        stream = read_landed(spark, landed, files_per_batch=files)
        run_available(m.hourly_state_stream(stream, silver, hours, state))
    want = build_silver(rows).drop("ingestion_timestamp", "source_file")
    stored = m.latest_rows(DayTable(spark, silver))
    assert stored.count() == 973 and want.exceptAll(stored.select(*want.columns)).count() == 0
    found = m.hourly_metrics(DayTable(spark, hours))
    assert found.columns == batch_hours(build_silver(rows)).columns
    assert rounded(found) == rounded(batch_hours(build_silver(rows)))


def test_a_batch_is_stored_and_aggregated_once(spark, fresh, monkeypatch):
    landed, silver, hours, state = (fresh(n) for n in ("landed", "silver", "hours", "state"))
    copies, aggregated, partials = [], [], m._partials
    monkeypatch.setattr(m, "materialize", lambda df, label: copies.append(label) or df)
    monkeypatch.setattr(m, "_partials", lambda df: aggregated.append(1) or partials(df))
    at = lambda i, h, **k: dict(id=str(i), timestamp=f"2023-11-26 {h:02d}:00:00", **k)
    landings = [[at(1, 8, pH="5"), at(2, 9, pH="5")], [at(1, 8, pH="7"), at(3, 8, pH="6"), at(4, 9, pH="6")]]
    for n, rows in enumerate(landings):
        packed = replay_pack(bronze(spark, *rows, at=datetime(2024, 2, 1 + n)), ["id"], batch_size=1)
        packed.select("body").coalesce(1).write.mode("append").text(landed)
        run_available(m.hourly_state_stream(read_landed(spark, landed), silver, hours, state))
    # Before: each batch was written once more beside silver, and its hours were aggregated twice.
    assert copies == [] and len(aggregated) == len(landings)
    found = {r.reading_hour: (r.reading_count, r.avg_ph) for r in m.hourly_metrics(DayTable(spark, hours)).collect()}
    assert found == {8: (2, 6.5), 9: (2, 5.5)}


def test_a_batch_adds_its_own_rows_only_and_once(spark, fresh):
    table = DayTable(spark, fresh())
    first = valid(spark, *[dict(id=str(i), timestamp=f"2023-11-2{i % 5} 10:00:00") for i in range(20)])
    m.merge_latest(first, table, 0)
    again = valid(spark, dict(id="3", timestamp="2023-11-23 10:00:00", pH="9"), at=datetime(2024, 2, 1))
    version = m.merge_latest(again, table, 1)
    assert spark.read.parquet(f"{table.path}/{version.parts[-1].folder}").count() == 1
    assert m.merge_latest(again, table, 1) == version == table.head()
    assert m.merge_latest(first, table, 0) == version
    assert ids(m.latest_rows(table))[3] == 9.0 and m.latest_rows(table).count() == 20
    # Only the day that two folders share is merged.
    assert version.shared_days() == {date(2023, 11, 23)}


def test_readers_keep_their_version_and_a_killed_write_changes_nothing(spark, fresh, monkeypatch):
    table = DayTable(spark, fresh())
    m.merge_latest(valid(spark, dict(id="1", pH="5"), dict(id="2", pH="5")), table, 0)
    held = table.head()
    newer = valid(spark, dict(id="1", pH="7"), at=datetime(2024, 2, 1))
    with monkeypatch.context() as patch:
        patch.setattr(DayTable, "_publish", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            m.merge_latest(newer, table, 1)
        with pytest.raises(KeyboardInterrupt):
            m.compact_latest(DayTable(spark, table.path)) if held.shared_days() else table.replace(
                m.latest_rows(table).withColumn("day", F.to_date("timestamp")).limit(0), held.parts[0].days
            )
    assert table.head() == held and ids(m.latest_rows(table)) == {1: 5.0, 2: 5.0}
    m.merge_latest(newer, table, 1)  # the batch is run again
    assert ids(m.latest_rows(table)) == {1: 7.0, 2: 5.0}
    assert ids(m.latest_rows(table, held)) == {1: 5.0, 2: 5.0}
    m.compact_latest(table)
    assert not table.head().shared_days() and ids(m.latest_rows(table)) == {1: 7.0, 2: 5.0}
    assert ids(m.latest_rows(table, held)) == {1: 5.0, 2: 5.0}
    assert table.head().applied(1)


def test_a_second_writer_is_refused(spark, fresh):
    table = DayTable(spark, fresh())
    head = table.append(spark.sql("select 1 as a, date'2024-01-01' as day"), 0)
    with pytest.raises(RuntimeError, match="another writer"):
        table._publish(head)


def test_empty_batches_and_tables(spark, fresh):
    table = DayTable(spark, fresh())
    with pytest.raises(ValueError, match="no version"):
        table.read(table.head())
    nothing = valid(spark, dict(id="1")).limit(0)
    assert m.merge_latest(nothing, table, 4).applied(4)
    assert m.latest_rows(table).count() == 0


def test_hours_between_two_commits(tables, spark, fresh):
    """Silver was committed, hours were not, and the batch is run again."""
    rows = tables.valid.drop("device_id")
    late = F.col("source_file") == "late.parquet"
    silver, hours = DayTable(spark, fresh("silver")), DayTable(spark, fresh("hours"))
    for number, part in enumerate((rows.filter(~late), rows.filter(late))):
        batch = silver_dedup(part).persist()
        m.merge_latest(batch, silver, number)
        m.merge_latest(batch, silver, number)
        m.merge_hours(batch, silver, hours, number)
        assert m.merge_hours(batch, silver, hours, number) == hours.head()
    assert rounded(m.hourly_metrics(hours)) == rounded(batch_hours(silver_dedup(rows)))


def test_only_touched_hours_are_read(spark, fresh):
    silver = DayTable(spark, fresh())
    m.merge_latest(valid(spark, *[dict(id=str(i), timestamp=f"2023-11-26 {i:02d}:00:00") for i in range(24)]), silver, 0)
    fresh_rows = valid(spark, dict(id="3", timestamp="2023-11-26 03:00:00"), dict(id="9", timestamp="2023-11-26 04:30:00"))
    old, days = m.stored_copies(silver, silver.head(), fresh_rows)
    assert days == [date(2023, 11, 26)] and sorted(r.id for r in old.collect()) == [3, 4]
    plan = plan_of(old)
    assert "PartitionFilters: [isnotnull(day" in plan and "2023-11-26" in plan
    assert "GreaterThanOrEqual(timestamp,2023-11-26 03:00:00" in plan or "GreaterThanOrEqual(timestamp,2023-11-26T03:00" in plan


def test_ranges_cover_all_hours():
    rng = random.Random(1)
    hours = sorted({datetime(2024, 1, rng.randrange(1, 28), rng.randrange(24)) for _ in range(200)})
    for most in (1, 3, 500):
        ranges = m.time_ranges(hours, most)
        assert len(ranges) <= most and all(any(a <= h < b for a, b in ranges) for h in hours)
    assert m.time_ranges([]) == []


def test_partials_merge_like_one_aggregate(spark):
    rng = random.Random(2)
    kinds = "reading_date int, reading_hour int, ph_level double, tds_level double, air_temperature double, air_humidity double, water_temperature double, water_level int, is_ph_optimal boolean, is_tds_optimal boolean, is_temp_optimal boolean, is_humidity_optimal boolean, is_environment_optimal boolean, ph_reducer_on boolean, add_water_on boolean, nutrients_adder_on boolean, humidifier_on boolean, ex_fan_on boolean"
    some = lambda f: None if rng.random() < 0.4 else f()
    rows = [
        (1, rng.randrange(6), *[some(lambda: rng.choice([1e6 + rng.random(), 5.5])) for _ in range(5)], some(lambda: 3))
        + tuple(some(lambda: rng.random() < 0.5) for _ in range(10))
        for _ in range(40)
    ]
    frame = spark.createDataFrame(rows, kinds)
    parts = [hourly_partials(spark.createDataFrame(rows[i : i + 13], kinds)) for i in range(0, 40, 13)]
    key = ["reading_date", "reading_hour"]
    state = parts[0]
    for part in parts[1:]:
        merged = merge_partials(part, state, key)
        state = merged.union(state.join(part, key, "left_anti").select(*merged.columns))
    close = {(r.reading_date, r.reading_hour): r for r in hourly_values(state).collect()}
    for want in int_sensor_metrics(frame).collect():
        found = close[want.reading_date, want.reading_hour]
        for name in want.asDict():
            assert found[name] == (pytest.approx(want[name], abs=1e-6) if isinstance(want[name], float) else want[name]), name


def test_event_time_state_counts_what_it_drops(spark, fresh):
    landed, path, state, counts = (fresh(n) for n in ("landed", "rows", "state", "counts"))
    at = lambda i, h, mi, **k: dict(id=str(i), timestamp=f"2023-11-26 {h:02d}:{mi:02d}:00", **k)
    landings = [
        [at(1, 8, 0), at(1, 8, 0), at(2, 9, 30), at(3, 10, 0), at(4, 9, 50, pH="99")],
        [at(1, 8, 0), at(2, 9, 30), at(4, 9, 50), at(5, 8, 59), at(6, 9, 0), at(7, 9, 1)],
        [at(7, 9, 1), at(8, 12, 0)],
    ]
    for rows in landings:
        packed = replay_pack(bronze(spark, *rows), ["id"], batch_size=1)
        packed.select("body").write.mode("append").text(landed)
        run_counted(spark, event_time_stream(read_landed(spark, landed), path, state), counts)
    kept = spark.read.parquet(path)
    assert sorted(r.id for r in kept.collect()) == [1, 2, 3, 4, 7, 8]
    total = spark.read.parquet(counts).agg(F.sum("kept"), F.sum("repeated"), F.sum("late")).first()
    # Late: 1 again, 5, and 6 at the mark itself. Repeated: 1 at once, 2 and 7 again.
    assert tuple(total) == (6, 3, 3)
    every = silver_validate(silver_project(bronze(spark, *[r for rows in landings for r in rows])))
    assert sorted(r.id for r in never_kept(every, kept).collect()) == [5, 6]
    assert sum(total) == every.count()


def test_many_landed_files_are_listed_in_few_tasks(spark, fresh):
    landed, path, state, counts = (fresh(n) for n in ("landed", "rows", "state", "counts"))
    usual = spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")
    packed = replay_pack(bronze(spark, *[dict(id=str(i)) for i in range(40)]), ["id"], batch_size=1)
    packed.select("body").coalesce(1).write.option("maxRecordsPerFile", 1).text(landed)
    query = run_counted(spark, event_time_stream(read_landed(spark, landed), path, state), counts)
    seen = spark.sparkContext.statusTracker()
    stages = [s for j in seen.getJobIdsForGroup(str(query.runId)) for s in seen.getJobInfo(j).stageIds]
    # Before: a task for each of the forty files.
    assert stages and max(seen.getStageInfo(s).numTasks for s in stages) <= 4 * spark.sparkContext.defaultParallelism < 40
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism") == usual
    assert spark.read.parquet(path).count() == 40


def test_each_field_is_parsed_once(spark):
    odd = [dict(pH="99"), dict(pH=""), dict(pH='"6.1"'), dict(TDS="-1"), dict(TDS=None), dict(id=None), dict(timestamp="?")]
    rows = bronze(spark, *[dict(id=str(i)) | more for i, more in enumerate(odd)], dict(id="7", DHT_temp="60"))
    typed = silver_project(rows)
    found, want = validate_once(typed), silver_validate(typed)
    assert found.schema == want.schema and sorted(r.id for r in found.collect()) == [1, 2, 4]
    assert found.exceptAll(want).count() == 0 and want.exceptAll(found).count() == 0
    plan = plan_of(validate_once(silver_project(materialize(rows, "plain"))))
    assert plan.count("try_cast(replace(pH") == 1, plan


def test_clean_is_the_input_of_both(spark):
    assert clean(bronze(spark, dict(id="1"), dict(id="1"), dict(id="x"))).count() == 1
