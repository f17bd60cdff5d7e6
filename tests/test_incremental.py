"""A refresh rewrites the days that new files touch, and equals a full build."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from verdigris.operators.gold import dim_time, gold_fact
from verdigris.operators.semantic import (
    daily_environment_metrics,
    dim_sensor_health,
    fct_sensor_readings,
    int_sensor_metrics,
    stg_iot_data,
)
from verdigris.operators.silver import build_silver
from verdigris.plans import incremental as i
from verdigris.sources.versions import DayTable


def equal(found, want):
    columns = [
        F.round(F.col(f.name) + 1.3e-8, 6).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
        for f in want.schema.fields
    ]
    found, want = found.select(*columns), want.select(*columns)
    assert found.count() == want.count()
    assert found.exceptAll(want).isEmpty()


def test_each_refresh_rewrites_its_days_only(tables, spark, fresh):
    lake = i.DailyLake(spark, fresh("lake"))
    rows = tables.bronze.drop("device_id")
    day = F.to_date(F.try_to_timestamp("timestamp"))
    late = F.col("source_file") == "late.parquet"
    last = [date(2024, 1, 29), date(2024, 1, 30)]
    lake.land(rows.filter(~late & (~day.isin(last) | day.isNull())))
    first = i.refresh(lake)
    assert len(first) > 20 and not set(first) & set(last)
    before = {name: lake.table(name).head() for name in [i.SILVER, *i.LAYERS]}
    lake.land(rows.filter(~late & day.isin(last[:1])))
    lake.land(rows.filter(late & day.isin(last[:1])))
    assert i.refresh(lake) == last[:1]
    for name, version in before.items():
        now = lake.table(name).head()
        assert now.number == version.number + 1
        new = [p for p in now.parts if p not in version.parts]
        assert [p.days for p in new] == [(last[0],)]
        assert set(version.parts) < set(now.parts)
    assert i.refresh(lake) == []  # nothing is new
    lake.land(rows.filter(late & ~day.isin(last[:1]) & day.isNotNull()))
    lake.land(rows.filter(~late & day.isin(last[1:])))
    assert last[1] in i.refresh(lake)
    silver = build_silver(rows)
    fact = gold_fact(silver)
    staged = stg_iot_data(fact)
    hourly = int_sensor_metrics(staged)
    equal(lake.read(i.SILVER), silver)
    equal(lake.read("gold.iot_data"), fact)
    equal(lake.read("gold.dim_time"), dim_time(silver))
    equal(lake.read("semantic.int_sensor_metrics"), hourly)
    equal(lake.read("semantic.daily_environment_metrics"), daily_environment_metrics(hourly))
    equal(lake.read("semantic.fct_sensor_readings"), fct_sensor_readings(staged))
    equal(lake.read("semantic.dim_sensor_health"), dim_sensor_health(staged))


def test_a_refresh_that_died_is_taken_up_again(tables, spark, fresh, monkeypatch):
    lake = i.DailyLake(spark, fresh("lake"))
    lake.land(tables.bronze.drop("device_id"))
    publish = DayTable._publish

    def fails(self, version):
        if self.path.endswith("int_sensor_metrics"):
            raise OSError("lost")
        return publish(self, version)

    with monkeypatch.context() as patch:
        patch.setattr(DayTable, "_publish", fails)
        with pytest.raises(Exception, match="lost"):
            i.refresh(lake)
    done = lake.table(i.SILVER).head()
    assert done.number == 1 and lake.table("semantic.int_sensor_metrics").head().number == 0
    i.refresh(lake)
    assert lake.table(i.SILVER).head() == done
    rows = build_silver(tables.bronze.drop("device_id"))
    equal(lake.read("semantic.int_sensor_metrics"), int_sensor_metrics(stg_iot_data(gold_fact(rows))))
