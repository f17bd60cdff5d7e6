"""Dashboard reads, KPIs, top-k reports and data-quality checks."""

from __future__ import annotations

from datetime import date

from verdigris.operators import bi
from verdigris.operators.quality import (
    Checks,
    dq_report,
    duplicate_keys,
    null_counts,
    orphans,
    out_of_range,
)
from verdigris.plans.oracle import DAILY_MEANS, HOURLY_MEANS, round_sql, replace_rounded, using
from verdigris.plans.registry import Tables, query, rounded

START, END = date(2024, 1, 8), date(2024, 1, 21)
_BETWEEN = "reading_date between date '2024-01-08' and date '2024-01-21'"
_NEWEST = "order by reading_date desc"


@query("bi_daily_metrics", using("daily", f"select {replace_rounded(DAILY_MEANS)} from daily where {_BETWEEN} {_NEWEST}"))
def _(t: Tables):
    return rounded(bi.daily_metrics(t.daily, START, END))


@query("bi_daily_metrics_from", using("daily", f"select {replace_rounded(DAILY_MEANS)} from daily where reading_date >= date '2024-01-08' and reading_date <= (select max(reading_date) from daily)"))
def _(t: Tables):
    return rounded(bi.daily_metrics(t.daily, start=START))


@query("bi_daily_metrics_until", using("daily", f"select {replace_rounded(DAILY_MEANS)} from daily where reading_date >= (select min(reading_date) from daily) and reading_date <= date '2024-01-21'"))
def _(t: Tables):
    return rounded(bi.daily_metrics(t.daily, end=END))


@query("bi_daily_metrics_all", using("daily", f"select {replace_rounded(DAILY_MEANS)} from daily where reading_date >= (select min(reading_date) from daily) and reading_date <= (select max(reading_date) from daily)"))
def _(t: Tables):
    return rounded(bi.daily_metrics(t.daily))


_HOURLY_SHOWN = [n for n in HOURLY_MEANS if not n.startswith("stddev_")]


@query(
    "bi_hourly_metrics",
    using(
        "hourly",
        f"select * exclude (stddev_ph, stddev_tds, stddev_air_temp) replace ({round_sql(_HOURLY_SHOWN)}) from hourly where {_BETWEEN}",
    ),
)
def _(t: Tables):
    return rounded(bi.hourly_metrics(t.hourly, START, END))


_FCT_SQL = """select * exclude (ingestion_timestamp, source_file) from fct
  where reading_date >= (select min(reading_date) from fct) and reading_date <= (select max(reading_date) from fct)
  order by timestamp_key desc, reading_id desc limit {n}"""


@query("bi_sensor_readings", using("fct", _FCT_SQL.format(n=1000)))
def _(t: Tables):
    return bi.recent_readings(t.fct)


@query("recent_readings", using("fct", _FCT_SQL.format(n=25)))
def _(t: Tables):
    return bi.recent_readings(t.fct, 25)


@query(
    "bi_equipment_usage",
    using(
        "daily",
        f"""select reading_date, total_ph_reducer_activations as ph_reducer, total_water_additions as water_addition,
            total_nutrient_additions as nutrients, total_humidifier_activations as humidifier,
            total_fan_activations as exhaust_fan, total_readings from daily where {_BETWEEN} {_NEWEST}""",
    ),
)
def _(t: Tables):
    return bi.equipment_usage_stats(t.daily, START, END)


@query(
    "bi_optimality_trends",
    using(
        "daily",
        "select reading_date, "
        + ", ".join(
            f"round(avg_{n}_optimality_pct + 1.3e-8, 6) as {n}_optimality"
            for n in ("ph", "tds", "temp", "humidity", "environment")
        )
        + f", daily_health_score from daily where {_BETWEEN} {_NEWEST}",
    ),
)
def _(t: Tables):
    return rounded(bi.optimality_trends(t.daily, START, END))


@query("alias_projection", using("daily", f"select reading_date, round(avg_environment_optimality_pct + 1.3e-8, 6) as environment_optimality, daily_health_score from daily {_NEWEST}"))
def _(t: Tables):
    shown = ["reading_date", "environment_optimality", "daily_health_score"]
    return rounded(bi.optimality_trends(t.daily).select(*shown))


@query("date_range_filter", using("fct", "select reading_id, timestamp_key, reading_date from fct where reading_date >= '2024-01-08' and reading_date <= '2024-01-21'"))
def _(t: Tables):
    """On the fact mart the date is text."""
    return bi.date_range(t.fct, START, END).select("reading_id", "timestamp_key", "reading_date")


_KPI_SQL = """select reading_date, daily_health_score,
  round(case when daily_health_score > 0 then daily_health_score - 75 end + 1.3e-8, 6) as health_score_delta,
  daily_environment_efficiency_pct,
  round(case when daily_environment_efficiency_pct > 0 then daily_environment_efficiency_pct - 80 end + 1.3e-8, 6)
    as efficiency_delta, total_readings
  from daily where reading_date = {day}"""


@query("kpi_snapshot", using("daily", _KPI_SQL.format(day="date '2024-01-11'")))
def _(t: Tables):
    return rounded(bi.kpi_snapshot(t.daily, date(2024, 1, 11)))


@query("kpi_snapshot_latest", using("daily", _KPI_SQL.format(day="(select max(reading_date) from daily)")))
def _(t: Tables):
    """The default reference day is not in the data, so the newest day is shown."""
    return rounded(bi.kpi_snapshot(t.daily))


@query(
    "kpi_breakdown",
    using(
        "daily",
        f"""select reading_date, {round_sql([f'avg_{n}_optimality_pct' for n in ('ph', 'tds', 'temp', 'humidity')])},
            total_environment_optimal, total_readings,
            round(cast(total_environment_optimal as double) / total_readings * 100 + 1.3e-8, 6) as environment_optimality
            from daily where reading_date = date '2024-01-11'""",
    ),
)
def _(t: Tables):
    return rounded(bi.kpi_breakdown(t.daily, date(2024, 1, 11)))


@query(
    "health_watchlist",
    using(
        "health",
        """select reading_id, timestamp_key, health_score, health_status, ph_alert, tds_alert, temp_alert,
           ph_action_required from health where health_status in ('Poor', 'Critical') order by timestamp_key desc""",
    ),
)
def _(t: Tables):
    return bi.health_watchlist(t.health)


@query(
    "filter_flag",
    using(
        "fct",
        """select reading_id, timestamp_key, reading_date, ph_value, ph_status, tds_value, tds_status,
           air_temp_celsius, temperature_status, is_environment_optimal from fct
           where reading_date >= '2024-01-23' order by timestamp_key desc""",
    ),
)
def _(t: Tables):
    return bi.recent_status(t.fct, as_of=date(2024, 1, 30), days=7)


@query(
    "hours_of_day",
    using(
        "hourly",
        """select reading_date, reading_hour, round(avg_ph + 1.3e-8, 6) as avg_ph, ph_optimality_pct,
           environment_optimality_pct, ph_reducer_activations from hourly
           where reading_date = date '2024-01-15' order by reading_hour""",
    ),
)
def _(t: Tables):
    return rounded(bi.hours_of_day(t.hourly, date(2024, 1, 15)))


@query(
    "order_by_keys",
    using(
        "daily",
        f"""select reading_date, daily_health_score, daily_environment_efficiency_pct, total_environment_optimal,
            total_readings, {round_sql(['daily_avg_ph', 'daily_avg_tds'])} from daily
            order by reading_date desc""",
    ),
)
def _(t: Tables):
    return rounded(bi.recent_days(t.daily))


@query(
    "latest_days",
    using(
        "daily",
        """select reading_date, daily_health_score, total_readings from daily
           order by reading_date desc limit 7""",
    ),
)
def _(t: Tables):
    """KPIs of the last week; the limit is the feature."""
    return bi.recent_days(t.daily, 7).select("reading_date", "daily_health_score", "total_readings")


@query(
    "lowercase_columns",
    using("silver", 'select id, "timestamp", "pH" as ph, "TDS" as tds, "DHT_temp" as dht_temp from silver'),
)
def _(t: Tables):
    return bi.lowercase_columns(t.silver.select("id", "timestamp", "pH", "TDS", "DHT_temp"))


@query(
    "global_bounds",
    using("fact", "select min(timestamp_key) as earliest, max(timestamp_key) as latest, count(*) as total_records from fact"),
)
def _(t: Tables):
    return bi.global_bounds(t.fact)


@query(
    "sample_head",
    using("fact", "select * exclude (device_id) from fact order by reading_id, timestamp_key limit 5"),
)
def _(t: Tables):
    """Five rows for a quick look, the first by key."""
    return t.fact.orderBy("reading_id", "timestamp_key").limit(5)


@query(
    "dq_unique",
    using("valid", """select id, "timestamp", count(*) as occurrences from valid group by 1, 2 having count(*) > 1"""),
)
def _(t: Tables):
    return duplicate_keys(t.valid, ["id", "timestamp"])


_NOT_NULL = ["reading_id", "timestamp_key", "ph_level", "tds_level", "is_ph_optimal", "is_add_water_on"]


@query(
    "dq_not_null",
    using(
        "fact",
        " union all ".join(
            f"select '{c}' as column_name, count(*) - count({c}) as failed, count(*) as total from fact"
            for c in _NOT_NULL
        ),
    ),
)
def _(t: Tables):
    return null_counts(t.fact, _NOT_NULL)


@query(
    "dq_accepted_range",
    using(
        "typed",
        """select 'pH' as column_name,
           cast(sum(case when not ("pH" between 0 and 14) then 1 else 0 end) as bigint) as failed,
           count(*) as total from typed""",
    ),
)
def _(t: Tables):
    """On rows before validation, where the check has something to find."""
    return out_of_range(t.typed, "pH", 0, 14)


@query(
    "dq_referential",
    using(
        "fact dim_time",
        """select f.timestamp_key, count(*) as child_rows from fact f where f.timestamp_key not in
           (select timestamp_key from dim_time where day_type = 'Weekday') group by 1""",
    ),
)
def _(t: Tables):
    """Against weekdays only, so that weekend readings are reported."""
    return orphans(t.fact, t.time.filter("day_type = 'Weekday'"), "timestamp_key")


@query(
    "dq_report",
    using(
        "fact dim_time typed",
        """select *, case when failed > 0 then 'fail' else 'pass' end as status from (
           select 'iot_data' as table_name, 'not_null' as check_name, 'reading_id' as column_name,
             count(*) - count(reading_id) as failed, count(*) as total from fact
           union all select 'iot_data', 'not_null', 'timestamp_key', count(*) - count(timestamp_key), count(*) from fact
           union all select 'iot_data', 'not_null', 'ph_level', count(*) - count(ph_level), count(*) from fact
           union all select 'iot_data', 'not_null', 'tds_level', count(*) - count(tds_level), count(*) from fact
           union all select 'iot_data', 'not_null', 'is_ph_optimal', count(*) - count(is_ph_optimal), count(*) from fact
           union all select 'iot_data', 'accepted_range', 'ph_level',
             cast(sum(case when not (ph_level between 0 and 14) then 1 else 0 end) as bigint), count(*) from fact
           union all select 'iot_data', 'unique', 'reading_id', (select count(*) from
             (select reading_id from fact group by 1 having count(*) > 1)), count(*) from fact
           union all select 'iot_data', 'referential', 'timestamp_key', cast(0 as bigint), count(*) from fact
           union all select 'dim_time', 'not_null', 'timestamp_key', count(*) - count(timestamp_key), count(*) from dim_time
           union all select 'dim_time', 'unique', 'timestamp_key', cast(0 as bigint), count(*) from dim_time
           union all select 'typed', 'unique', 'id,timestamp', (select count(*) from
             (select 1 from typed where id is not null and "timestamp" is not null group by id, "timestamp"
              having count(*) > 1)), count(*) from typed)""",
    ),
)
def _(t: Tables):
    fact_checks = Checks(
        not_null=["reading_id", "timestamp_key", "ph_level", "tds_level", "is_ph_optimal"],
        ranges=[("ph_level", 0, 14)],
        unique=[["reading_id"]],
        references=[("timestamp_key", t.time)],
    )
    time_checks = Checks(not_null=["timestamp_key"], unique=[["timestamp_key"]])
    return dq_report(
        {
            "iot_data": (t.fact, fact_checks),
            "dim_time": (t.time, time_checks),
            "typed": (t.typed, Checks(unique=[["id", "timestamp"]])),
        }
    )
