"""DuckDB SQL of the layers, as common table expressions to build oracle queries from."""

from __future__ import annotations

from verdigris.plans.registry import TIE_NUDGE

_CENTS = "cast(round(value*1e2) as bigint)"

# name -> (tables it reads, query)
_TABLES: dict[str, tuple[tuple[str, ...], str]] = {}


def _table(name: str, sql: str, *reads: str) -> None:
    _TABLES[name] = (reads, sql)


_table(
    "bronze",
    f"""
    select cast(event_id as varchar) as id,
      case when event_id % 103 = 0 then 'not a time' else cast(date_trunc('second', ts) as varchar) end as "timestamp",
      case when event_id % 97 = 0 then '' when event_id % 101 = 0 then '15.2' when event_id % 89 = 0 then '"6.1"'
        else cast(4e0 + ({_CENTS} % 400)/1e2 as varchar) end as "pH",
      cast(500e0 + ({_CENTS}*7 % 1000) as varchar) as "TDS",
      cast({_CENTS} % 3 as varchar) as water_level,
      case when event_id % 107 = 0 then '75.0' else cast(15e0 + ({_CENTS}*3 % 200)/1e1 as varchar) end as "DHT_temp",
      cast(30e0 + ({_CENTS}*11 % 600)/1e1 as varchar) as "DHT_humidity",
      cast(16e0 + ({_CENTS} % 97)/1e1 as varchar) as water_temp,
      case event_type when 'click' then 'ON' when 'view' then 'OFF' end as "pH_reducer",
      cast(null as varchar) as add_water,
      case event_type when 'purchase' then ' on ' else 'OFF' end as nutrients_adder,
      case event_type when 'signup' then 'ON' else 'OFF' end as humidifier,
      case event_type when 'error' then 'ON' when 'click' then 'ON' when 'view' then 'OFF'
        when 'signup' then 'OFF' else 'n/a' end as ex_fan,
      user_id as device_id, ts + interval 1 day as ingestion_timestamp, 'events.parquet' as source_file
    from events
    union all
    select cast(event_id as varchar), cast(date_trunc('second', ts) as varchar), '5.9', '900.0', '1', '22.0', '55.0',
      '20.0', 'ON', cast(null as varchar), 'OFF', 'OFF', 'ON', user_id, ts + interval 2 day, 'late.parquet'
    from events where event_id % 50 = 0
    """,
)


def number_sql(column: str) -> str:
    return f"try_cast(replace({column}, '\"', '') as double)"


def onoff_sql(column: str) -> str:
    return f"case upper(trim({column})) when 'ON' then true when 'OFF' then false end"


TIME_SQL = "try_strptime(\"timestamp\", '%Y-%m-%d %H:%M:%S')"

_table(
    "typed",
    f"""
    select try_cast(id as bigint) as id, {TIME_SQL} as "timestamp", {number_sql('"pH"')} as "pH",
      {number_sql('"TDS"')} as "TDS", cast(trunc({number_sql('water_level')}) as integer) as water_level,
      {number_sql('"DHT_temp"')} as "DHT_temp", {number_sql('"DHT_humidity"')} as "DHT_humidity",
      {number_sql('water_temp')} as water_temp, {onoff_sql('"pH_reducer"')} as "pH_reducer",
      {onoff_sql('add_water')} as add_water, {onoff_sql('nutrients_adder')} as nutrients_adder,
      {onoff_sql('humidifier')} as humidifier, {onoff_sql('ex_fan')} as ex_fan,
      ingestion_timestamp, source_file, device_id
    from bronze
    """,
    "bronze",
)
VALID_SQL = """id is not null and "timestamp" is not null
      and coalesce("pH" between 0 and 14, true) and coalesce("TDS" >= 0, true)
      and coalesce("DHT_temp" between -10 and 50, true) and coalesce(water_temp between 0 and 50, true)
      and coalesce("DHT_humidity" between 0 and 100, true)"""
_table("valid", f"select * from typed where {VALID_SQL}", "typed")
_table(
    "silver",
    """
    select * from valid qualify row_number() over (
      partition by id, "timestamp" order by ingestion_timestamp desc, source_file desc) = 1
    """,
    "valid",
)
_table(
    "fact",
    """
    select id as reading_id, "timestamp" as timestamp_key, "pH" as ph_level, "TDS" as tds_level, water_level,
      "DHT_temp" as air_temperature, "DHT_humidity" as air_humidity, water_temp as water_temperature,
      "pH_reducer" as is_ph_reducer_on, add_water as is_add_water_on, nutrients_adder as is_nutrients_adder_on,
      humidifier as is_humidifier_on, ex_fan as is_ex_fan_on,
      coalesce("pH" between 5.5 and 6.5, false) as is_ph_optimal,
      coalesce("TDS" between 800 and 1200, false) as is_tds_optimal,
      coalesce("DHT_temp" between 20 and 28, false) as is_temp_optimal,
      coalesce("DHT_humidity" between 40 and 70, false) as is_humidity_optimal,
      ingestion_timestamp, source_file, device_id
    from silver
    """,
    "silver",
)
_table(
    "dim_time",
    """
    select distinct "timestamp" as timestamp_key, strftime("timestamp", '%Y-%m-%d %H:%M:%S') as timestamp_full,
      strftime("timestamp", '%Y-%m-%d') as "date", strftime("timestamp", '%H:%M:%S') as "time",
      cast(year("timestamp") as integer) as "year", cast(quarter("timestamp") as integer) as quarter,
      cast(month("timestamp") as integer) as "month", cast(weekofyear("timestamp") as integer) as week_of_year,
      cast(dayofmonth("timestamp") as integer) as day_of_month,
      cast(dayofweek("timestamp") + 1 as integer) as day_of_week, cast(hour("timestamp") as integer) as "hour",
      cast(minute("timestamp") as integer) as "minute", strftime("timestamp", '%A') as day_name,
      strftime("timestamp", '%B') as month_name,
      case when dayofweek("timestamp") in (0, 6) then 'Weekend' else 'Weekday' end as day_type
    from silver
    """,
    "silver",
)
_table(
    "equipment",
    """
    select * from (values
      (cast(1 as bigint), 'pH_reducer', 'pH Reduction System', 'Controls pH levels in nutrient solution'),
      (2, 'add_water', 'Water Addition System', 'Adds water to maintain level'),
      (3, 'nutrients_adder', 'Nutrient Addition System', 'Adds nutrients to solution'),
      (4, 'humidifier', 'Humidifier', 'Controls humidity in growing environment'),
      (5, 'ex_fan', 'Exhaust Fan', 'Ventilation system for air circulation')
    ) as e(equipment_id, equipment_code, equipment_name, equipment_description)
    """,
)
_table(
    "stg",
    """
    select reading_id, timestamp_key, ph_level, tds_level, water_level, air_temperature, air_humidity,
      water_temperature, is_ph_reducer_on as ph_reducer_on, is_add_water_on as add_water_on,
      is_nutrients_adder_on as nutrients_adder_on, is_humidifier_on as humidifier_on, is_ex_fan_on as ex_fan_on,
      is_ph_optimal, is_tds_optimal, is_temp_optimal, is_humidity_optimal, ingestion_timestamp, source_file,
      is_ph_optimal and is_tds_optimal and is_temp_optimal and is_humidity_optimal as is_environment_optimal,
      cast(timestamp_key as date) as reading_date, cast(hour(timestamp_key) as integer) as reading_hour
    from fact
    """,
    "fact",
)


def count_sql(flag: str) -> str:
    return f"cast(sum(case when {flag} then 1 else 0 end) as bigint)"


_OPTIMAL = ("ph", "tds", "temp", "humidity", "environment")
_ON = {
    "ph_reducer_on": "ph_reducer_activations",
    "add_water_on": "water_additions",
    "nutrients_adder_on": "nutrient_additions",
    "humidifier_on": "humidifier_activations",
    "ex_fan_on": "fan_activations",
}
_MEANS = {
    "ph": "ph_level",
    "tds": "tds_level",
    "air_temp": "air_temperature",
    "air_humidity": "air_humidity",
    "water_temp": "water_temperature",
    "water_level": "water_level",
}
_SPREAD = ("ph", "tds", "air_temp")

_table(
    "hourly",
    "select *, "
    + ", ".join(
        f"round(cast({n}_optimal_count as double) / reading_count * 100, 2) as {n}_optimality_pct"
        for n in _OPTIMAL
    )
    + " from (select reading_date, reading_hour, "
    + ", ".join(f"avg({c}) as avg_{n}" for n, c in _MEANS.items())
    + ", "
    + ", ".join(f"min({_MEANS[n]}) as min_{n}, max({_MEANS[n]}) as max_{n}" for n in _SPREAD)
    + ", "
    + ", ".join(f"stddev_samp({_MEANS[n]}) as stddev_{n}" for n in _SPREAD)
    + ", count(*) as reading_count, "
    + ", ".join(f"{count_sql(f'is_{n}_optimal')} as {n}_optimal_count" for n in _OPTIMAL)
    + ", "
    + ", ".join(f"{count_sql(c)} as {n}" for c, n in _ON.items())
    + " from stg group by reading_date, reading_hour)",
    "stg",
)
_table(
    "daily",
    "select *, round(cast(total_environment_optimal as double) / total_readings * 100, 2)"
    " as daily_environment_efficiency_pct from (select reading_date, "
    + ", ".join(f"avg(avg_{n}) as daily_avg_{n}" for n in _MEANS)
    + ", "
    + ", ".join(f"min(min_{n}) as daily_min_{n}, max(max_{n}) as daily_max_{n}" for n in _SPREAD)
    + ", cast(sum(reading_count) as bigint) as total_readings, "
    + ", ".join(f"cast(sum({n}_optimal_count) as bigint) as total_{n}_optimal" for n in _OPTIMAL)
    + ", "
    + ", ".join(f"cast(sum({n}) as bigint) as total_{n}" for n in _ON.values())
    + ", "
    + ", ".join(f"avg({n}_optimality_pct) as avg_{n}_optimality_pct" for n in _OPTIMAL)
    # Whole hundredths, rounded half up once.
    + ", ((2 * sum("
    + " + ".join(f"cast(round(100 * {n}_optimality_pct) as bigint)" for n in ("ph", "tds", "temp", "humidity"))
    + ") + 4 * count(*)) // (8 * count(*))) / 100.0 as daily_health_score"
    + " from hourly group by reading_date)",
    "hourly",
)
_table(
    "fct",
    """
    select s.reading_id, s.timestamp_key, t."date" as reading_date, t."hour" as reading_hour, t.day_name,
      t.month_name, t.day_type, s.ph_level as ph_value, s.tds_level as tds_value,
      s.air_temperature as air_temp_celsius, s.air_humidity as air_humidity_pct,
      s.water_temperature as water_temp_celsius, s.water_level as water_level_pct, s.ph_reducer_on, s.add_water_on,
      s.nutrients_adder_on, s.humidifier_on, s.ex_fan_on, s.is_ph_optimal, s.is_tds_optimal, s.is_temp_optimal,
      s.is_humidity_optimal, s.is_environment_optimal,
      case when s.ph_level < 5.5 then 'Too Acidic' when s.ph_level > 6.5 then 'Too Alkaline' else 'Optimal' end
        as ph_status,
      case when s.tds_level < 800 then 'Low Nutrients' when s.tds_level > 1200 then 'High Nutrients'
        else 'Optimal' end as tds_status,
      case when s.air_temperature < 20 then 'Too Cold' when s.air_temperature > 30 then 'Too Hot'
        else 'Optimal' end as temperature_status, s.ingestion_timestamp, s.source_file
    from stg s left join dim_time t on s.timestamp_key = t.timestamp_key
    """,
    "stg",
    "dim_time",
)
_table(
    "health",
    """
    select distinct reading_id, timestamp_key,
      cast(case when is_environment_optimal then 100 when is_ph_optimal and is_tds_optimal and is_temp_optimal then 75
        when is_ph_optimal and is_tds_optimal then 50 when is_ph_optimal or is_tds_optimal then 25 else 0 end
        as integer) as health_score,
      case when is_environment_optimal then 'Excellent'
        when is_ph_optimal and is_tds_optimal and is_temp_optimal then 'Good'
        when is_ph_optimal and is_tds_optimal then 'Fair' when is_ph_optimal or is_tds_optimal then 'Poor'
        else 'Critical' end as health_status,
      cast(not is_ph_optimal as integer) as ph_alert, cast(not is_tds_optimal as integer) as tds_alert,
      cast(not is_temp_optimal as integer) as temp_alert, cast(not is_humidity_optimal as integer) as humidity_alert,
      cast(coalesce(ph_level < 5.0 or ph_level > 7.0, false) as integer) as ph_action_required,
      cast(coalesce(tds_level < 600 or tds_level > 1400, false) as integer) as tds_action_required
    from stg
    """,
    "stg",
)
_table(
    "base",
    """
    select reading_id, timestamp_key as "timestamp", ph_level, tds_level, water_level, air_temperature,
      air_humidity, water_temperature, cast(is_ph_reducer_on as integer) as ph_reducer_state,
      cast(is_add_water_on as integer) as add_water_state,
      cast(is_nutrients_adder_on as integer) as nutrients_adder_state,
      cast(is_humidifier_on as integer) as humidifier_state, cast(is_ex_fan_on as integer) as ex_fan_state,
      cast(is_ph_optimal as integer) as is_ph_optimal, cast(is_tds_optimal as integer) as is_tds_optimal,
      cast(is_temp_optimal as integer) as is_temp_optimal,
      cast(is_humidity_optimal as integer) as is_humidity_optimal, device_id
    from fact
    """,
    "fact",
)
_table(
    "numbered",
    'select *, row_number() over (order by "timestamp", reading_id) - 1 as position from base',
    "base",
)

_ROLLED = {
    "ph": ("ph_level", True),
    "tds": ("tds_level", True),
    "temp": ("air_temperature", True),
    "humidity": ("air_humidity", True),
    "water_temp": ("water_temperature", False),
}


def lag_sql(window: str) -> str:
    return ", ".join(f"lag({c}) over {window} as {n}_lag_1" for n, (c, full) in _ROLLED.items() if full)


def rolling_sql(short: str, long: str) -> str:
    parts = []
    for n, (c, full) in _ROLLED.items():
        parts += [f"avg({c}) over {short} as {n}_avg_1h", f"avg({c}) over {long} as {n}_avg_6h"]
        if full:
            parts += [f"max({c}) over {short} as {n}_max_1h", f"min({c}) over {short} as {n}_min_1h"]
    return ", ".join(parts)


def windows_sql(partition: str = "") -> str:
    order = f'{partition} order by "timestamp", reading_id'
    return (
        f"window o as ({order}), s as ({order} rows between 60 preceding and current row),"
        f" l as ({order} rows between 360 preceding and current row)"
    )


_table(
    "features",
    f"select * exclude (device_id), {lag_sql('o')}, {rolling_sql('s', 'l')} from base {windows_sql()}",
    "base",
)

ROLLING_NAMES = [
    f"{n}_{k}"
    for n, (_, full) in _ROLLED.items()
    for k in (("avg_1h", "avg_6h", "max_1h", "min_1h") if full else ("avg_1h", "avg_6h"))
]
LAG_NAMES = [f"{n}_lag_1" for n, (_, full) in _ROLLED.items() if full]


def round6(expression: str, digits: int = 6) -> str:
    """Rounded as ``registry.rounded`` does, nudge included."""
    return f"round(cast({expression} as double) + {TIE_NUDGE}, {digits})"


def round_sql(names, digits: int = 6) -> str:
    return ", ".join(f"{round6(n, digits)} as {n}" for n in names)


def replace_rounded(names, digits: int = 6) -> str:
    """``* replace (...)`` list that rounds the named columns in place."""
    return f"* replace ({round_sql(names, digits)})"


HOURLY_MEANS = [f"avg_{n}" for n in _MEANS] + [f"stddev_{n}" for n in _SPREAD]
DAILY_MEANS = [f"daily_avg_{n}" for n in _MEANS] + [f"avg_{n}_optimality_pct" for n in _OPTIMAL]


def using(tables: str, body: str) -> str:
    """``body`` preceded by the definitions of the (blank-separated) tables it reads."""
    order: list[str] = []

    def visit(name: str) -> None:
        for dependency in _TABLES[name][0]:
            visit(dependency)
        if name not in order:
            order.append(name)

    for name in tables.split():
        visit(name)
    parts = ", ".join(f"{name} as ({_TABLES[name][1]})" for name in order)
    return f"with {parts} {body}"
