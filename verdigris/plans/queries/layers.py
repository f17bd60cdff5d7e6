"""Cleansing, star schema, semantic models, joins and roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from verdigris.functions.classify import (
    PH_ACTION,
    PH_STATUS,
    TDS_ACTION,
    TDS_STATUS,
    TEMPERATURE_STATUS,
    action_flag,
    alert_flag,
    health_score,
    health_status,
    indicators,
    pct_round,
    range_indicator,
    status_class,
)
from verdigris.functions.cleaning import (
    bool_to_int,
    is_finite,
    onoff_to_bool,
    parse_bool_text,
    parse_timestamp,
    to_double,
    to_int,
)
from verdigris.operators.gold import gold_fact
from verdigris.operators.joins import equipment_long, equipment_usage, suboptimal_readings
from verdigris.operators.semantic import (
    conditional_count,
    fct_sensor_readings,
    stg_iot_data,
    stg_passthrough,
)
from verdigris.operators.silver import silver_dedup, silver_rejects
from verdigris.plans.batch import Lake, refresh_gold, refresh_semantic, refresh_silver, run_all_layers, semantic_models
from verdigris.plans.incremental import DailyLake, refresh
from verdigris.plans.oracle import (
    DAILY_MEANS,
    HOURLY_MEANS,
    TIME_SQL,
    VALID_SQL,
    number_sql,
    onoff_sql,
    replace_rounded,
    using,
)
from verdigris.plans.registry import Tables, query, rounded
from verdigris.schemas import ACTUATOR_NAMES, ACTUATORS, INDICATORS, NARROW_BANDS, RAW_COLUMNS
from verdigris.session import scratch_path
from verdigris.sources.sinks import export_csv, write_parquet

_KEY = ["id", "source_file"]
_READING = ["reading_id", "timestamp_key"]


@query(
    "to_numeric",
    using(
        "bronze",
        f"""select id, source_file, {number_sql('"pH"')} as ph, {number_sql('"TDS"')} as tds,
            cast(trunc({number_sql('water_level')}) as integer) as water_level,
            cast(trunc({number_sql('"pH"')}) as integer) as ph_whole from bronze""",
    ),
)
def _(t: Tables):
    return t.bronze.select(
        *_KEY,
        to_double(F.col("pH")).alias("ph"),
        to_double(F.col("TDS")).alias("tds"),
        to_int(F.col("water_level")).alias("water_level"),
        to_int(F.col("pH")).alias("ph_whole"),
    )


@query(
    "onoff_to_bool",
    using(
        "bronze",
        "select id, source_file, " + ", ".join(f'{onoff_sql(chr(34) + n + chr(34))} as "{n}"' for n in ACTUATORS) + " from bronze",
    ),
)
def _(t: Tables):
    return t.bronze.select(*_KEY, *[onoff_to_bool(F.col(n)).alias(n) for n in ACTUATORS])


@query("parse_timestamp", using("bronze", f"select id, source_file, {TIME_SQL} as parsed from bronze"))
def _(t: Tables):
    return t.bronze.select(*_KEY, parse_timestamp(F.col("timestamp")).alias("parsed"))


@query("silver_project", using("typed", "select * exclude (device_id) from typed"))
def _(t: Tables):
    return t.typed


@query("silver_validate", using("valid", "select * exclude (device_id) from valid"))
def _(t: Tables):
    return t.valid


@query(
    "silver_rejects",
    using(
        "typed",
        f"""select id, source_file,
            case when id is null then 'id missing' when "timestamp" is null then 'timestamp missing'
              when not ("pH" between 0 and 14) then 'pH out of range'
              when not ("TDS" >= 0) then 'TDS out of range'
              when not ("DHT_temp" between -10 and 50) then 'DHT_temp out of range'
              when not (water_temp between 0 and 50) then 'water_temp out of range'
              else 'DHT_humidity out of range' end as reason
            from typed where not ({VALID_SQL})""",
    ),
)
def _(t: Tables):
    return silver_rejects(t.typed).select(*_KEY, "reason")


@query("silver_dedup", using("silver", "select * exclude (device_id) from silver"))
def _(t: Tables):
    return silver_dedup(t.valid)


@query("gold_fact", using("fact", "select * exclude (device_id) from fact"))
def _(t: Tables):
    return t.fact


@query(
    "range_indicator",
    using(
        "silver",
        """select id, "timestamp", coalesce("pH" between 5.5 and 6.5, false) as is_ph_optimal,
           coalesce("TDS" between 800 and 1200, false) as is_tds_optimal,
           coalesce("DHT_temp" between 20 and 25, false) as is_temp_optimal,
           coalesce("DHT_humidity" between 50 and 70, false) as is_humidity_optimal,
           coalesce(water_level between 60 and 80, false) as is_water_level_optimal from silver""",
    ),
)
def _(t: Tables):
    """The narrow band profile; ``gold_fact`` covers the standard one."""
    measures = [F.col(n) for n in ("pH", "TDS", "DHT_temp", "DHT_humidity")]
    level = range_indicator(F.col("water_level"), NARROW_BANDS.water_level)
    return t.silver.select(
        "id",
        "timestamp",
        *indicators(*measures, NARROW_BANDS),
        level.alias("is_water_level_optimal"),
    )


@query("dim_time", using("dim_time", "select * from dim_time"))
def _(t: Tables):
    return t.time


@query("stg_passthrough", using("dim_time", "select * from dim_time"))
def _(t: Tables):
    return stg_passthrough(t.time, "stg_time_dimension")


_FLAGS = [*ACTUATOR_NAMES, *INDICATORS]


@query(
    "bool_to_int",
    using("fact", "select reading_id, timestamp_key, " + ", ".join(f"cast({c} as integer) as {c}" for c in _FLAGS) + " from fact"),
)
def _(t: Tables):
    return t.fact.select(*_READING, *[bool_to_int(F.col(c)).alias(c) for c in _FLAGS])


# Spellings a warehouse load may produce, one per event.
_WORDS = ["true", "T", "yes", "Y", "on", "1", "false", "F", "no", "N", "off", "0", "", "maybe"]


@query(
    "parse_bool_text",
    """select event_id, word, case when lower(trim(word)) in ('true', 't', 'yes', 'y', 'on', '1') then true
       when lower(trim(word)) in ('false', 'f', 'no', 'n', 'off', '0') then false end as flag
       from (select event_id, (["""
    + ", ".join(f"'{w}'" for w in _WORDS)
    + f"])[cast(event_id % {len(_WORDS)} as integer) + 1] as word from events)",
)
def _(t: Tables):
    events = t.spark.read.parquet(f"{t.folder}/events.parquet")
    words = F.array(*[F.lit(w) for w in _WORDS])
    word = F.get(words, (F.col("event_id") % len(_WORDS)).cast("int"))
    return events.select("event_id", word.alias("word"), parse_bool_text(word).alias("flag"))


def _flag_sql(c: str) -> str:
    text = f'lower(trim("{c}"))'
    return (
        f"case when {text} in ('true', 't', 'yes', 'y', 'on', '1') then true"
        f" when {text} in ('false', 'f', 'no', 'n', 'off', '0') then false end as \"{c}\""
    )


@query(
    "parse_bool_actuators",
    using("bronze", "select id, source_file, " + ", ".join(map(_flag_sql, ACTUATORS)) + " from bronze"),
)
def _(t: Tables):
    """The actuator texts of the raw readings, other words read as missing."""
    return t.bronze.select(*_KEY, *[parse_bool_text(F.col(c)).alias(c) for c in ACTUATORS])


@query("stg_iot_data", using("stg", "select * from stg"))
def _(t: Tables):
    return t.staged


@query("stg_iot_data_text", using("stg", "select * from stg"))
def _(t: Tables):
    """Flags arrive as text, as after a warehouse load."""
    flags = [n for n in t.fact.columns if n.startswith("is_")]
    return stg_iot_data(t.fact.withColumns({n: F.col(n).cast("string") for n in flags}))


@query(
    "status_class",
    using("fct", "select reading_id, timestamp_key, ph_status, tds_status, temperature_status from fct"),
)
def _(t: Tables):
    return t.fact.select(
        *_READING,
        status_class(F.col("ph_level"), PH_STATUS).alias("ph_status"),
        status_class(F.col("tds_level"), TDS_STATUS).alias("tds_status"),
        status_class(F.col("air_temperature"), TEMPERATURE_STATUS).alias("temperature_status"),
    )


@query("health_score", using("health", "select reading_id, timestamp_key, health_score, health_status from health"))
def _(t: Tables):
    flags = [F.col(f"is_{n}_optimal") for n in ("ph", "tds", "temp", "environment")]
    return t.staged.select(
        *_READING,
        health_score(*flags).alias("health_score"),
        health_status(*flags).alias("health_status"),
    )


@query("alert_flags", using("health", "select reading_id, timestamp_key, ph_alert, tds_alert, temp_alert, humidity_alert from health"))
def _(t: Tables):
    names = ("ph", "tds", "temp", "humidity")
    return t.fact.select(*_READING, *[alert_flag(F.col(f"is_{n}_optimal")).alias(f"{n}_alert") for n in names])


@query("action_flags", using("health", "select reading_id, timestamp_key, ph_action_required, tds_action_required from health"))
def _(t: Tables):
    return t.fact.select(
        *_READING,
        action_flag(F.col("ph_level"), PH_ACTION).alias("ph_action_required"),
        action_flag(F.col("tds_level"), TDS_ACTION).alias("tds_action_required"),
    )


@query(
    "pct_round",
    using(
        "stg",
        """select reading_date, round(cast(sum(case when is_ph_optimal then 1 else 0 end) as double) / count(*) * 100, 2)
           as ph_pct from stg group by reading_date""",
    ),
)
def _(t: Tables):
    days = t.staged.groupBy("reading_date").agg(
        F.count_if("is_ph_optimal").alias("good"), F.count(F.lit(1)).alias("n")
    )
    return days.select("reading_date", pct_round(F.col("good"), F.col("n")).alias("ph_pct"))


@query(
    "daily_health_score",
    using("daily", "select reading_date, daily_health_score, daily_environment_efficiency_pct from daily"),
)
def _(t: Tables):
    return t.daily.select("reading_date", "daily_health_score", "daily_environment_efficiency_pct")


_MEASURED = ["pH", "TDS", "DHT_temp", "DHT_humidity", "water_temp"]
_ODD = ["nan", "inf", "-inf"]  # of 40 readings, one measure of the first three is made one of these


def _odd_sql(i: int, c: str) -> str:
    cases = " ".join(f"when {i * 4 + k} then cast('{v}' as double)" for k, v in enumerate(_ODD))
    return f'case cast(id as bigint) % 40 {cases} else "{c}" end as "{c}"'


@query(
    "finite_mask",
    using(
        "typed",
        "select * from (select id, source_file, "
        + ", ".join(_odd_sql(i, c) for i, c in enumerate(_MEASURED))
        + " from typed) where "
        + " and ".join(f'isfinite("{c}")' for c in _MEASURED),
    ),
)
def _(t: Tables):
    """Rows of which all five measures are numbers, from readings with NaN and infinities."""

    def odd(i: int, c: str):
        value = F.col(c)
        for k, v in enumerate(_ODD):
            value = F.when(F.col("id") % 40 == i * 4 + k, F.lit(float(v))).otherwise(value)
        return value.alias(c)

    rows = t.typed.select(*_KEY, *[odd(i, c) for i, c in enumerate(_MEASURED)])
    every = F.lit(True)
    for c in _MEASURED:
        every = every & is_finite(F.col(c))
    return rows.filter(every)


@query("fct_sensor_readings", using("fct", "select * from fct"))
def _(t: Tables):
    return fct_sensor_readings(stg_iot_data(gold_fact(t.stored_silver)), t.stored_time)


@query("fct_sensor_readings_derived", using("fct", "select * from fct"))
def _(t: Tables):
    """Time attributes computed instead of joined."""
    return fct_sensor_readings(t.staged)


@query(
    "join_fact_time_inner",
    using(
        "fact dim_time",
        """select f.reading_id, t."date", t."hour", f.ph_level, f.is_ph_optimal, f.air_temperature
           from fact f join dim_time t on f.timestamp_key = t.timestamp_key where not f.is_ph_optimal
           order by t."date" desc, t."hour" desc""",
    ),
)
def _(t: Tables):
    return suboptimal_readings(gold_fact(t.stored_silver), t.stored_time)


_LONG_SQL = " union all ".join(
    f"select reading_id, timestamp_key, '{code}' as equipment_code, {fact} as is_on from fact"
    for fact, code in {
        "is_ph_reducer_on": "pH_reducer",
        "is_add_water_on": "add_water",
        "is_nutrients_adder_on": "nutrients_adder",
        "is_humidifier_on": "humidifier",
        "is_ex_fan_on": "ex_fan",
    }.items()
)


@query(
    "equipment_long_join",
    using("fact equipment", f"select * from ({_LONG_SQL}) l join equipment e using (equipment_code)"),
)
def _(t: Tables):
    return equipment_long(t.fact, t.equipment)


@query(
    "equipment_usage",
    using(
        "fact equipment",
        f"""select cast(timestamp_key as date) as reading_date, equipment_code, equipment_id, equipment_name,
            equipment_description, count(*) as readings,
            cast(sum(case when is_on then 1 else 0 end) as bigint) as readings_on
            from ({_LONG_SQL}) l join equipment e using (equipment_code) group by all""",
    ),
)
def _(t: Tables):
    return equipment_usage(t.fact, t.equipment)


@query("int_sensor_metrics", using("hourly", f"select {replace_rounded(HOURLY_MEANS)} from hourly"))
def _(t: Tables):
    return rounded(t.hourly)


@query(
    "daily_environment_metrics",
    using("daily", f"select {replace_rounded(DAILY_MEANS)} from daily order by reading_date desc"),
)
def _(t: Tables):
    return rounded(t.daily)


_COUNTED = [*[staged for staged, _, _ in ACTUATOR_NAMES.values()], *INDICATORS, "is_environment_optimal"]


@query(
    "conditional_count",
    using(
        "stg",
        "select reading_date, reading_hour, "
        + ", ".join(f"cast(sum(case when {c} then 1 else 0 end) as bigint) as {c}" for c in _COUNTED)
        + " from stg group by 1, 2",
    ),
)
def _(t: Tables):
    counts = [conditional_count(F.col(c)).alias(c) for c in _COUNTED]
    return t.staged.groupBy("reading_date", "reading_hour").agg(*counts)


@query(
    "distinct_dim",
    using("stg", "select distinct reading_date, reading_hour, is_environment_optimal from stg"),
)
def _(t: Tables):
    return t.staged.select("reading_date", "reading_hour", "is_environment_optimal").distinct()


@query("dim_sensor_health", using("health", "select * from health"))
def _(t: Tables):
    return t.health


# --- compositions -----------------------------------------------------------------


def _raw_csv(t: Tables) -> str:
    return export_csv(t.bronze.select(*RAW_COLUMNS), scratch_path(t.spark, "raw"))


@query("bronze_to_silver", using("silver", "select * exclude (device_id) from silver"))
def _(t: Tables):
    """Store bronze, cleanse from the stored files, store silver."""
    lake = Lake(scratch_path(t.spark, "lake"))
    path = write_parquet(t.bronze.drop("device_id"), lake.path("bronze", "iot_data"), "append")
    return refresh_silver(t.spark.read.parquet(path), lake).drop("silver_processed_timestamp")


@query(
    "star_schema",
    using(
        "fact dim_time",
        """select f.reading_id, f.timestamp_key, f.is_ph_optimal, t.day_name, t.day_type
           from fact f join dim_time t using (timestamp_key)""",
    ),
)
def _(t: Tables):
    gold = refresh_gold(t.silver, Lake(scratch_path(t.spark, "lake")))
    joined = gold["iot_data"].join(gold["dim_time"], "timestamp_key")
    return joined.select("reading_id", "timestamp_key", "is_ph_optimal", "day_name", "day_type")


@query(
    "semantic_build",
    using("daily", f"select {replace_rounded(DAILY_MEANS)} from daily"),
)
def _(t: Tables):
    """Daily metrics built from stored hourly metrics."""
    lake = Lake(scratch_path(t.spark, "lake"))
    return rounded(refresh_semantic({"iot_data": t.fact}, lake)["daily_environment_metrics"])


@query(
    "semantic_views",
    using(
        "daily fct health",
        """select reading_date, total_readings, daily_health_score,
           (select count(*) from fct) as fct_rows, (select count(*) from health) as health_rows from daily""",
    ),
)
def _(t: Tables):
    models = semantic_models(t.fact, t.time)
    one = F.count(F.lit(1))
    return models["daily_environment_metrics"].select(
        "reading_date",
        "total_readings",
        "daily_health_score",
        models["fct_sensor_readings"].agg(one).scalar().alias("fct_rows"),
        models["dim_sensor_health"].agg(one).scalar().alias("health_rows"),
    )


# One ingestion instant for the whole CSV run, so which copy of a reading survives is
# decided by the row content; counts do not depend on it.
@query(
    "all_layers",
    using(
        "bronze silver fact dim_time hourly daily",
        """select 'bronze.iot_data' as table_name, count(*) as row_count from bronze
           union all select 'silver.iot_data', count(*) from silver
           union all select 'gold.iot_data', count(*) from fact
           union all select 'gold.dim_time', count(*) from dim_time
           union all select 'gold.dim_equipment', cast(5 as bigint)
           union all select 'semantic.stg_iot_data', count(*) from fact
           union all select 'semantic.int_sensor_metrics', count(*) from hourly
           union all select 'semantic.daily_environment_metrics', count(*) from daily
           union all select 'semantic.fct_sensor_readings', count(*) from fact
           union all select 'semantic.dim_sensor_health', count(*) from fact""",
    ),
)
def _(t: Tables):
    """CSV to published tables, every layer stored; rows per table."""
    return run_all_layers(t.spark, scratch_path(t.spark, "lake"), csv=_raw_csv(t))


@query("incremental_layers", using("daily", f"select {replace_rounded(DAILY_MEANS)} from daily"))
def _(t: Tables):
    """Daily metrics after three landings, each refreshing only the days its files touch."""
    lake = DailyLake(t.spark, scratch_path(t.spark, "daily-lake"))
    late = F.col("source_file") == "late.parquet"
    recent = F.col("timestamp") >= "2024-01-25"
    for rows in (t.bronze.filter(~late & ~recent), t.bronze.filter(~late & recent), t.bronze.filter(late)):
        lake.land(rows)
        refresh(lake)
    return rounded(lake.read("semantic.daily_environment_metrics"))
