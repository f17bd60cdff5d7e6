"""Scans, sinks, publishing, routing and packing, as round trips over the readings."""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import functions as F, types as T

from verdigris.operators.gold import dim_time, gold_fact
from verdigris.operators.silver import build_silver, silver_dedup
from verdigris.plans.oracle import HOURLY_MEANS, replace_rounded, using
from verdigris.plans.registry import Tables, query, rounded
from verdigris.schemas import ACTUATOR_NAMES, INDICATORS, MEASURES, RAW_COLUMNS, RAW_SCHEMA
from verdigris.session import scratch_path
from verdigris.sources.counted import count_while_writing, publish_verified, watch
from verdigris.sources.publish import format_timestamps, warehouse_columns
from verdigris.sources.rescue import rescue_csv, rescue_json, route_rescued
from verdigris.sources.routing import Route, replay_pack, route_by_date, write_requests, write_routes
from verdigris.sources.scans import (
    add_ingest_metadata,
    explode_envelope,
    normalize_strings,
    scan_csv,
    scan_json,
    scan_parquet_or_table,
    scan_table,
    union_sources,
)
from verdigris.sources.sinks import ensure_namespace, export_csv, write_layer, write_parquet, write_table

# Order of a replay: arrival order made total.
REPLAY_ORDER = ["ingestion_timestamp", "id", "source_file"]
_RAW_SQL = ", ".join(f'"{n}"' for n in RAW_COLUMNS)
_EMPTY_IS_NULL = ", ".join(f"nullif(\"{n}\", '') as \"{n}\"" for n in RAW_COLUMNS)


def _table_name() -> str:
    return f"readings_{uuid.uuid4().hex[:12]}"


@query("scan_csv_bronze", using("bronze", f"select {_EMPTY_IS_NULL} from bronze"))
def _(t: Tables):
    path = export_csv(t.bronze.select(*RAW_COLUMNS), scratch_path(t.spark, "csv"))
    return scan_csv(t.spark, path)


@query("scan_json_bronze", using("bronze", f"select {_RAW_SQL} from bronze"))
def _(t: Tables):
    packed = replay_pack(t.bronze, REPLAY_ORDER, batch_size=500)
    path = write_requests(packed, scratch_path(t.spark, "json"))
    return explode_envelope(scan_json(t.spark, path, multi_line=False))


@query("json_envelope_explode", using("bronze", f"select {_RAW_SQL} from bronze"))
def _(t: Tables):
    """Batches and bare records, mixed in one folder of JSON lines."""
    late = F.col("source_file") == "late.parquet"
    batches = replay_pack(t.bronze.filter(~late), REPLAY_ORDER, batch_size=100)
    bare = replay_pack(t.bronze.filter(late), REPLAY_ORDER, batch_size=1)
    path = write_requests(batches.unionByName(bare), scratch_path(t.spark, "mixed"))
    return explode_envelope(scan_json(t.spark, path, multi_line=False))


@query("scan_parquet_or_table", using("bronze", 'select id, "timestamp", source_file from bronze'))
def _(t: Tables):
    """The path does not exist, so the table serves the rows."""
    name = write_table(t.bronze, _table_name(), path=scratch_path(t.spark, "table"))
    absent = scratch_path(t.spark, "absent")
    return scan_parquet_or_table(t.spark, absent, name).select("id", "timestamp", "source_file")


@query("scan_table", using("fact", "select * exclude (device_id) from fact"))
def _(t: Tables):
    name = write_table(t.fact, _table_name(), path=scratch_path(t.spark, "table"))
    return scan_table(t.spark, name)


@query("ensure_namespace", using("silver", 'select id, "timestamp", source_file from silver'))
def _(t: Tables):
    """A table in a database of its own, which is created for it."""
    full = ensure_namespace(t.spark, f"lake_{uuid.uuid4().hex[:12]}.readings")
    rows = t.silver.select("id", "timestamp", "source_file")
    write_table(rows, full, path=scratch_path(t.spark, "namespace"))
    return scan_table(t.spark, full)


# The type of each published fact column.
_PUBLISHED = {
    **dict.fromkeys(["reading_id", "water_level"], "INTEGER"),
    **dict.fromkeys([m for m in MEASURES if m != "water_level"], "FLOAT"),
    **dict.fromkeys([*ACTUATOR_NAMES, *INDICATORS], "BOOLEAN"),
    **dict.fromkeys(["timestamp_key", "ingestion_timestamp"], "TIMESTAMP_NTZ"),
    "source_file": "VARCHAR(16777216)",
}


@query(
    "publish_type_map",
    using(
        "fact",
        " union all ".join(
            f"select '{c}' as column_name, '{kind}' as warehouse_type, count({c}) as present from fact"
            for c, kind in _PUBLISHED.items()
        ),
    ),
)
def _(t: Tables):
    """Warehouse type of each column as it is published, and how many values it loads."""
    published = format_timestamps(t.fact)
    types = warehouse_columns(published)
    kinds = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])
    counts = published.agg(*[F.count(c).alias(c) for c in types])
    long = counts.unpivot([], list(types), "column_name", "present")
    return long.select("column_name", kinds[F.col("column_name")].alias("warehouse_type"), "present")


@query(
    "sink_parquet_append",
    using("bronze", "select source_file, count(*) as n, count(device_id) as devices from bronze group by source_file"),
)
def _(t: Tables):
    late = F.col("source_file") == "late.parquet"
    path = scratch_path(t.spark, "append")
    write_parquet(t.bronze.filter(~late), path, "append")
    write_parquet(t.bronze.filter(late), path, "append")
    stored = t.spark.read.parquet(path)
    return stored.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n"), F.count("device_id").alias("devices")
    )


@query(
    "sink_parquet_overwrite",
    using("fact", "select cast(timestamp_key as date) as reading_date, count(*) as n from fact group by 1"),
)
def _(t: Tables):
    """A refresh by day; the second write replaces the first."""
    path = scratch_path(t.spark, "overwrite")
    dated = t.fact.withColumn("reading_date", F.to_date("timestamp_key"))
    for _ in range(2):
        write_parquet(dated, path, partition_by=["reading_date"])
    return t.spark.read.parquet(path).groupBy("reading_date").agg(F.count(F.lit(1)).alias("n"))


@query(
    "sink_table_append",
    using(
        "bronze",
        """select id, "timestamp", source_file,
           case when source_file = 'late.parquet' then device_id end as device_id from bronze""",
    ),
)
def _(t: Tables):
    """The second batch brings a column the table lacks."""
    late = F.col("source_file") == "late.parquet"
    name = _table_name()
    first = t.bronze.filter(~late).select("id", "timestamp", "source_file")
    write_table(first, name, path=scratch_path(t.spark, "table"))
    second = t.bronze.filter(late).select("id", "timestamp", "source_file", "device_id")
    return t.spark.table(write_table(second, name, "append"))


@query(
    "sink_table_overwrite",
    using("silver", "select id, \"timestamp\" from silver"),
)
def _(t: Tables):
    """The second write replaces rows and schema."""
    name, path = _table_name(), scratch_path(t.spark, "table")
    write_table(t.bronze, name, path=path)
    return t.spark.table(write_table(t.silver.select("id", "timestamp"), name, path=path))


@query(
    "publish_warehouse",
    using(
        "fact dim_time",
        """select 'dim_time' as table_name, count(*) as source_rows, count(*) as published_rows, true as matches
           from dim_time union all
           select 'iot_data', count(*), count(*), true from fact union all
           select 'dim_equipment', 5, 5, true""",
    ),
)
def _(t: Tables):
    gold = {"iot_data": t.fact, "dim_time": t.time, "dim_equipment": t.equipment}
    return publish_verified(gold, scratch_path(t.spark, "published"))[1]


@query(
    "publish_format_timestamps",
    using(
        "fact",
        """select reading_id, strftime(timestamp_key, '%Y-%m-%d %H:%M:%S') as timestamp_key,
           strftime(ingestion_timestamp, '%Y-%m-%d %H:%M:%S') as ingestion_timestamp from fact""",
    ),
)
def _(t: Tables):
    return format_timestamps(t.fact.select("reading_id", "timestamp_key", "ingestion_timestamp"))


@query(
    "publish_verify_counts",
    using(
        "valid silver",
        """select 'iot_data' as table_name, (select count(*) from valid) as source_rows,
           (select count(*) from silver) as published_rows,
           (select count(*) from valid) = (select count(*) from silver) as matches""",
    ),
)
def _(t: Tables):
    """Rows before and after deduplication, which differ: the check reports it. One run sees both."""
    valid, before = watch(t.valid)
    published = {"iot_data": silver_dedup(valid)}
    return publish_verified(published, scratch_path(t.spark, "verified"), {"iot_data": before})[1]


# The readings lie in January 2024; the default ranges lie in 2023.
ROUTES = (
    Route("batch_backfill", date(2024, 1, 1), date(2024, 1, 20), False),
    Route("incremental_batch", date(2024, 1, 21), date(2024, 1, 25), True),
    Route("api_streaming_replay", date(2024, 1, 26), date(2024, 1, 28), True),
)


@query(
    "route_by_date",
    using(
        "typed bronze",
        """select id, "timestamp", source_file, route,
           case when route in ('incremental_batch', 'api_streaming_replay') then strftime(d, '%Y-%m-%d') end as "day"
           from (select id, "timestamp", source_file, d,
             case when d between date '2024-01-01' and date '2024-01-20' then 'batch_backfill'
                  when d between date '2024-01-21' and date '2024-01-25' then 'incremental_batch'
                  when d between date '2024-01-26' and date '2024-01-28' then 'api_streaming_replay'
                  else 'other' end as route
             from (select *, cast(try_strptime("timestamp", '%Y-%m-%d %H:%M:%S') as date) as d from bronze))""",
    ),
)
def _(t: Tables):
    raw = t.bronze.select(*RAW_COLUMNS, "source_file")
    path = write_routes(route_by_date(raw, ROUTES), scratch_path(t.spark, "routes"))
    extra = ["source_file", "route", "day"]
    schema = T.StructType([*RAW_SCHEMA.fields, *[T.StructField(n, T.StringType()) for n in extra]])
    return scan_csv(t.spark, path, schema).select("id", "timestamp", *extra)


_REPLAY_SQL = """select (rn - {start}) // {batch} as request, cast(count(*) as integer) as records,
  min(id) as first_id, max(id) as last_id
  from (select *, row_number() over (order by ingestion_timestamp, id, source_file) - 1 as rn from bronze)
  where rn >= {start} and rn - {start} < {taken} group by 1"""


@query("replay_pack", using("bronze", _REPLAY_SQL.format(start=25, batch=100, taken=1 << 60)))
def _(t: Tables):
    packed = replay_pack(t.bronze, REPLAY_ORDER, batch_size=100, start=25)
    ids = F.from_json("body", "records array<struct<id: string>>")["records"]["id"]
    return packed.select(
        "request", "records", F.array_min(ids).alias("first_id"), F.array_max(ids).alias("last_id")
    )


@query("export_csv", using("hourly", f"select {replace_rounded(HOURLY_MEANS)} from hourly"))
def _(t: Tables):
    path = export_csv(t.hourly, scratch_path(t.spark, "export"))
    return rounded(t.spark.read.schema(t.hourly.schema).option("header", True).csv(path))


@query(
    "add_ingest_metadata",
    using(
        "bronze",
        """select id, "timestamp", timestamp '2024-02-01 00:00:00' as ingestion_timestamp,
           'readings.csv' as source_file from bronze""",
    ),
)
def _(t: Tables):
    now = datetime(2024, 2, 1)
    return add_ingest_metadata(t.bronze.select("id", "timestamp"), "readings.csv", F.lit(now))


def _text_sql(c: str) -> str:
    if c == "ex_fan":
        return "cast(null as varchar) as ex_fan"
    return f"""strftime("{c}", '%Y-%m-%d %H:%M:%S') as "{c}\"""" if c == "timestamp" else f'cast("{c}" as varchar) as "{c}"'


@query("normalize_strings", using("typed", "select " + ", ".join(map(_text_sql, RAW_COLUMNS)) + " from typed"))
def _(t: Tables):
    """Typed values as text; a column the source lacks comes out null."""
    return normalize_strings(t.typed.drop("ex_fan"))


@query(
    "union_sources",
    using(
        "bronze",
        """select id, source_file, case when source_file = 'late.parquet' then device_id end as device_id
           from bronze""",
    ),
)
def _(t: Tables):
    late = F.col("source_file") == "late.parquet"
    first = t.bronze.filter(~late).select("id", "source_file")
    return union_sources(first, t.bronze.filter(late).select("id", "source_file", "device_id"))


@query(
    "table_counts",
    using(
        "bronze silver fact dim_time",
        """select 'bronze' as table_name, count(*) as row_count from bronze
           union all select 'silver', count(*) from silver union all select 'fact', count(*) from fact
           union all select 'dim_time', count(*) from dim_time""",
    ),
)
def _(t: Tables):
    """Each layer is counted by the write that stores it, and read back for the next."""
    folder = scratch_path(t.spark, "counted")
    stored = t.spark.read.parquet
    counts = count_while_writing({"bronze": t.bronze}, folder)
    counts = counts.union(count_while_writing({"silver": build_silver(stored(f"{folder}/bronze"))}, folder))
    silver = stored(f"{folder}/silver")
    return counts.union(count_while_writing({"fact": gold_fact(silver), "dim_time": dim_time(silver)}, folder))


@query("write_layer", using("bronze", "select source_file, count(*) as n from bronze group by 1"))
def _(t: Tables):
    """Two appends of one layer to its path and its table; the table's rows are returned."""
    late = F.col("source_file") == "late.parquet"
    path, name = scratch_path(t.spark, "layer"), _table_name()
    write_layer(t.bronze.filter(~late), path, name, "append")
    write_layer(t.bronze.filter(late), path, name, "append")
    return t.spark.table(name).groupBy("source_file").agg(F.count(F.lit(1)).alias("n"))


# Every fiftieth reading is sent with a defect of one kind, the next with one of another.
_NUMBER = "cast(id as bigint)"
_PLAIN_SQL = ", ".join(f"coalesce(replace(\"{n}\", '\"', ''), '')" for n in RAW_COLUMNS)


def _plain(name: str):
    return F.coalesce(F.regexp_replace(name, '"', ""), F.lit(""))


@query(
    "scan_csv_rescued",
    using(
        "bronze",
        f"""select case {_NUMBER} % 50 when 1 then line || ',surplus' when 2 then id || ',' || "timestamp" end as line,
           case when {_NUMBER} % 50 not in (1, 2) then id end as id
           from (select *, concat_ws(',', {_PLAIN_SQL}) as line from bronze)""",
    ),
)
def _(t: Tables):
    """Lines with a field too many or too few end in quarantine as they were; the others are read."""
    number = F.col("id").cast("long")
    whole = F.concat_ws(",", *[_plain(n) for n in RAW_COLUMNS])
    line = (
        F.when(number % 50 == 1, F.concat(whole, F.lit(",surplus")))
        .when(number % 50 == 2, F.concat_ws(",", "id", "timestamp"))
        .otherwise(whole)
    )
    # Files of at most some hundred lines, each with its header.
    lines = t.bronze.select(F.floor(number / 500).alias("file"), line.alias("line"))
    bodies = lines.groupBy("file").agg(F.array_join(F.collect_list("line"), "\n").alias("body"))
    path, quarantine = scratch_path(t.spark, "defects"), scratch_path(t.spark, "quarantine")
    headed = bodies.select(F.concat(F.lit(",".join(RAW_COLUMNS) + "\n"), "body").alias("value"))
    headed.write.option("maxRecordsPerFile", 1).text(path)
    good = route_rescued(rescue_csv(t.spark, path), quarantine)
    lost = t.spark.read.parquet(quarantine)
    return lost.select(F.col("_rescued").alias("line"), F.lit(None).cast("string").alias("id")).union(
        good.select(F.lit(None).cast("string"), "id")
    )


@query(
    "scan_json_rescued",
    using(
        "bronze",
        f"""select case when {_NUMBER} % 50 <> 2 then id end as id,
           case {_NUMBER} % 50 when 1 then '{{"firmware":"v' || id || '"}}' when 2 then '{{"id": "' || id || '", ' end
             as rescued,
           {_NUMBER} % 50 = 2 as broken from bronze""",
    ),
)
def _(t: Tables):
    """Unknown fields stay beside their record, broken lines come back as they were."""
    number = F.col("id").cast("long")
    firmware = F.when(number % 50 == 1, F.concat(F.lit("v"), "id")).alias("firmware")
    body = F.to_json(F.struct("id", "timestamp", "water_level", firmware))
    line = F.when(number % 50 == 2, F.concat(F.lit('{"id": "'), "id", F.lit('", '))).otherwise(body)
    path = scratch_path(t.spark, "json-defects")
    t.bronze.select(line.alias("value")).write.text(path)
    return rescue_json(t.spark, path).select("id", F.col("_rescued").alias("rescued"), F.col("_broken").alias("broken"))
