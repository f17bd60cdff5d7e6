"""File quirks, appends, routing and packing."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from tests.test_cleaning import GOOD, bronze
from verdigris.operators.gold import dim_equipment
from verdigris.operators.joins import equipment_long, equipment_usage
from verdigris.plans.batch import Lake, land_bronze, refresh_silver, run_all_layers
from verdigris.schemas import RAW_COLUMNS, RAW_SCHEMA, SILVER_SCHEMA, require_schema
from verdigris.sources.publish import publish_parquet, verify_counts, warehouse_columns
from verdigris.sources.routing import replay_pack, route_by_date, write_requests
from verdigris.sources.scans import (
    add_ingest_metadata,
    explode_envelope,
    ingest_csv,
    ingest_json,
    normalize_strings,
    scan_csv,
    scan_json,
    scan_parquet_or_table,
    union_sources,
)
from verdigris.sources.sinks import ensure_namespace, export_csv, write_layer, write_parquet, write_table

HEADER = ",".join(RAW_COLUMNS)


def _write(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)
    return str(folder)


def test_csv_quirks(spark, tmp_path):
    lines = [
        HEADER,
        '1,2023-11-26 10:00:00,"6.1","say ""hi""",,"",55,20,ON,,OFF, on ,ON',
        "2,2023-11-26 10:01:00,6",
    ]
    rows = scan_csv(spark, _write(tmp_path / "c", "a.csv", "\n".join(lines))).orderBy("id").collect()
    first, second = rows
    assert (first.pH, first.TDS, first.water_level, first.DHT_temp, first.humidifier) == ("6.1", 'say "hi"', None, None, " on ")
    assert second.pH == "6" and second.TDS is None and second.ex_fan is None
    tagged = ingest_csv(spark, str(tmp_path / "c"), datetime(2024, 1, 1)).first()
    assert tagged.source_file == "a.csv" and tagged.ingestion_timestamp == datetime(2024, 1, 1)


def test_mixed_json_keeps_every_record(spark, tmp_path):
    record = {**GOOD}
    short = {k: v for k, v in GOOD.items() if k != "ex_fan"}
    numbers = {**GOOD, "id": 9, "pH": 6.5, "water_level": 2}
    folder = tmp_path / "j"
    _write(folder, "bare.json", json.dumps(record, indent=2))
    _write(folder, "batch.json", json.dumps({"records": [short, numbers]}, indent=2))
    _write(folder, "empty.json", json.dumps({"records": []}))
    rows = ingest_json(spark, str(folder)).collect()
    assert sorted(r.id for r in rows) == ["1", "1", "9"]
    nine = next(r for r in rows if r.id == "9")
    assert (nine.pH, nine.water_level, nine.add_water, nine.source_file) == ("6.5", "2", None, "api_ingestion")


def test_json_lines_and_missing_column_everywhere(spark, tmp_path):
    slim = {"id": "1", "timestamp": "2023-11-26 10:00:00"}
    folder = _write(tmp_path / "l", "a.json", json.dumps(slim) + "\n" + json.dumps({"records": [slim, slim]}))
    rows = explode_envelope(scan_json(spark, folder, multi_line=False))
    assert rows.columns == RAW_COLUMNS and rows.count() == 3


def test_normalize_adds_absent_columns(spark):
    row = normalize_strings(spark.createDataFrame([(1, 2.5)], "id int, pH double")).first()
    assert row.id == "1" and row.pH == "2.5" and row.ex_fan is None


def test_one_instant_per_run(spark):
    df = add_ingest_metadata(spark.range(3), "x", datetime(2024, 5, 1))
    assert {r.ingestion_timestamp for r in df.collect()} == {datetime(2024, 5, 1)}


def test_table_append_merges_schema(spark, fresh):
    name = "default.merge_" + fresh("n").rsplit("-", 1)[1][:8]
    write_table(spark.createDataFrame([(1, "a")], "id int, a string"), name, path=fresh())
    write_table(spark.createDataFrame([(2, "b")], "id int, b string"), name, "append")
    rows = {r.id: (r.a, r.b) for r in spark.table(name).collect()}
    assert rows == {1: ("a", None), 2: (None, "b")}
    write_table(spark.createDataFrame([(3,)], "z int"), name, path=fresh())
    assert spark.table(name).columns == ["z"]


def test_namespaces(spark):
    assert ensure_namespace(spark, "plain") == "default.plain"
    assert ensure_namespace(spark, "verdigris_ns.t") == "verdigris_ns.t"
    assert ensure_namespace(spark, "spark_catalog.verdigris_ns.t") == "spark_catalog.verdigris_ns.t"
    assert spark.catalog.databaseExists("verdigris_ns")


def test_layer_path_and_table_agree(spark, fresh):
    name = "default.layer_" + fresh("n").rsplit("-", 1)[1][:8]
    path = fresh("layer")
    for batch in (1, 2):
        df = add_ingest_metadata(spark.range(5).withColumn("batch", F.lit(batch)), "s")
        write_layer(df, path, name, "append")
    stored, table = spark.read.parquet(path), spark.table(name)
    assert stored.count() == table.count() == 10
    assert stored.exceptAll(table.select(*stored.columns)).count() == 0


def test_fallback_is_narrow(spark, fresh):
    name = "default.fall_" + fresh("n").rsplit("-", 1)[1][:8]
    write_table(spark.range(4), name, path=fresh())
    assert scan_parquet_or_table(spark, fresh("absent"), name).count() == 4
    assert scan_parquet_or_table(spark, write_parquet(spark.range(2), fresh()), name).count() == 2
    with pytest.raises(Exception, match="nowhere"):
        scan_parquet_or_table(spark, fresh("absent"), "nowhere")


def test_union_fills_with_null(spark):
    rows = union_sources(spark.range(1).select("id"), spark.createDataFrame([(5, "x")], "id long, k string")).collect()
    assert sorted((r.id, r.k) for r in rows) == [(0, None), (5, "x")]


def test_route_edges(spark, tmp_path):
    days = ["2023-11-25", "2023-11-26", "2023-12-19", "2023-12-20", "2023-12-23", "2023-12-24", "2023-12-26", "2023-12-27"]
    lines = [HEADER] + [f"{i},{d} 23:59:59" + "," * 11 for i, d in enumerate(days)]
    lines += ["20,," + "," * 10, "21,never" + "," * 11, '22,"""2023-12-21 00:00:00"""' + "," * 11, "23"]
    raw = scan_csv(spark, _write(tmp_path / "r", "a.csv", "\n".join(lines)), keep_malformed=True)
    found = {r.id: (r.route, r.day) for r in route_by_date(raw).collect()}
    names = ["other", "batch_backfill", "batch_backfill"] + ["incremental_batch"] * 2 + ["api_streaming_replay"] * 2 + ["other"]
    assert [found[str(i)][0] for i in range(8)] == names
    assert found["3"][1] == "2023-12-20" and found["1"][1] is None
    assert found["20"][0] == found["21"][0] == "other"
    assert found["22"] == ("incremental_batch", "2023-12-21")
    assert "23" not in found  # too short to have a time field


@pytest.mark.parametrize("size,start,cap,sizes", [
    (4, 0, None, [4, 4, 2]), (4, 3, None, [4, 3]), (4, 0, 5, [4, 4]), (1, 8, None, [1, 1]), (3, 0, 3, [3]), (1, 0, 3, [1] * 3),
])
def test_replay_batches(spark, size, start, cap, sizes):
    rows = bronze(spark, *[dict(id=str(i)) for i in range(10)])
    packed = replay_pack(rows, ["id"], size, start, cap).orderBy("request").collect()
    assert [p.records for p in packed] == sizes
    bodies = [json.loads(p.body) for p in packed]
    ids = [r["id"] for b in bodies for r in (b["records"] if size > 1 else [b])]
    assert ids == [str(i) for i in range(start, start + sum(sizes))]
    first = bodies[0]["records"][0] if size > 1 else bodies[0]
    assert list(first) == RAW_COLUMNS and first["add_water"] is None


def test_replay_round_trip(tables, spark, fresh):
    raw = tables.bronze.select(*RAW_COLUMNS, "ingestion_timestamp", "source_file")
    path = write_requests(replay_pack(raw, ["ingestion_timestamp", "id", "source_file"], 100), fresh(), per_file=1)
    back = explode_envelope(scan_json(spark, path))
    assert back.exceptAll(raw.select(*RAW_COLUMNS)).count() == 0 and back.count() == 1020


def test_csv_round_trip(tables, spark, fresh):
    raw = tables.bronze.select(*RAW_COLUMNS)
    back = scan_csv(spark, export_csv(raw, fresh()), RAW_SCHEMA)
    expected = raw.select(*[F.nullif(F.col(n), F.lit("")).alias(n) for n in RAW_COLUMNS])
    assert back.exceptAll(expected).count() == 0 and back.count() == 1020


def test_warehouse_types():
    fields = [("reading_id", T.IntegerType()), ("n", T.LongType()), ("ph_level", T.DoubleType()), ("is_on", T.BooleanType()),
              ("at", T.TimestampType()), ("timestamp_full", T.StringType()), ("start_time", T.StringType()), ("time", T.StringType())]

    class Frame:
        schema = T.StructType([T.StructField(n, k) for n, k in fields])

    assert list(warehouse_columns(Frame).values()) == [
        "INTEGER", "INTEGER", "FLOAT", "BOOLEAN", "TIMESTAMP_NTZ", "TIMESTAMP_NTZ", "TIMESTAMP_NTZ", "VARCHAR(16777216)"]


def test_publish_reports_a_short_table(tables, spark, fresh):
    gold = {"iot_data": tables.fact, "dim_equipment": dim_equipment(spark)}
    paths = publish_parquet(gold, fresh())
    published = {n: spark.read.parquet(p) for n, p in paths.items()}
    assert dict(published["iot_data"].dtypes)["timestamp_key"] == "string"
    published["iot_data"] = published["iot_data"].limit(3)
    found = {r.table_name: r.matches for r in verify_counts(gold, published).collect()}
    assert found == {"iot_data": False, "dim_equipment": True}


def test_equipment_views_agree(tables, spark):
    long = equipment_long(tables.fact, dim_equipment(spark))
    assert long.count() == 5 * 973
    by_rows = {r.equipment_code: r.n for r in long.groupBy("equipment_code").agg(F.count_if("is_on").alias("n")).collect()}
    usage = equipment_usage(tables.fact, dim_equipment(spark))
    by_day = {r.equipment_code: r.n for r in usage.groupBy("equipment_code").agg(F.sum("readings_on").alias("n")).collect()}
    assert by_rows == by_day and by_rows["add_water"] == 0


def test_schema_check_names_the_column(spark):
    with pytest.raises(ValueError, match="timestamp: expected timestamp, found nothing"):
        require_schema(spark.createDataFrame([(1,)], "id int"), SILVER_SCHEMA)


def test_all_layers_and_rerun(tables, spark, fresh):
    csv = export_csv(tables.bronze.select(*RAW_COLUMNS), fresh("csv"))
    root = fresh("lake")
    counts = {r.table_name: r.row_count for r in run_all_layers(spark, root, csv=csv).collect()}
    assert counts["bronze.iot_data"] == 1020
    assert counts["silver.iot_data"] == counts["semantic.fct_sensor_readings"] == 973
    assert counts["gold.dim_time"] == 972 and counts["semantic.daily_environment_metrics"] == 30
    # The same file again doubles bronze and leaves silver as it is.
    lake = Lake(root)
    again = land_bronze(spark, lake, csv=csv)
    assert again.count() == 2040 and refresh_silver(again, lake).count() == 973
