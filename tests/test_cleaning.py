"""Edge values of parsing, validation, flags and classification."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Row, functions as F

from verdigris.functions import classify
from verdigris.functions.cleaning import (
    is_finite,
    onoff_to_bool,
    parse_bool_text,
    parse_timestamp,
    to_double,
    to_int,
)
from verdigris.operators.gold import gold_fact
from verdigris.operators.quality import Checks, dq_report
from verdigris.operators.semantic import int_sensor_metrics, stg_iot_data
from verdigris.operators.silver import build_silver, silver_dedup, silver_project, silver_rejects, silver_validate
from verdigris.schemas import BRONZE_SCHEMA, RAW_COLUMNS

NOON = "2023-11-26 12:00:00"
GOOD = dict(
    id="1", timestamp=NOON, pH="6.0", TDS="900", water_level="1", DHT_temp="22", DHT_humidity="55",
    water_temp="20", pH_reducer="ON", add_water=None, nutrients_adder="OFF", humidifier="OFF", ex_fan="ON",
)


def bronze(spark, *changes, source="a.csv", at=datetime(2024, 1, 1)):
    rows = [tuple({**GOOD, **c}[n] for n in RAW_COLUMNS) + (c.get("_at", at), c.get("_src", source)) for c in
            [dict(x) for x in changes]]
    return spark.createDataFrame(rows, BRONZE_SCHEMA)


def values(spark, texts, fn):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in df.select("i", fn(F.col("t")).alias("v")).orderBy("i").collect()]


def test_numbers(spark):
    texts = ["", None, '"6.1"', "abc", "7.0", " 8 "]
    assert values(spark, texts, to_double) == [None, None, 6.1, None, 7.0, 8.0]
    assert values(spark, texts, to_int) == [None, None, 6, None, 7, 8]
    assert values(spark, ["1e20", "-7.9"], to_int) == [None, -7]


def test_words(spark):
    assert values(spark, [" on ", "OFF", "n/a", None, ""], onoff_to_bool) == [True, False, None, None, None]
    words = ["true", "T", "yes", "Y", "on", "1", "false", "F", "no", "N", "off", "0", "", "maybe", None]
    assert values(spark, words, parse_bool_text) == [True] * 6 + [False] * 6 + [None] * 3


def test_times(spark):
    found = values(spark, [NOON, "not a time", " " + NOON, None], parse_timestamp)
    assert found == [datetime(2023, 11, 26, 12), None, None, None]


def test_finite(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (float("inf"),), (float("-inf"),), (None,)], "v double")
    assert [r.v for r in df.filter(is_finite(F.col("v"))).collect()] == [1.0]


def test_range_edges(spark):
    kept = [dict(id="1", pH="0"), dict(id="2", pH="14"), dict(id="3", DHT_temp="-10"), dict(id="4", DHT_temp="50"),
            dict(id="5", DHT_humidity="0"), dict(id="6", DHT_humidity="100"), dict(id="7", pH=""), dict(id="8", TDS="0")]
    dropped = [dict(id="11", pH="-0.1"), dict(id="12", pH="14.1"), dict(id="13", TDS="-1"), dict(id="14", water_temp="51"),
               dict(id="15", timestamp="never"), dict(id="x"), dict(id=None)]
    typed = silver_project(bronze(spark, *kept, *dropped))
    assert {r.id for r in silver_validate(typed).collect()} == set(range(1, 9))
    reasons = sorted(r.reason for r in silver_rejects(typed).collect())
    assert reasons == sorted(["pH out of range", "pH out of range", "TDS out of range", "water_temp out of range",
                              "timestamp missing", "id missing", "id missing"])
    assert build_silver(bronze(spark, *kept, *dropped)).count() == 8


def test_latest_valid_copy_wins(spark):
    first, later, last = (datetime(2024, 1, d) for d in (1, 2, 3))
    rows = bronze(spark, dict(pH="5", _at=first), dict(pH="6", _at=later), dict(pH="99", _at=last))
    assert [r.pH for r in build_silver(rows).collect()] == [6.0]
    assert [r.pH for r in silver_dedup(silver_validate(silver_project(rows))).collect()] == [6.0]


def test_ties_break_the_same_way_every_time(spark):
    copies = [dict(pH=str(4 + i / 100)) for i in range(50)]
    rows = bronze(spark, *copies)
    winners = {build_silver(rows.repartition(n)).first().pH for n in (1, 3, 7)}
    assert len(winners) == 1
    by_source = bronze(spark, dict(pH="5", _src="a"), dict(pH="6", _src="b"))
    assert build_silver(by_source).first().pH == 6.0


def test_ingesting_twice_changes_nothing(tables):
    once = tables.silver
    twice = build_silver(tables.bronze.union(tables.bronze))
    assert once.count() == twice.count() == 973
    assert once.exceptAll(twice).count() == 0


def test_band_edges_and_missing_values(spark):
    rows = bronze(spark, dict(id="1", pH="5.5", TDS="800", DHT_temp="20", DHT_humidity="40"),
                  dict(id="2", pH="6.5", TDS="1200", DHT_temp="28", DHT_humidity="70"),
                  dict(id="3", pH="5.49", TDS="1200.1", DHT_temp="28.1", DHT_humidity="70.1"),
                  dict(id="4", pH="", TDS="", DHT_temp="29", DHT_humidity=""))
    fact = gold_fact(build_silver(rows))
    flags = {r.reading_id: (r.is_ph_optimal, r.is_tds_optimal, r.is_temp_optimal, r.is_humidity_optimal)
             for r in fact.collect()}
    assert flags == {1: (True,) * 4, 2: (True,) * 4, 3: (False,) * 4, 4: (False,) * 4}
    row = fact.filter("reading_id = 4").select(
        classify.status_class(F.col("ph_level"), classify.PH_STATUS).alias("ph"),
        classify.status_class(F.col("air_temperature"), classify.TEMPERATURE_STATUS).alias("temp"),
        classify.action_flag(F.col("ph_level"), classify.PH_ACTION).alias("action"),
    ).first()
    assert row == Row(ph="Optimal", temp="Optimal", action=0)


def test_null_flags_stay_two_valued_downstream(spark):
    df = spark.createDataFrame([(None, True, True, False)], "a boolean, b boolean, c boolean, e boolean")
    a, b, c, e = (F.col(n) for n in "abce")
    row = df.select(
        classify.all_true(a, b).alias("both"),
        classify.health_score(a, b, c, e).alias("score"),
        classify.health_status(a, b, c, e).alias("status"),
        classify.alert_flag(a).alias("alert"),
    ).first()
    assert row == Row(both=False, score=25, status="Poor", alert=0)


def test_hour_with_one_reading_has_no_deviation(spark):
    hour = int_sensor_metrics(stg_iot_data(gold_fact(build_silver(bronze(spark, dict()))))).first()
    assert hour.stddev_ph is None and hour.reading_count == 1 and hour.ph_optimality_pct == 100.0
    assert hour.water_additions == 0 and hour.ph_reducer_activations == 1


def test_report_counts(spark):
    fact = gold_fact(build_silver(bronze(spark, dict(id="1"), dict(id="1", timestamp="2023-11-26 13:00:00"), dict(id="2", pH=""))))
    none = fact.select("timestamp_key").limit(0)
    report = dq_report({"f": (fact, Checks(["ph_level"], [("ph_level", 0, 5)], [["reading_id"]], [("timestamp_key", none)]))})
    found = {(r.check_name, r.column_name): (r.failed, r.total, r.status) for r in report.collect()}
    assert found == {
        ("not_null", "ph_level"): (1, 3, "fail"),
        ("accepted_range", "ph_level"): (2, 3, "fail"),
        ("unique", "reading_id"): (1, 3, "fail"),
        ("referential", "timestamp_key"): (3, 3, "fail"),
    }
