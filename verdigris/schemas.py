"""Layer schemas, bands and ranges shared by all jobs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, types as T

# --- fixed values -----------------------------------------------------------------
# Column names, physical ranges, bands and dimension rows define the data model; results
# are only comparable when they are exactly these.

RAW_COLUMNS = [
    "id",
    "timestamp",
    "pH",
    "TDS",
    "water_level",
    "DHT_temp",
    "DHT_humidity",
    "water_temp",
    "pH_reducer",
    "add_water",
    "nutrients_adder",
    "humidifier",
    "ex_fan",
]
ACTUATORS = ["pH_reducer", "add_water", "nutrients_adder", "humidifier", "ex_fan"]
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Inclusive physical limits; None means unbounded on that side.
PHYSICAL_RANGES = {
    "pH": (0, 14),
    "TDS": (0, None),
    "DHT_temp": (-10, 50),
    "water_temp": (0, 50),
    "DHT_humidity": (0, 100),
}

EQUIPMENT_ROWS = [
    (1, "pH_reducer", "pH Reduction System", "Controls pH levels in nutrient solution"),
    (2, "add_water", "Water Addition System", "Adds water to maintain level"),
    (3, "nutrients_adder", "Nutrient Addition System", "Adds nutrients to solution"),
    (4, "humidifier", "Humidifier", "Controls humidity in growing environment"),
    (5, "ex_fan", "Exhaust Fan", "Ventilation system for air circulation"),
]


@dataclass(frozen=True)
class BandProfile:
    """Inclusive optimal band per measure."""

    ph: tuple[float, float]
    tds: tuple[float, float]
    temperature: tuple[float, float]
    humidity: tuple[float, float]
    water_level: tuple[float, float] | None = None


STANDARD_BANDS = BandProfile(
    ph=(5.5, 6.5), tds=(800, 1200), temperature=(20, 28), humidity=(40, 70)
)
NARROW_BANDS = BandProfile(
    ph=(5.5, 6.5), tds=(800, 1200), temperature=(20, 25), humidity=(50, 70), water_level=(60, 80)
)
# --- end of fixed values ----------------------------------------------------------

MEASURES = ["ph_level", "tds_level", "water_level", "air_temperature", "air_humidity", "water_temperature"]
INDICATORS = ["is_ph_optimal", "is_tds_optimal", "is_temp_optimal", "is_humidity_optimal"]

# fact column -> (staging column, equipment code, feature column)
ACTUATOR_NAMES = {
    "is_ph_reducer_on": ("ph_reducer_on", "pH_reducer", "ph_reducer_state"),
    "is_add_water_on": ("add_water_on", "add_water", "add_water_state"),
    "is_nutrients_adder_on": ("nutrients_adder_on", "nutrients_adder", "nutrients_adder_state"),
    "is_humidifier_on": ("humidifier_on", "humidifier", "humidifier_state"),
    "is_ex_fan_on": ("ex_fan_on", "ex_fan", "ex_fan_state"),
}


def _struct(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in pairs])


_S, _I, _L, _D, _B, _TS = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.BooleanType(),
    T.TimestampType(),
)

RAW_SCHEMA = _struct(*[(name, _S) for name in RAW_COLUMNS])
BRONZE_SCHEMA = T.StructType(
    RAW_SCHEMA.fields + _struct(("ingestion_timestamp", _TS), ("source_file", _S)).fields
)
# Landed request files: a bare record at the root, or a batch under "records".
ENVELOPE_SCHEMA = T.StructType(
    [T.StructField("records", T.ArrayType(RAW_SCHEMA), True), *RAW_SCHEMA.fields]
)
SILVER_SCHEMA = _struct(
    ("id", _L),
    ("timestamp", _TS),
    ("pH", _D),
    ("TDS", _D),
    ("water_level", _I),
    ("DHT_temp", _D),
    ("DHT_humidity", _D),
    ("water_temp", _D),
    *[(name, _B) for name in ACTUATORS],
    ("ingestion_timestamp", _TS),
    ("source_file", _S),
)
FACT_SCHEMA = _struct(
    ("reading_id", _L),
    ("timestamp_key", _TS),
    ("ph_level", _D),
    ("tds_level", _D),
    ("water_level", _I),
    ("air_temperature", _D),
    ("air_humidity", _D),
    ("water_temperature", _D),
    *[(name, _B) for name in ACTUATOR_NAMES],
    *[(name, _B) for name in INDICATORS],
    ("ingestion_timestamp", _TS),
    ("source_file", _S),
)
DIM_TIME_SCHEMA = _struct(
    ("timestamp_key", _TS),
    ("timestamp_full", _S),
    ("date", _S),
    ("time", _S),
    ("year", _I),
    ("quarter", _I),
    ("month", _I),
    ("week_of_year", _I),
    ("day_of_month", _I),
    ("day_of_week", _I),
    ("hour", _I),
    ("minute", _I),
    ("day_name", _S),
    ("month_name", _S),
    ("day_type", _S),
)
EQUIPMENT_SCHEMA = _struct(
    ("equipment_id", _L),
    ("equipment_code", _S),
    ("equipment_name", _S),
    ("equipment_description", _S),
)


def require_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Fail early when a job's output drifts from its layer schema (extra columns are fine)."""
    found = {field.name: field.dataType for field in df.schema.fields}
    wrong = [
        f"{field.name}: expected {field.dataType.simpleString()}, "
        f"found {found[field.name].simpleString() if field.name in found else 'nothing'}"
        for field in expected.fields
        if found.get(field.name) != field.dataType
    ]
    if wrong:
        raise ValueError("schema mismatch: " + "; ".join(wrong))
    return df
