"""Bronze to silver: type, validate, keep the latest copy."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from verdigris.functions.cleaning import onoff_to_bool, parse_timestamp, to_double, to_int
from verdigris.schemas import ACTUATORS, PHYSICAL_RANGES


def silver_project(bronze: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed bronze. ``keep`` carries further columns (such as a device key) along."""
    return bronze.select(
        F.col("id").try_cast("bigint").alias("id"),
        parse_timestamp(F.col("timestamp")).alias("timestamp"),
        to_double(F.col("pH")).alias("pH"),
        to_double(F.col("TDS")).alias("TDS"),
        to_int(F.col("water_level")).alias("water_level"),
        to_double(F.col("DHT_temp")).alias("DHT_temp"),
        to_double(F.col("DHT_humidity")).alias("DHT_humidity"),
        to_double(F.col("water_temp")).alias("water_temp"),
        *[onoff_to_bool(F.col(name)).alias(name) for name in ACTUATORS],
        "ingestion_timestamp",
        "source_file",
        *keep,
    )


def _out_of_range(name: str) -> Column:
    low, high = PHYSICAL_RANGES[name]
    value = F.col(name)
    outside = F.lit(False)
    if low is not None:
        outside = outside | (value < low)
    if high is not None:
        outside = outside | (value > high)
    return F.coalesce(outside, F.lit(False))


def reject_reason() -> Column:
    """First rule a typed row breaks, null for a valid row."""
    reason = F.when(F.col("id").isNull(), "id missing").when(
        F.col("timestamp").isNull(), "timestamp missing"
    )
    for name in PHYSICAL_RANGES:
        reason = reason.when(_out_of_range(name), f"{name} out of range")
    return reason


def is_valid() -> Column:
    """Keys present, every measure missing or inside its physical range."""
    valid = F.col("id").isNotNull() & F.col("timestamp").isNotNull()
    for name in PHYSICAL_RANGES:
        valid = valid & ~_out_of_range(name)
    return valid


def silver_validate(typed: DataFrame) -> DataFrame:
    """The valid rows."""
    return typed.filter(is_valid())


def validate_once(typed: DataFrame) -> DataFrame:
    """``silver_validate(typed)`` with every text field parsed once, for streams as well.

    A filter on parsed columns is pushed below the parsing and repeats it for each comparison;
    it is not pushed below a generator, here one of a single row. Columns that are not needed
    should be left out before, since the generator reads all of them.
    """
    row = F.array(F.struct(*typed.columns))
    return silver_validate(typed.select(F.explode(row).alias("_row")).select("_row.*"))


def silver_rejects(typed: DataFrame) -> DataFrame:
    """The rows ``silver_validate`` leaves out, with the reason."""
    return typed.withColumn("reason", reject_reason()).filter(F.col("reason").isNotNull())


def _latest_first(rows: DataFrame, *before: Column) -> DataFrame:
    """Add ``_rank``: 1 for the latest ingestion per (id, timestamp).

    Full ties are broken by source and then by row content, so reruns agree.
    """
    window = Window.partitionBy("id", "timestamp").orderBy(
        *before, F.desc("ingestion_timestamp"), F.desc("source_file"), F.desc("_content")
    )
    content = [name for name in rows.columns if not name.startswith("_")]
    return (
        rows.withColumn("_content", F.xxhash64(*content))
        .withColumn("_rank", F.row_number().over(window))
        .drop("_content")
    )


def silver_dedup(valid: DataFrame) -> DataFrame:
    """Latest ingestion per (id, timestamp).

    The rank filter becomes a group limit that runs before the shuffle as well: a key
    with very many copies leaves each task as one row.
    """
    return _latest_first(valid).filter(F.col("_rank") == 1).drop("_rank")


def validate_and_dedup(typed: DataFrame) -> DataFrame:
    """``silver_dedup(silver_validate(typed))`` with every text field parsed once.

    A plain filter on parsed columns is pushed below the parsing and repeats it for each
    comparison. Here validity is a column that ranks first: the top row of a key is valid
    if any of its rows is, and is then the latest valid one.
    """
    ranked = _latest_first(typed.withColumn("_valid", is_valid()), F.desc("_valid"))
    return ranked.filter((F.col("_rank") == 1) & F.col("_valid")).drop("_rank", "_valid")


def build_silver(
    bronze: DataFrame,
    keep: tuple[str, ...] = (),
    processed_at: datetime | None = None,
) -> DataFrame:
    """Project, validate and deduplicate; ``processed_at`` adds the processing time."""
    silver = validate_and_dedup(silver_project(bronze, keep))
    if processed_at is not None:
        silver = silver.withColumn("silver_processed_timestamp", F.lit(processed_at))
    return silver
