"""Scans that lose nothing: what does not fit the schema is kept as text beside the row.

``_rescued`` holds the source line of a record that could not be read, or the fields the
schema does not know as JSON; it is null where all of a record was read. ``_broken`` tells
the first from the second. Broken records are routed to a quarantine table, from which the
source line can be recovered byte for byte; the plain scans turn them into rows of nulls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from verdigris.schemas import ENVELOPE_SCHEMA, RAW_COLUMNS, RAW_SCHEMA
from verdigris.session import materialize
from verdigris.sources.scans import scan_csv
from verdigris.sources.sinks import write_parquet

RESCUED, BROKEN, FILE = "_rescued", "_broken", "_file"
_LINE = "_line"


def rescue_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """Headed CSV; a line with too few or too many fields is broken."""
    rows = scan_csv(spark, path, schema, keep_malformed=True)
    return rows.select(
        *schema.names,
        F.col("_corrupt_record").alias(RESCUED),
        F.col("_corrupt_record").isNotNull().alias(BROKEN),
        F.col("_metadata.file_name").alias(FILE),
    )


def _unknown(fields: Column) -> Column:
    """Fields that are no raw column."""
    return F.map_filter(fields, lambda name, _: ~name.isin([*RAW_COLUMNS, "records"]))


def rescue_json(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Landed bodies, one a line (or a file), batches and bare records mixed.

    A body that is no JSON object, or whose records are no list of objects, is broken as a
    whole. Unknown fields of a batch are kept with each of its records.
    """
    lines = spark.read.text(path, wholetext=multi_line).select(
        F.col("value").alias(_LINE), F.col("_metadata.file_name").alias(FILE)
    )
    lines = lines.filter(F.trim(_LINE) != "")
    marked = T.StructType([*ENVELOPE_SCHEMA.fields, T.StructField(_LINE, T.StringType())])
    every = "map<string, string>"
    parsed = lines.select(
        _LINE,
        FILE,
        F.from_json(_LINE, marked, {"columnNameOfCorruptRecord": _LINE}).alias("body"),
        F.from_json(_LINE, T.MapType(T.StringType(), T.StringType())).alias("fields"),
        F.from_json(_LINE, f"records array<{every}>")["records"].alias("listed"),
    )
    body = F.col("body")
    broken = body.isNull() | body[_LINE].isNotNull()
    none = F.lit(None).cast(every)
    record = lambda source: F.struct(*[source[name].alias(name) for name in RAW_COLUMNS])
    row = lambda source, fields: F.struct(record(source).alias("record"), fields.alias("unknown"))
    single = F.array(row(body, F.when(~broken, _unknown(F.col("fields"))).otherwise(none)))
    listed = F.zip_with(
        body["records"],
        F.col("listed"),
        lambda source, fields: row(source, F.map_concat(_unknown(F.col("fields")), _unknown(fields))),
    )
    rows = F.when(broken | body["records"].isNull(), single).otherwise(listed)
    found = parsed.select(_LINE, FILE, broken.alias(BROKEN), F.explode(rows).alias("row"))
    unknown = F.when(F.size("row.unknown") > 0, F.to_json("row.unknown"))
    return found.select("row.record.*", F.when(F.col(BROKEN), F.col(_LINE)).otherwise(unknown).alias(RESCUED), BROKEN, FILE)


def route_rescued(rows: DataFrame, quarantine: str) -> DataFrame:
    """Append broken records to the quarantine path; returns the others, unknown fields kept."""
    stored = materialize(rows, "rescued")
    write_parquet(stored.filter(BROKEN).select(FILE, RESCUED), quarantine, "append")
    return stored.filter(~F.col(BROKEN)).drop(BROKEN)
