"""Readers for raw files, layer paths and named tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from verdigris.schemas import ENVELOPE_SCHEMA, RAW_COLUMNS, RAW_SCHEMA


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RAW_SCHEMA,
    keep_malformed: bool = False,
) -> DataFrame:
    """Headed CSV with ``"`` as quote and escape; every column is read as text.

    ``keep_malformed`` adds ``_corrupt_record`` with the source line of rows whose number
    of fields is wrong.
    """
    if keep_malformed:
        schema = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )


def scan_json(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Landed request bodies: one JSON document per file, or JSON lines.

    The explicit schema avoids an inference pass over all files and keeps a column
    that no file mentions. Multi-line files cannot be split and should stay small; large
    landings belong in JSON lines (``multi_line=False``).
    """
    return spark.read.schema(ENVELOPE_SCHEMA).option("multiLine", multi_line).json(path)


def explode_envelope(envelopes: DataFrame) -> DataFrame:
    """One row per record, whether a file holds ``{"records": [...]}`` or a bare record.

    Both kinds may be mixed in one folder; no record of either kind is lost.
    """
    bare = F.array(F.struct(*[F.col(name) for name in RAW_COLUMNS]))
    return envelopes.select(F.explode(F.coalesce("records", bare)).alias("record")).select("record.*")


def normalize_strings(df: DataFrame) -> DataFrame:
    """The thirteen raw columns as text, in order; absent columns become null."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(name) if name in present else F.lit(None)).cast("string").alias(name)
            for name in RAW_COLUMNS
        ]
    )


def add_ingest_metadata(
    df: DataFrame, source: str | Column, ingested_at: datetime | Column | None = None
) -> DataFrame:
    """Ingestion time and source name.

    Pass ``ingested_at`` to give every table of one run the same instant.
    """
    if ingested_at is None:
        ingested_at = F.current_timestamp()
    elif isinstance(ingested_at, datetime):
        ingested_at = F.lit(ingested_at)
    name = F.lit(source) if isinstance(source, str) else source
    return df.withColumns(
        {"ingestion_timestamp": ingested_at.cast("timestamp"), "source_file": name}
    )


def ingest_csv(
    spark: SparkSession, path: str, ingested_at: datetime | None = None
) -> DataFrame:
    """CSV files to bronze rows, tagged with the name of the file they came from."""
    raw = scan_csv(spark, path).withColumn("_file", F.col("_metadata.file_name"))
    return add_ingest_metadata(raw, F.col("_file"), ingested_at).drop("_file")


def ingest_json(
    spark: SparkSession,
    path: str,
    source: str = "api_ingestion",
    ingested_at: datetime | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Landed JSON files to bronze rows."""
    rows = normalize_strings(explode_envelope(scan_json(spark, path, multi_line)))
    return add_ingest_metadata(rows, source, ingested_at)


def union_sources(*bronze: DataFrame) -> DataFrame:
    """Bag union by name; a column one source lacks is null there."""
    result = bronze[0]
    for other in bronze[1:]:
        result = result.unionByName(other, allowMissingColumns=True)
    return result


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """A named table, addressed with one, two or three name parts."""
    return spark.table(name)


def scan_parquet_or_table(
    spark: SparkSession, path: str, table: str, merge_schema: bool = False
) -> DataFrame:
    """Prefer the layer's Parquet path; use the table when the path does not exist.

    Only a missing path or one without files falls through. Failures that may be
    transient, such as denied access or a lost node, are raised.
    """
    try:
        return spark.read.option("mergeSchema", merge_schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.table(table)
