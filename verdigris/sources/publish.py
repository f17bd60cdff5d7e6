"""Load gold tables into a warehouse, from the executors."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F, types as T

from verdigris.schemas import TIMESTAMP_FORMAT

# Column types on the warehouse side and rows per insert batch.
WAREHOUSE_TYPES = {
    "int": "INTEGER",
    "float": "FLOAT",
    "bool": "BOOLEAN",
    "timestamp": "TIMESTAMP_NTZ",
    "text": "VARCHAR(16777216)",
}
DIMENSION_BATCH = 1_000
FACT_BATCH = 10_000


def warehouse_type(field: T.StructField) -> str:
    """Warehouse type of one column.

    Text columns named like a timestamp were formatted by ``format_timestamps`` and load
    as timestamps.
    """
    kind = field.dataType
    if isinstance(kind, T.IntegralType):
        return WAREHOUSE_TYPES["int"]
    if isinstance(kind, T.FractionalType):
        return WAREHOUSE_TYPES["float"]
    if isinstance(kind, T.BooleanType):
        return WAREHOUSE_TYPES["bool"]
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return WAREHOUSE_TYPES["timestamp"]
    name = field.name.lower()
    if "timestamp" in name or name.endswith("_time"):
        return WAREHOUSE_TYPES["timestamp"]
    return WAREHOUSE_TYPES["text"]


def warehouse_columns(df: DataFrame) -> dict[str, str]:
    """Column name to warehouse type, in column order."""
    return {field.name: warehouse_type(field) for field in df.schema.fields}


def format_timestamps(df: DataFrame) -> DataFrame:
    """Every timestamp column as text to the second; null stays null."""
    kinds = (T.TimestampType, T.TimestampNTZType)
    return df.withColumns(
        {
            field.name: F.date_format(field.name, TIMESTAMP_FORMAT)
            for field in df.schema.fields
            if isinstance(field.dataType, kinds)
        }
    )


def publish_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    batch_size: int = FACT_BATCH,
    connections: int = 16,
) -> None:
    """Truncate the target (create it if absent) and insert in batches from each task.

    ``connections`` bounds the number of parallel sessions the warehouse has to serve.
    Truncate and load are not one transaction: readers may see a partly loaded table.
    """
    types = ", ".join(f"{name} {kind}" for name, kind in warehouse_columns(df).items())
    (
        format_timestamps(df)
        .write.mode("overwrite")
        .option("truncate", True)
        .option("batchsize", batch_size)
        .option("numPartitions", connections)
        .option("createTableColumnTypes", types)
        .jdbc(url, table, properties=dict(properties or {}))
    )


def publish_parquet(tables: Mapping[str, DataFrame], folder: str) -> dict[str, str]:
    """Publish as Parquet files, for warehouses that bulk-load from a stage."""
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{folder}/{name}"
        format_timestamps(df).write.mode("overwrite").parquet(paths[name])
    return paths


def verify_counts(
    source: Mapping[str, DataFrame], published: Mapping[str, DataFrame]
) -> DataFrame:
    """One row per table: source rows, published rows, and whether they agree."""
    sides = None
    for side, tables in (("source", source), ("published", published)):
        for name, df in tables.items():
            row = df.agg(F.count(F.lit(1)).alias("n")).select(
                F.lit(name).alias("table_name"),
                (F.col("n") if side == "source" else F.lit(0)).cast("long").alias("source_rows"),
                (F.col("n") if side == "published" else F.lit(0)).cast("long").alias("published_rows"),
            )
            sides = row if sides is None else sides.unionByName(row)
    return (
        sides.groupBy("table_name")
        .agg(
            F.sum("source_rows").alias("source_rows"),
            F.sum("published_rows").alias("published_rows"),
        )
        .withColumn("matches", F.col("source_rows") == F.col("published_rows"))
    )
