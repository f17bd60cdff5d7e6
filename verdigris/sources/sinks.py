"""Writers. Each layer goes to a Parquet path, a named table, or both."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from verdigris.sources.scans import union_sources

# Quoting that the CSV scan reads back unchanged, blanks included.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def _clustered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Gather each output partition's rows before a partitioned write.

    Without it every task writes a file into every partition. The rebalance hint lets
    adaptive execution split a partition value that holds much of the data over several
    tasks and merge small ones, so a hot day does not end up in one task.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()
) -> str:
    """Snappy Parquet, appended or fully refreshed."""
    writer = _clustered(df, partition_by).write.mode(mode).option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def ensure_namespace(spark: SparkSession, name: str, default: str = "default") -> str:
    """Create the namespace a one-, two- or three-part table name needs; return the full name."""
    parts = name.split(".")
    if len(parts) == 1:
        parts = [default, name]
    namespace = ".".join(f"`{part}`" for part in parts[:-1])
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace}")
    return ".".join(parts)


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    path: str | None = None,
    partition_by: Sequence[str] = (),
    namespace: str = "default",
) -> str:
    """Write a named table.

    ``overwrite`` replaces rows and schema. ``append`` merges schemas: a column the table
    lacks is added to it first, a column ``df`` lacks is filled with null.
    """
    spark = df.sparkSession
    full = ensure_namespace(spark, name, namespace)
    if mode == "append" and spark.catalog.tableExists(full):
        known = {field.name.lower() for field in spark.table(full).schema.fields}
        added = [field for field in df.schema.fields if field.name.lower() not in known]
        if added:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
            spark.sql(f"ALTER TABLE {_quoted(full)} ADD COLUMNS ({columns})")
        table = spark.table(full)
        aligned = union_sources(table.limit(0), df).select(*table.columns)
        aligned.write.insertInto(full)
        return full
    writer = _clustered(df, partition_by).write.mode(mode).format("parquet")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(full)
    return full


def register_table(spark: SparkSession, name: str, path: str, partition_by: Sequence[str] = ()) -> str:
    """Name the Parquet files below ``path``: an external table, replaced if it exists.

    Only an external table is replaced; a table that owns its files is refused.
    """
    full = ensure_namespace(spark, name)
    if spark.catalog.tableExists(full):
        if spark.catalog.getTable(full).tableType != "EXTERNAL":
            raise ValueError(f"{full} owns its files")
        spark.sql(f"DROP TABLE {_quoted(full)}")
    location = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {_quoted(full)} USING parquet LOCATION '{location}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {_quoted(full)}")
    return full


def write_layer(
    df: DataFrame, path: str, table: str, mode: str = "overwrite", partition_by: Sequence[str] = ()
) -> DataFrame:
    """Write a layer to its path and name it: one copy, so path and table cannot differ.

    Returns the reader of the path.
    """
    write_parquet(df, path, mode, partition_by)
    register_table(df.sparkSession, table, path, partition_by)
    return df.sparkSession.read.parquet(path)


def export_csv(df: DataFrame, path: str) -> str:
    """Result set to headed CSV part files, written by the executors."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    return path
