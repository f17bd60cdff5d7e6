"""Row counts observed while a table is written, kept beside it.

The count is a metric of the write itself, so no plan runs twice for it. A stage that has to
be repeated after an executor was lost may report rows again; ``stored_rows`` reads the exact
figure from the file footers, without any column, where a count does not agree.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from verdigris.sources.publish import format_timestamps
from verdigris.sources.sinks import write_parquet

COUNTS_SCHEMA = "table_name string, row_count long"


def watch(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df``, and the number of its rows once a write has run over it (see ``seen``)."""
    observation = Observation(f"rows-{uuid.uuid4().hex}")
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def seen(observation: Observation) -> int:
    """The observed rows; a plan that was found to be empty reports nothing."""
    return int(observation.get.get("rows") or 0)


def stored_rows(spark: SparkSession, path: str) -> int:
    return spark.read.parquet(path).count()


def write_counted(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()
) -> int:
    """``write_parquet``, returning the rows written."""
    watched, observation = watch(df)
    write_parquet(watched, path, mode, partition_by)
    return seen(observation)


def record_count(spark: SparkSession, folder: str, table: str, rows: int, mode: str = "overwrite") -> None:
    """Keep the rows of one write; those of appended writes add up."""
    frame = spark.createDataFrame([(table, rows)], COUNTS_SCHEMA)
    frame.coalesce(1).write.mode(mode).parquet(f"{folder}/{table}")


def recorded_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of every table written below a lake, from what its writes observed."""
    kept = spark.read.schema(COUNTS_SCHEMA).option("recursiveFileLookup", True).parquet(folder)
    return kept.groupBy("table_name").agg(F.sum("row_count").alias("row_count"))


def count_while_writing(tables: Mapping[str, DataFrame], folder: str) -> DataFrame:
    """Write each table below ``folder`` and return its observed rows."""
    rows = [(name, write_counted(df, f"{folder}/{name}")) for name, df in tables.items()]
    return next(iter(tables.values())).sparkSession.createDataFrame(rows, COUNTS_SCHEMA)


def publish_verified(
    tables: Mapping[str, DataFrame], folder: str, sources: Mapping[str, Observation] | None = None
) -> tuple[dict[str, str], DataFrame]:
    """Publish as Parquet and compare the rows of source and target, each source read once.

    Source rows are observed in the write: those that enter it or, for the names in
    ``sources``, those that an observation further up the plan has seen. Published rows come
    from the footers of the files. Returns the paths and one row for each table.
    """
    spark = next(iter(tables.values())).sparkSession
    paths, rows = {}, []
    for name, df in tables.items():
        paths[name] = f"{folder}/{name}"
        written = write_counted(format_timestamps(df), paths[name])
        source = seen(sources[name]) if sources and name in sources else written
        published = stored_rows(spark, paths[name])
        rows.append((name, source, published, source == published))
    schema = "table_name string, source_rows long, published_rows long, matches boolean"
    return paths, spark.createDataFrame(rows, schema)
