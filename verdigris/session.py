"""Session construction and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on. ANSI mode stays at the Spark default (on):
# dirty input goes through try_* functions instead of weaker cast rules.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

_local_folder: str | None = None


def build_session(
    app_name: str = "verdigris",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Create or reuse a session. ``settings`` wins over the defaults above."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session time zone; every calendar attribute is defined in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster it would
    be private to one machine and its content would be lost with that machine.
    """
    global _local_folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="verdigris-")
    return _local_folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, grouped by application."""
    app = spark.conf.get("spark.app.id", "app")
    return f"{shared_folder(spark)}/verdigris/{app}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    This cuts lineage (a lost executor re-reads files, it does not recompute), pins
    the outcome of non-deterministic columns, and keeps column pruning for readers.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
