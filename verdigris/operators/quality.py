"""Data-quality checks. Each returns failures; none stops a job."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

REPORT_COLUMNS = ["table_name", "check_name", "column_name", "failed", "total", "status"]


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count. Null keys are not compared."""
    present = df
    for name in key:
        present = present.filter(F.col(name).isNotNull())
    return (
        present.groupBy(*key).agg(F.count(F.lit(1)).alias("occurrences")).filter("occurrences > 1")
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing values per column, all columns in one pass; one row per column."""
    counted = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(name).isNull()).alias(name) for name in columns],
    )
    return counted.unpivot(["total"], list(columns), "column_name", "failed").select(
        "column_name", "failed", "total"
    )


def _outside(column: str, low: float | None, high: float | None) -> Column:
    value = F.col(column)
    bad = F.lit(False)
    if low is not None:
        bad = bad | (value < low)
    if high is not None:
        bad = bad | (value > high)
    return F.coalesce(bad, F.lit(False))


def out_of_range(df: DataFrame, column: str, low: float | None, high: float | None) -> DataFrame:
    """Number of present values outside the inclusive range."""
    return df.agg(
        F.lit(column).alias("column_name"),
        F.count_if(_outside(column, low, high)).alias("failed"),
        F.count(F.lit(1)).alias("total"),
    )


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child keys without a parent, with the number of child rows.

    Child rows are counted per key before the anti join, so a hot key joins as one row.
    """
    counted = child.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("child_rows")
    )
    return counted.join(parent.select(key), key, "left_anti")


@dataclass(frozen=True)
class Checks:
    """Checks of one table. A reference names a column and the frame that must hold its values."""

    not_null: Sequence[str] = ()
    ranges: Sequence[tuple[str, float | None, float | None]] = ()
    unique: Sequence[Sequence[str]] = ()
    references: Sequence[tuple[str, DataFrame]] = field(default_factory=tuple)


# What a check counts: rows, failing rows, or groups of equal keys.
_ROWS, _FAILS, _KEYS, _LINKS = "rows", "fails", "keys", "links"


def _entry(check: int, rows: int, parents: int, *key: str) -> Column:
    """What one row adds to a check: a child row or a parent row of a key (none for plain counts)."""
    return F.struct(
        F.lit(check).alias("check_id"),
        F.lit(rows).alias("rows"),
        F.lit(parents).alias("parents"),
        F.array(*[F.col(name).cast("string") for name in key]).cast("array<string>").alias("key"),
    )


def _labelled(tables: dict[str, tuple[DataFrame, Checks]]):
    """Labels of all checks, and for each frame to read what its rows add to them."""
    labels: list[tuple[int, str, str, str, str]] = []
    frames: dict[int, tuple[DataFrame, list[Column]]] = {}

    def check(table: str, name: str, column: str, kind: str) -> int:
        labels.append((len(labels), table, name, column, kind))
        return len(labels) - 1

    def add(df: DataFrame, *entries: Column) -> None:
        frames.setdefault(id(df), (df, []))[1].extend(entries)

    for table, (df, checks) in tables.items():
        add(df, _entry(check(table, _ROWS, "", _ROWS), 1, 0))
        for column in checks.not_null:
            number = check(table, "not_null", column, _FAILS)
            add(df, F.when(F.col(column).isNull(), _entry(number, 1, 0)))
        for column, low, high in checks.ranges:
            number = check(table, "accepted_range", column, _FAILS)
            add(df, F.when(_outside(column, low, high), _entry(number, 1, 0)))
        for key in checks.unique:
            add(df, _entry(check(table, "unique", ",".join(key), _KEYS), 1, 0, *key))
        for column, parent in checks.references:
            number = check(table, "referential", column, _LINKS)
            add(df, _entry(number, 1, 0, column))
            add(parent, _entry(number, 0, 1, column))
    return labels, list(frames.values())


def dq_report(tables: dict[str, tuple[DataFrame, Checks]]) -> DataFrame:
    """All checks of all tables: one row per check with failed and total rows.

    Every table is read once, also if it is the parent of a reference. A row is expanded into
    what it adds to each check: a failed one, or a key to compare. All of it is counted per
    check and key in one shuffle, after a partial count in each task, so plain counts and hot
    keys leave a task as one row. Null keys are not compared.
    """
    labels, frames = _labelled(tables)
    facts = None
    for df, entries in frames:
        added = df.select(F.explode(F.filter(F.array(*entries), lambda x: x.isNotNull())).alias("e")).select("e.*")
        facts = added if facts is None else facts.union(added)
    spark = facts.sparkSession
    names = spark.createDataFrame(labels, "check_id int, table_name string, check_name string, column_name string, kind string")
    kinds = F.create_map(*[F.lit(x) for number, *_, kind in labels for x in (number, kind)])
    groups = facts.groupBy("check_id", "key").agg(F.sum("rows").alias("n"), F.sum("parents").alias("parents"))
    present = ~F.exists("key", lambda part: part.isNull())
    kind = kinds[F.col("check_id")]
    failed = (
        F.when(kind == _KEYS, (present & (F.col("n") > 1)).cast("long"))
        .when(kind == _LINKS, F.when(present & (F.col("parents") == 0), F.col("n")).otherwise(0))
        .otherwise(F.col("n"))
    )
    counted = groups.groupBy("check_id").agg(F.sum(failed).alias("found"))
    # A check without any row has found nothing. One row a check from here on.
    found = names.join(counted, "check_id", "left").withColumn("found", F.coalesce("found", F.lit(0).cast("long")))
    total = F.max(F.when(F.col("kind") == _ROWS, F.col("found"))).over(Window.partitionBy("table_name"))
    report = found.select("*", total.alias("total")).filter(F.col("kind") != _ROWS)
    status = F.when(F.col("found") > 0, "fail").otherwise("pass")
    return report.select(
        "table_name", "check_name", "column_name", F.col("found").alias("failed"), "total", status.alias("status")
    ).select(*REPORT_COLUMNS)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
