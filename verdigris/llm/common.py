"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Runs of these bytes separate words wherever a contract counts words: space and \t \n \v \f \r.
NOT_BLANK = "[^\\x20\\x09-\\x0D]+"


def table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(key: str, folds: int) -> Column:
    """crc32 of the key's text modulo ``folds``; a null key falls in fold 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds, F.lit(0))


def unused(df: DataFrame, *names: str) -> list[str]:
    """Working column names that no column of ``df`` has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def without(df: DataFrame, names: Sequence[str]) -> list[Column]:
    """All columns but those about to be replaced by an output of the same name."""
    drop = {n.lower() for n in names}
    return [F.col(f"`{c}`") for c in df.columns if c.lower() not in drop]


def row_hash(df: DataFrame) -> Column:
    """64-bit content hash of a whole row, the same on every run."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends on ``parts`` alone."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))
