"""Feature selection, labels, imputation, splits, weights and scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from verdigris.functions.classify import all_true
from verdigris.schemas import INDICATORS

# The label, and the measures it is derived from.
LABEL = "is_env_optimal"
LABEL_SOURCES = [*INDICATORS, "ph_level", "tds_level", "air_temperature", "air_humidity"]
SEED = 42


def env_label(features: DataFrame) -> DataFrame:
    """Add the label: 1 when all four indicators are 1, else (also when missing) 0."""
    missing = [name for name in INDICATORS if name not in features.columns]
    if missing:
        raise ValueError(f"indicator columns not found: {missing}")
    return features.withColumn(LABEL, all_true(*[F.col(n) == 1 for n in INDICATORS]).cast("int"))


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns in schema order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def feature_names(
    df: DataFrame, target: str = LABEL, with_id: bool = False, exclude: Sequence[str] = ()
) -> list[str]:
    """Numeric columns a model may use for ``target``.

    The combined label excludes the columns it is computed from. The row id is left out
    unless ``with_id`` asks for the historic feature list.
    """
    dropped = {target, "position", *exclude}
    if target == LABEL:
        dropped.update(LABEL_SOURCES)
    if not with_id:
        dropped.add("reading_id")
    return [name for name in numeric_columns(df) if name not in dropped]


def check_features(df: DataFrame, declared: Sequence[str], expected: int | None = None) -> None:
    """Raise when declared features are absent or their number is not the model's."""
    missing = [name for name in declared if name not in df.columns]
    if missing:
        raise ValueError(f"missing features: {missing}")
    if expected is not None and len(declared) != expected:
        raise ValueError(f"feature count mismatch: model expects {expected}, got {len(declared)}")


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing features to 0, as 32-bit values."""
    zero = F.lit(0).cast("float")
    return df.withColumns({n: F.coalesce(F.col(n).cast("float"), zero) for n in columns})


def _bucket(key: Sequence[str], seed: int) -> Column:
    """0 to 999 from the MD5 of the seed and the key's text, which any SQL engine can state."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(name).cast("string") for name in key])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint") % 1000


def hash_split(
    df: DataFrame, key: Sequence[str], test_size: float = 0.2, seed: int = SEED
) -> DataFrame:
    """Add ``is_train`` from a seeded hash of the row key: stable under repartitioning."""
    return df.withColumn("is_train", _bucket(key, seed) >= int(round(test_size * 1000)))


def holdout(
    df: DataFrame, key: Sequence[str], share: float = 0.2, seed: int = SEED + 1
) -> DataFrame:
    """Add ``is_validation`` for ``share`` of the training rows."""
    chosen = _bucket(key, seed) < int(round(share * 1000))
    return df.withColumn("is_validation", F.col("is_train") & chosen)


def mean_fill(
    df: DataFrame, columns: Sequence[str], within: Column | None = None
) -> DataFrame:
    """Missing values to the column mean, taken over ``within`` rows (default: all).

    The means are one row, joined as literals through a scalar subquery.
    """
    source = df if within is None else df.filter(within)
    means = source.agg(F.struct(*[F.avg(n).alias(n) for n in columns]).alias("m")).scalar()
    return df.withColumn("_means", means).select(
        *[
            F.coalesce(F.col(n).cast("double"), F.col(f"_means.{n}")).alias(n)
            if n in columns
            else F.col(n)
            for n in df.columns
        ]
    )


def prepare_tabular(
    df: DataFrame,
    target: str,
    columns: Sequence[str],
    key: Sequence[str],
    test_size: float = 0.2,
    seed: int = SEED,
    fill_from_all: bool = False,
) -> DataFrame:
    """Key, imputed features, target and ``is_train``.

    Means come from training rows only; ``fill_from_all`` uses every row.
    """
    split = hash_split(df.select(*key, *[c for c in columns if c not in key], target), key, test_size, seed)
    return mean_fill(split, columns, None if fill_from_all else F.col("is_train"))


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Balanced weight per class, ``n / (classes * n_class)``.

    Two classes get weights only when one has less than a tenth of the rows, otherwise 1.
    """
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(
        F.struct(
            F.sum("n").alias("rows"),
            F.count(F.lit(1)).alias("classes"),
            F.sum(F.when(F.col(label) == 1, F.col("n")).otherwise(0)).alias("positive"),
        )
    ).scalar()
    rows, classes = F.col("_t.rows"), F.col("_t.classes")
    share = F.col("_t.positive") / rows
    balanced = (classes == 2) & ~((share < 0.1) | (share > 0.9))
    return counts.withColumn("_t", totals).select(
        label,
        F.col("n").alias("class_rows"),
        F.when(balanced, 1.0).otherwise(rows / (classes * F.col("n"))).alias("weight"),
    )


def standard_stats(
    df: DataFrame, columns: Sequence[str], weight: Column | None = None, sample: bool = False
) -> DataFrame:
    """One row with ``mean_*`` and ``std_*`` per column.

    ``weight`` counts a row several times without repeating it, as overlapping training
    windows do. Population deviation by default; ``sample`` gives the n-1 form. The
    second moment is taken around a pilot mean to keep its precision.
    """
    w = F.lit(1.0) if weight is None else weight.cast("double")
    base = df.select(w.alias("_w"), *[F.col(n).cast("double").alias(n) for n in columns])

    def mean(name: str) -> Column:
        present = F.when(F.col(name).isNotNull(), F.col("_w"))
        return F.sum(F.col("_w") * F.col(name)) / F.sum(present)

    pilot = base.agg(F.struct(*[mean(n).alias(n) for n in columns]).alias("p")).scalar()
    centred = base.withColumn("_p", pilot)
    out = []
    for n in columns:
        present = F.when(F.col(n).isNotNull(), F.col("_w"))
        count = F.sum(present) - (1 if sample else 0)
        squares = F.sum(F.col("_w") * F.pow(F.col(n) - F.col(f"_p.{n}"), F.lit(2.0)))
        out.append(F.max(f"_p.{n}").alias(f"mean_{n}"))
        out.append(F.sqrt(squares / count).alias(f"std_{n}"))
    return centred.agg(*out)


def minmax_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with ``min_*`` and ``max_*`` per column."""
    return df.agg(
        *[f(n).cast("double").alias(f"{p}_{n}") for n in columns for p, f in (("min", F.min), ("max", F.max))]
    )


def _with_stats(df: DataFrame, stats: DataFrame) -> DataFrame:
    packed = stats.select(F.struct(*stats.columns).alias("s")).scalar()
    return df.withColumn("_s", packed)


def _replace(df: DataFrame, columns: Sequence[str], build) -> list[Column]:
    return [build(n).alias(n) if n in columns else F.col(n) for n in df.columns]


def scale_standard(
    df: DataFrame, columns: Sequence[str], stats: DataFrame, epsilon: float | None = None
) -> DataFrame:
    """Z-scores. A zero deviation divides by 1; ``epsilon`` is added to it instead."""

    def score(n: str) -> Column:
        std = F.col(f"_s.std_{n}")
        if epsilon is None:
            divisor = F.when(std == 0, 1.0).otherwise(std)
        else:
            divisor = std + F.lit(epsilon)
        return (F.col(n).cast("double") - F.col(f"_s.mean_{n}")) / divisor

    return _with_stats(df, stats).select(*_replace(df, columns, score))


def inverse_standard(value: Column, mean: Column, std: Column) -> Column:
    """A z-score in original units."""
    return value * F.when(std == 0, 1.0).otherwise(std) + mean


def inverse_scale(df: DataFrame, columns: Sequence[str], stats: DataFrame) -> DataFrame:
    """Undo ``scale_standard``."""
    return _with_stats(df, stats).select(
        *_replace(
            df,
            columns,
            lambda n: inverse_standard(F.col(n), F.col(f"_s.mean_{n}"), F.col(f"_s.std_{n}")),
        )
    )


def scale_minmax(df: DataFrame, columns: Sequence[str], stats: DataFrame) -> DataFrame:
    """Values mapped to 0..1 by the given minima and maxima; a zero range divides by 1."""

    def score(n: str) -> Column:
        spread = F.col(f"_s.max_{n}") - F.col(f"_s.min_{n}")
        low = F.col(f"_s.min_{n}")
        return (F.col(n).cast("double") - low) / F.when(spread == 0, 1.0).otherwise(spread)

    return _with_stats(df, stats).select(*_replace(df, columns, score))
