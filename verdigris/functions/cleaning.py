"""Text to typed values. Bad text becomes null, it never fails a job."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from verdigris.schemas import TIMESTAMP_FORMAT

# Accepted spellings of a boolean.
TRUE_WORDS = ["true", "t", "yes", "y", "on", "1"]
FALSE_WORDS = ["false", "f", "no", "n", "off", "0"]


def to_double(text: Column) -> Column:
    """Strip double quotes, then parse; empty and unparsable text give null."""
    return F.replace(text, F.lit('"'), F.lit("")).try_cast("double")


def to_int(text: Column) -> Column:
    """As ``to_double``, truncated: ``7.0`` is 7, which a direct integer cast rejects."""
    return to_double(text).try_cast("int")


def onoff_to_bool(text: Column) -> Column:
    """ON / OFF in any case, surrounded by blanks or not; anything else is null."""
    word = F.upper(F.trim(text))
    return F.when(word == "ON", True).when(word == "OFF", False)


def parse_timestamp(text: Column) -> Column:
    """Second-precision wall-clock text in the session time zone (UTC)."""
    return F.try_to_timestamp(text, F.lit(TIMESTAMP_FORMAT))


def parse_bool_text(text: Column) -> Column:
    """Boolean words in any case; unknown words give null."""
    word = F.lower(F.trim(text.cast("string")))
    return F.when(word.isin(TRUE_WORDS), True).when(word.isin(FALSE_WORDS), False)


def bool_to_int(flag: Column) -> Column:
    """true / false / null as 1 / 0 / null."""
    return flag.cast("int")


def is_finite(value: Column) -> Column:
    """True for a number that is neither null, NaN nor infinite."""
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))
