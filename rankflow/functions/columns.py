"""Scalar expressions shared by the rankings, the pair features and the classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def booking_weight(flag: Column | str, booked: int, base: int = 3) -> Column:
    """Linear popularity weight: ``base`` for any interaction, ``booked`` more for a booking."""
    return _col(flag) * booked + base


def scaled_key(value: Column | str, scale: int) -> Column:
    """A floating-point measure as an exact integer join key.

    Both sides of a join must use the same call. Rounding after widening to double makes the
    key independent of how a product would be rounded in 32 bits. NaN and infinity give null,
    which matches nothing.
    """
    return F.round(_col(value).cast("double") * scale).try_cast("bigint")


def in_year(ts: Column | str, year: int, dtype: str = "timestamp_ntz") -> Column:
    """``year(ts) = year`` written as a half-open range, which reaches the Parquet scan.

    ``dtype`` must be the column's own type, or the column is cast and the pushdown is lost.
    """
    ts = _col(ts)
    start = F.lit(f"{year:04d}-01-01 00:00:00").cast(dtype)
    end = F.lit(f"{year + 1:04d}-01-01 00:00:00").cast(dtype)
    return (ts >= start) & (ts < end)


def text_length(text: Column | str) -> Column:
    """Length in characters; a missing text has length 0."""
    return F.length(F.coalesce(_col(text), F.lit("")))


def with_default(value: Column | str, default: str) -> Column:
    """Replace null and the empty string. Current CSV readers give null for an empty field."""
    return F.coalesce(F.nullif(_col(value), F.lit("")), F.lit(default))


def suffix_columns(df: DataFrame, suffix: str) -> DataFrame:
    """Every column renamed to ``name + suffix``, in one projection."""
    return df.withColumnsRenamed({c: c + suffix for c in df.columns})
