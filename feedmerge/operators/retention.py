"""Expiry of whole days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmerge.functions.dates import DateLike, in_date_range


def expired(df: DataFrame, column: str, lower: DateLike, upper: DateLike) -> DataFrame:
    """Rows on the days to remove, both bounds included."""
    return df.where(in_date_range(df, column, lower, upper))


def kept(df: DataFrame, column: str, lower: DateLike, upper: DateLike) -> DataFrame:
    """Rows that survive; those without a date do.

    A plain predicate, so partitions and row groups of expired days are not read.
    """
    return df.where(~in_date_range(df, column, lower, upper) | F.col(column).isNull())
