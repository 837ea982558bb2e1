"""Date helpers that stay typed: text is parsed once and never compared with dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DateLike = dt.date | str


def parse_day(value: DateLike) -> dt.date:
    """Accepts a date, ``yyyy-MM-dd`` or ``yyyyMMdd``."""
    if isinstance(value, dt.datetime):
        return value.date()
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def as_date(column: Column | str, written: bool = False) -> Column:
    """Date of a date, timestamp or ISO text; anything unreadable is null.

    Text with a time is an instant, so it is dated in the session's zone like a
    timestamp, whatever zone it was written in. ``written`` dates text by its first
    ten characters instead.
    """
    column = F.col(column) if isinstance(column, str) else column
    day = column.try_cast("date")
    return day if written else F.coalesce(column.try_cast("timestamp").cast("date"), day)


def compact_date(column: Column | str) -> Column:
    return F.date_format(as_date(column), "yyyyMMdd")


def in_date_range(df: DataFrame, column: str, lower: DateLike, upper: DateLike) -> Column:
    """``column`` falls on a day from ``lower`` to ``upper``, both included.

    Timestamps are compared as a half-open range on the stored column, which
    reaches the parquet row-group statistics; a date cast around it would not.
    """
    lo, hi = parse_day(lower), parse_day(upper)
    kind = df.schema[column].dataType.typeName()
    if kind in ("timestamp", "timestamp_ntz"):
        first = F.lit(lo).cast(kind)
        after = F.lit(hi + dt.timedelta(days=1)).cast(kind)
        return (F.col(column) >= first) & (F.col(column) < after)
    day = F.col(column) if kind == "date" else as_date(column)
    return day.between(F.lit(lo), F.lit(hi))


def date_series(spark: SparkSession, lower: DateLike, upper: DateLike) -> DataFrame:
    """One row per day from ``lower`` to ``upper``, both included."""
    lo, hi = parse_day(lower), parse_day(upper)
    if lo > hi:
        return spark.range(0).select(F.lit(lo).alias("day"))
    days = F.sequence(F.lit(lo), F.lit(hi), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("day"))


def run_window(day: Column | str) -> dict[str, Column]:
    """Default arguments of a scheduled run, from its logical day."""
    day = as_date(day)
    return {
        "exec_date": F.date_sub(day, 1),
        "lower_bound": F.date_sub(day, 30),
        "expire_from": F.date_sub(day, 10),
        "expire_to": F.date_sub(day, 1),
    }
