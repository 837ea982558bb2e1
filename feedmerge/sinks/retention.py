"""Removal of expired day partitions without reading or rewriting any data."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from feedmerge.functions.dates import DateLike, parse_day
from feedmerge.sources.files import child_names
from feedmerge.sources.ledger import guarded_days


def _day_of(name: str) -> dt.date | None:
    """Day of a folder named ``yyyyMMdd``, ``yyyy-MM-dd`` or ``column=yyyy-MM-dd``."""
    text = name.rpartition("=")[2]
    if len(text) not in (8, 10):
        return None
    try:
        return dt.date.fromisoformat(text)
    except ValueError:
        return None


def expired_names(names: list[str], lower: DateLike, upper: DateLike) -> list[str]:
    lo, hi = parse_day(lower), parse_day(upper)
    return [n for n in names if (day := _day_of(n)) is not None and lo <= day <= hi]


def remove_days(
    spark: SparkSession,
    base: str,
    lower: DateLike,
    upper: DateLike,
    skip_trash: bool = True,
    ledger: DataFrame | None = None,
) -> list[str]:
    """Delete the day folders below ``base`` from ``lower`` to ``upper``, inclusive.

    With ``skip_trash`` off they go to the file system's trash when it has one.
    Given the ``ledger`` of the feed's runs, days that hold a run no merge has taken stay, and so
    do days it does not know; ``guarded_days`` names the reasons. Returns the names removed.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    fs = jvm.org.apache.hadoop.fs.Path(base).getFileSystem(conf)
    removed = expired_names(child_names(spark, base), lower, upper)
    if ledger is not None:
        # one row for each day of the range
        free = {r.runday for r in guarded_days(ledger, lower, upper).where("reason is null").collect()}
        removed = [n for n in removed if _day_of(n) in free]
    for name in removed:
        path = jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{name}")
        trashed = not skip_trash and jvm.org.apache.hadoop.fs.Trash.moveToAppropriateTrash(
            fs, path, conf
        )
        if not trashed:
            fs.delete(path, True)
    return removed


def drop_table_days(
    spark: SparkSession, table: str, column: str, lower: DateLike, upper: DateLike
) -> list[str]:
    """The same for a catalog table partitioned by a day column."""
    listed = [row[0] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    removed = expired_names([n for n in listed if n.startswith(f"{column}=")], lower, upper)
    if removed:
        specs = ", ".join(f"PARTITION ({column} = '{n.partition('=')[2]}')" for n in removed)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")
    return removed
