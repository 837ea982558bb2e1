"""Parquet sinks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmerge.functions.dates import DateLike, as_date
from feedmerge.operators.latest import LOG_POSITION
from feedmerge.sources.files import FOLDER_DAY, RUN, day_path


def run_path(base: str, exec_date: DateLike, run_at: dt.datetime) -> str:
    """``base/yyyyMMdd/run=<UTC instant>``: sorts by time, also for runs after midnight."""
    if run_at.tzinfo is not None:
        run_at = run_at.astimezone(dt.timezone.utc)
    return f"{day_path(base, exec_date)}/{RUN}={run_at:%Y%m%dT%H%M%S%f}"


def write_run(
    df: DataFrame, path: str, day_of: str | None = None, day: str = FOLDER_DAY
) -> None:
    """Write one run, by day folders when ``day_of`` names the dating column.

    The rebalance hint gathers each day in few files and splits a day that is
    larger than a task should write.
    """
    if day_of is None:
        df.write.mode("overwrite").parquet(path)
        return
    dated = df.withColumn(day, as_date(day_of)).hint("rebalance", day)
    dated.write.mode("overwrite").partitionBy(day).parquet(path)


def write_clustered(
    df: DataFrame,
    path: str,
    key: str,
    files: int,
    day_of: str | None = None,
    tie: Sequence[str] = LOG_POSITION,
    block_bytes: int | None = None,
    day: str = FOLDER_DAY,
) -> None:
    """Write one run sorted by key, so that a look-up of few keys reads few row groups.

    Rows are dealt to ``files`` tasks by ranges of day, key and ``tie``, so a file holds a narrow
    range of keys; the tie splits a key that has many rows, which then lie in files next to
    each other. Row groups carry the range of the key and a Bloom filter of it, which tells
    of a key inside the range that it is not there. ``block_bytes`` is the size of a row group.
    Dealing by range samples the rows first, so they are computed twice.
    """
    dated = df if day_of is None else df.withColumn(day, as_date(day_of))
    folders = [] if day_of is None else [day]
    ties = [c for c in tie if c in df.columns and c != key]
    order = [*folders, key, *ties]
    writer = (
        dated.repartitionByRange(files, *order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option(f"parquet.bloom.filter.enabled#{key}", True)
    )
    if block_bytes is not None:
        writer = writer.option("parquet.block.size", block_bytes)
    (writer.partitionBy(*folders) if folders else writer).parquet(path)


def append_offsets(offsets: DataFrame, path: str, first_run: bool = False) -> None:
    offsets.write.mode("overwrite" if first_run else "append").parquet(path)


def write_snapshot(
    df: DataFrame, base: str, exec_date: DateLike, key: str, files: int | None = None
) -> str:
    """One full copy for the day.

    A deduplicated frame is already spread by its key; ask for a number of files
    only to override that.
    """
    path = day_path(base, exec_date)
    spread = df if files is None else df.repartition(files, key)
    spread.write.mode("overwrite").parquet(path)
    return path


def replace_partitions(
    df: DataFrame, path: str, by: Sequence[str], rebalance: bool = True
) -> None:
    """Overwrite only the partitions that ``df`` has rows for.

    ``df`` may read from ``path``: its files go when the whole job has committed. That commit
    moves one partition after the other; a driver that is lost in it leaves some
    of them without rows. ``publish_partitions`` has no such moment.
    """
    spread = df.hint("rebalance", *[F.col(c) for c in by]) if rebalance else df
    (
        spread.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )
