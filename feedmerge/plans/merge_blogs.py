"""Daily account snapshot."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from feedmerge.functions.dates import DateLike, parse_day
from feedmerge.operators.snapshot import ACCOUNT_KEY, merge_accounts
from feedmerge.schemas import BLOGS_DELTA, ddl
from feedmerge.sinks.files import write_snapshot
from feedmerge.sinks.tables import bucket_count, create_bucketed, replace_table_days
from feedmerge.sources.files import (
    child_names,
    day_path,
    read_days_after,
    snapshot_day_before,
)
from feedmerge.sources.ledger import read_runs, record_merged, runs_to_merge


def merge_blogs(
    spark: SparkSession,
    blogs_path: str,
    merged_path: str,
    exec_date: DateLike,
    prev_exec_date: DateLike | None = None,
    files: int | None = None,
) -> str:
    """Merge all deltas since the previous snapshot into it and write the day's.

    The previous snapshot is that of ``prev_exec_date``, or the newest finished one
    before the day. Only the absence of any means a first run; a named one must be there. Delta days between it
    and the day, which a schedule missed, are merged too.
    """
    day = parse_day(exec_date)
    snapshot, since = None, None
    if prev_exec_date is None:
        since = snapshot_day_before(spark, merged_path, day)
        if since is not None:
            snapshot = spark.read.parquet(day_path(merged_path, since))
    elif parse_day(prev_exec_date) == day:
        raise ValueError("a snapshot cannot be merged into itself")
    else:
        since = parse_day(prev_exec_date)
        path = day_path(merged_path, since)
        if "_SUCCESS" not in child_names(spark, path):
            raise ValueError(f"there is no finished snapshot at {path}")
        snapshot = spark.read.parquet(path)
    delta = read_days_after(spark, blogs_path, since, day)
    merged = merge_accounts(delta, snapshot, f"{day:%Y%m%d}")
    return write_snapshot(merged, merged_path, day, ACCOUNT_KEY, files)


def merge_blogs_runs(
    spark: SparkSession,
    blogs_path: str,
    merged_path: str,
    ledger: str,
    exec_date: DateLike,
    feed: str = "blogs",
    files: int | None = None,
) -> list[str]:
    """Merge every run that no earlier day has merged into the newest snapshot before the day.

    Late runs and missed days are among them. The ledger is told after the snapshot is written, so
    a merge that dies is done again. Returns the runs.
    """
    day = parse_day(exec_date)
    since = snapshot_day_before(spark, merged_path, day)
    snapshot = None if since is None else spark.read.parquet(day_path(merged_path, since))
    runs = runs_to_merge(spark, ledger, feed, day)
    delta = read_runs(spark, blogs_path, runs, ddl(BLOGS_DELTA))
    write_snapshot(merge_accounts(delta, snapshot, f"{day:%Y%m%d}"), merged_path, day, ACCOUNT_KEY, files)
    record_merged(spark, ledger, feed, runs, day)
    return runs


SNAPSHOT_DAY = "snapshotdate"


def create_blogs_table(
    spark: SparkSession, table: str, buckets: int, path: str | None = None
) -> None:
    """A table with one snapshot per day, bucketed by account."""
    fields = {**BLOGS_DELTA, "mergedate": "STRING"}
    create_bucketed(spark, table, fields, SNAPSHOT_DAY, ACCOUNT_KEY, buckets, path)


def merge_blogs_table(
    spark: SparkSession, blogs_path: str, table: str, exec_date: DateLike
) -> None:
    """``merge_blogs`` into a table of ``create_blogs_table``, missed delta days included."""
    day = parse_day(exec_date)
    stored = spark.table(table)
    # Partition values only: the newest day comes from the table's metadata.
    previous = max(
        (
            found
            for row in spark.sql(f"SHOW PARTITIONS {table}").collect()
            if (found := parse_day(row[0].partition("=")[2])) < day
        ),
        default=None,
    )
    today = F.lit(day)
    delta = read_days_after(spark, blogs_path, previous, day).withColumn(SNAPSHOT_DAY, today)
    snapshot = None
    if previous is not None:
        snapshot = stored.where(F.col(SNAPSHOT_DAY) == F.lit(previous))
    merged = merge_accounts(delta, snapshot, f"{day:%Y%m%d}", bucket_count(spark, table))
    replace_table_days(merged.withColumn(SNAPSHOT_DAY, today), table)
