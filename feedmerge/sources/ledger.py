"""The run ledger: which runs were written, and into which day each was merged.

A run is a folder ``base/yyyyMMdd/<name>`` of one feed. The ledger is an append-only table of
events, so a job that dies leaves at most an event unwritten: its run stays pending and is merged
again, which changes nothing. A merge takes every pending run, whatever day it lies under, so
late runs and missed days need no rule of their own.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmerge.functions.dates import DateLike, parse_day
from feedmerge.sources.files import day_path, finished_runs, read_if_exists

LEDGER = "feed STRING, run STRING, runday DATE, mergedday DATE"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The events: a run is written (``mergedday`` is null) or merged into a day."""
    found = read_if_exists(spark, path, LEDGER)
    return spark.createDataFrame([], LEDGER) if found is None else found


def _append(spark: SparkSession, path: str, events: list[tuple]) -> None:
    if events:
        spark.createDataFrame(events, LEDGER).coalesce(1).write.mode("append").parquet(path)


def run_of(path: str) -> tuple[str, dt.date]:
    """``yyyyMMdd/<name>`` of a run's folder, and its day."""
    day, name = path.rstrip("/").rsplit("/", 2)[-2:]
    return f"{day}/{name}", parse_day(day)


def record_written(spark: SparkSession, path: str, feed: str, runs: Sequence[str]) -> None:
    """Note runs by their folders; noting one twice is harmless."""
    _append(spark, path, [(feed, *run_of(r), None) for r in runs])


def record_finished(spark: SparkSession, path: str, feed: str, base: str, day: DateLike) -> list[str]:
    """Note the finished runs below a day's folder that the ledger does not know."""
    found = [f"{day_path(base, day)}/{n}" for n in finished_runs(spark, base, day)]
    known = {r.run for r in read_ledger(spark, path).where(F.col("feed") == feed).where(F.col("runday") == F.lit(parse_day(day))).select("run").distinct().collect()}
    fresh = [r for r in found if run_of(r)[0] not in known]
    record_written(spark, path, feed, fresh)
    return fresh


def run_states(ledger: DataFrame) -> DataFrame:
    """feed, run, runday and ``mergedday``, the first day each run was merged into, or null."""
    return ledger.groupBy("feed", "run", "runday").agg(F.min("mergedday").alias("mergedday"))


def runs_to_merge(spark: SparkSession, path: str, feed: str, day: DateLike) -> list[str]:
    """Runs that no earlier day has merged: pending ones, and those of an earlier try of ``day``.

    One name for each run since the last merge, which the schedule bounds.
    """
    states = run_states(read_ledger(spark, path).where(F.col("feed") == feed))
    open_ = states.where(F.col("mergedday").isNull() | (F.col("mergedday") >= F.lit(parse_day(day))))
    return sorted(r.run for r in open_.select("run").collect())


def record_merged(spark: SparkSession, path: str, feed: str, runs: Sequence[str], day: DateLike) -> None:
    _append(spark, path, [(feed, r, parse_day(r.split("/")[0]), parse_day(day)) for r in runs])


def read_runs(spark: SparkSession, base: str, runs: Sequence[str], schema: str) -> DataFrame:
    """The rows of some runs, day folders inside a run included."""
    if not runs:
        return spark.createDataFrame([], schema)
    root = base.rstrip("/")
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*[f"{root}/{r}" for r in runs])


def guarded_days(ledger: DataFrame, lower: DateLike, upper: DateLike) -> DataFrame:
    """Every day in the range that has runs, its ``runs``, how many are ``pending``, and why it stays.

    ``reason`` is null for the days that may expire: finished merges hold all their runs.
    """
    days = run_states(ledger).where(F.col("runday").between(F.lit(parse_day(lower)), F.lit(parse_day(upper))))
    counted = days.groupBy("runday").agg(F.count(F.lit(1)).alias("runs"), F.count_if(F.col("mergedday").isNull()).alias("pending"))
    reason = F.when(F.col("pending") > 0, F.concat(F.col("pending"), F.lit(" of "), F.col("runs"), F.lit(" runs are not merged")))
    return counted.withColumn("reason", reason)
