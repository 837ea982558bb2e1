"""Reads of delta folders, snapshots and partitioned history."""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmerge.functions.dates import DateLike, in_date_range, parse_day


def read_if_exists(
    spark: SparkSession, path: str, schema: str | None = None, format: str = "parquet"
) -> DataFrame | None:
    """The dataset at ``path``, or None if nothing is there; other errors are raised."""
    reader = spark.read.format(format)
    if schema:
        reader = reader.schema(schema)
    try:
        return reader.load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


RUN = "run"
FOLDER_DAY = "postdate"


def day_path(base: str, exec_date: DateLike) -> str:
    return f"{base.rstrip('/')}/{parse_day(exec_date):%Y%m%d}"


def read_day(
    spark: SparkSession,
    base: str,
    exec_date: DateLike,
    schema: str | None = None,
    format: str = "parquet",
) -> DataFrame:
    """Every finished run of one day. Without a schema, parquet gives its own.

    Run folders may be named ``run=<instant>`` or by anything without a ``=``. A folder
    ``run=<instant>`` without ``_SUCCESS`` is being written or has failed, and is passed over; a day
    that has only such folders is an error.
    """
    path = day_path(base, exec_date)
    reader = spark.read.format(format).option("basePath", path)
    if schema:
        reader = reader.schema(schema)
    runs = finished_runs(spark, base, exec_date)
    if not runs and any(n.startswith(f"{RUN}=") for n in child_names(spark, path)):
        raise ValueError(f"no finished run below {path}")
    return reader.load([f"{path}/{n}" for n in runs] or f"{path}/*").drop(RUN)


def finished_runs(spark: SparkSession, base: str, exec_date: DateLike) -> list[str]:
    """Names of a day's run folders, less the ``run=`` folders without ``_SUCCESS``; one listing a run."""
    path = day_path(base, exec_date)
    return [
        n
        for n in child_names(spark, path)
        if n[0] not in "._" and (not n.startswith(f"{RUN}=") or "_SUCCESS" in child_names(spark, f"{path}/{n}"))
    ]


def near_days(df: DataFrame, lower: DateLike, upper: DateLike) -> DataFrame:
    """Skip the day folders of a delta that are clearly outside a range.

    Two days to spare on both ends leave the exact choice to the rows themselves,
    whatever time zone the folders were named in: zones lie up to 26 hours apart.
    """
    if FOLDER_DAY not in df.columns:
        return df
    spare = dt.timedelta(days=2)
    folder = F.col(FOLDER_DAY).cast("date")
    return df.where(
        folder.between(F.lit(parse_day(lower) - spare), F.lit(parse_day(upper) + spare))
    ).drop(FOLDER_DAY)


def read_csv(
    spark: SparkSession, path: str, schema: str | None = None, required: Sequence[str] = ()
) -> DataFrame:
    """CSV with a header line, less the rows that lack a required column."""
    reader = spark.read.option("header", True)
    if schema:
        reader = reader.schema(schema)
    rows = reader.csv(path)
    for column in required:
        rows = rows.where(F.col(column).isNotNull())
    return rows


def child_names(spark: SparkSession, base: str) -> list[str]:
    """Names directly below a folder; one entry per day or run, no data is read."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(path))


def day_folders(spark: SparkSession, base: str) -> list[dt.date]:
    """Days that have a ``yyyyMMdd`` folder below ``base``, oldest first."""
    return [parse_day(n) for n in child_names(spark, base) if len(n) == 8 and n.isdigit()]


def snapshot_day_before(spark: SparkSession, base: str, exec_date: DateLike) -> dt.date | None:
    """Day of the newest finished snapshot strictly before ``exec_date``, or None.

    None means that there is no older folder at all. Older folders of which none is
    finished are an error: taking them for a first run would drop what they hold.
    """
    days = [d for d in day_folders(spark, base) if d < parse_day(exec_date)]
    for day in reversed(days):
        if "_SUCCESS" in child_names(spark, day_path(base, day)):
            return day
    if days:
        raise ValueError(f"no finished snapshot below {base}, only unfinished ones, the newest of {days[-1]}")
    return None


def read_snapshot_before(spark: SparkSession, base: str, exec_date: DateLike) -> DataFrame | None:
    """The newest finished snapshot strictly before ``exec_date``, or None."""
    day = snapshot_day_before(spark, base, exec_date)
    return None if day is None else spark.read.parquet(day_path(base, day))


def read_days_after(
    spark: SparkSession, base: str, after: DateLike | None, exec_date: DateLike, schema: str | None = None
) -> DataFrame:
    """Every run of the days after ``after`` up to ``exec_date``, which must be there.

    Days that a schedule missed are read with the day itself; without ``after``, all
    earlier days are.
    """
    last = parse_day(exec_date)
    first = dt.date.min if after is None else parse_day(after)
    days = [d for d in day_folders(spark, base) if first < d < last]
    frames = [read_day(spark, base, d, schema) for d in [*days, last]]
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_history(
    spark: SparkSession,
    path: str,
    lower: DateLike,
    upper: DateLike,
    column: str = "partdate",
    days: DataFrame | None = None,
) -> DataFrame | None:
    """Stored partitions from ``lower`` to ``upper``, or only those of ``days``.

    The range prunes when the query is planned. ``days`` is a small frame with
    the same column, and prunes further while the query runs.
    """
    history = read_if_exists(spark, path)
    if history is None:
        return None
    history = history.withColumn(column, F.col(column).cast("date"))
    history = history.where(in_date_range(history, column, lower, upper))
    return history if days is None else history.join(days, column, "left_semi")
