"""Posts and metrics of a day, merged into the stored posts."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmerge.functions.dates import DateLike, parse_day
from feedmerge.operators.join import (
    BATCH,
    DAY,
    broadcast_days,
    distinct_days,
    filter_date_range,
    merge_latest_posts_metrics,
    number_batches,
)
from feedmerge.operators.overlay import conform, merge_history
from feedmerge.schemas import (
    MERGED_POSTS,
    METRICS_DELTA,
    POST_DATE,
    POST_KEY,
    POSTS_DELTA,
    ddl,
)
from feedmerge.session import configure
from feedmerge.sinks.files import replace_partitions
from feedmerge.sinks.published import is_published, publish_partitions, read_published
from feedmerge.sinks.tables import bucket_count, create_bucketed, replace_table_days
from feedmerge.sources.files import near_days, read_day, read_history, read_if_exists
from feedmerge.sources.ledger import read_runs, record_merged, runs_to_merge

STORED_DATE = "partdate"


def post_days(posts: DataFrame, metrics: DataFrame, dates_from: str) -> DataFrame:
    """The days to process: those with a post, or with either."""
    if dates_from not in ("posts", "both"):
        raise ValueError(f"unknown dates_from {dates_from!r}")
    dated = posts.select(DAY)
    if dates_from == "both":
        dated = dated.union(metrics.select(DAY))
    return distinct_days(dated)


def daily_delta(
    posts: DataFrame,
    metrics: DataFrame,
    lower: DateLike,
    upper: DateLike,
    batch_size: int | None = None,
    dates_from: str = "posts",
) -> tuple[DataFrame, DataFrame]:
    """Latest row per post of the in-range deltas, and the days it covers.

    With ``batch_size``, a post found on days of different batches keeps one row
    in each; the batches are still one job. Rows without an id are left out.
    """
    posts = filter_date_range(posts.where(F.col("id").isNotNull()), "partdate", lower, upper)
    metrics = filter_date_range(metrics.where(F.col("id").isNotNull()), "partdate", lower, upper)
    found = post_days(posts, metrics, dates_from)
    days = broadcast_days(found, lower, upper)
    if batch_size is None:
        metrics = metrics.join(days, DAY, "left_semi")
        return merge_latest_posts_metrics(posts, metrics), days
    batches = broadcast_days(number_batches(found, batch_size), lower, upper)
    delta = merge_latest_posts_metrics(
        posts.join(batches, DAY), metrics.join(batches, DAY), (BATCH,)
    )
    return delta.drop(BATCH), days


def merge_posts_metrics(
    posts: DataFrame,
    metrics: DataFrame,
    history: DataFrame | None,
    lower: DateLike,
    upper: DateLike,
    batch_size: int | None = None,
    dates_from: str = "posts",
    buckets: int | None = None,
) -> DataFrame:
    """New content of every processed post date; other dates are not returned.

    Of a history already spread by post, give the number of ``buckets``: the
    overlay then meets it there, and the history is not shuffled.
    """
    delta, days = daily_delta(posts, metrics, lower, upper, batch_size, dates_from)
    # Stated before the overlay, so that both of its parts share one shuffle.
    delta = conform(delta).where(F.col(POST_KEY).isNotNull() & F.col(POST_DATE).isNotNull())
    if history is None:
        return delta
    touched = history.join(days.withColumnRenamed(DAY, POST_DATE), POST_DATE, "left_semi")
    if buckets is None:
        # Merges leave few rows per post and date, so one task can hold a key.
        return merge_history(delta, touched, once=True)
    return merge_history(delta.repartition(buckets, POST_KEY), touched, spread_by=[POST_KEY])


def read_deltas(
    spark: SparkSession,
    posts_path: str,
    metrics_path: str,
    exec_date: DateLike,
    lower: DateLike,
    format: str = "parquet",
) -> tuple[DataFrame, DataFrame]:
    posts = read_day(spark, posts_path, exec_date, ddl(POSTS_DELTA), format)
    metrics = read_day(spark, metrics_path, exec_date, ddl(METRICS_DELTA), format)
    return near_days(posts, lower, exec_date), near_days(metrics, lower, exec_date)


def read_stored_posts(
    spark: SparkSession, path: str, lower: DateLike, upper: DateLike
) -> DataFrame | None:
    """Stored posts of a date range, dated by their partition so that it prunes."""
    if is_published(spark, path):
        first, last = f"{STORED_DATE}={parse_day(lower)}", f"{STORED_DATE}={parse_day(upper)}"
        history = read_published(spark, path, lambda p: first <= p <= last)
        if history is not None:
            history = history.withColumn(STORED_DATE, F.col(STORED_DATE).cast("date"))
    else:
        history = read_history(spark, path, lower, upper, STORED_DATE)
    if history is None:
        return None
    return history.drop(POST_DATE).withColumnRenamed(STORED_DATE, POST_DATE)


def write_stored_posts(merged: DataFrame, path: str, published: bool = False) -> None:
    """Replace the dates of ``merged``; all at once if the table is, or is to be, a published one."""
    dated = merged.withColumn(STORED_DATE, F.col(POST_DATE))
    if published or is_published(merged.sparkSession, path):
        publish_partitions(dated, path, [STORED_DATE])
    else:
        replace_partitions(dated, path, [STORED_DATE])


def read_merged_posts(spark: SparkSession, path: str) -> DataFrame | None:
    """All stored posts, of a published table or of plain folders."""
    return read_published(spark, path) if is_published(spark, path) else read_if_exists(spark, path)


def merge_posts(
    spark: SparkSession,
    posts_path: str,
    metrics_path: str,
    merged_path: str,
    exec_date: DateLike,
    lower: DateLike,
    format: str = "parquet",
    batch_size: int | None = None,
    dates_from: str = "posts",
    published: bool = False,
) -> LeftOut:
    """Merge one day of deltas into the table partitioned by post date.

    One job over all dates; only the partitions of processed dates are replaced. With ``published``
    the table is kept by manifest from the first merge on: a merge that dies leaves the old state
    whole, and ``read_merged_posts`` reads it. Returns how many delta rows had no id and were left out.
    """
    configure(spark)
    upper = parse_day(exec_date)
    posts, metrics = read_deltas(spark, posts_path, metrics_path, upper, lower, format)
    return _merge_stored(spark, posts, metrics, merged_path, lower, upper, batch_size, dates_from, published)


def merge_posts_runs(
    spark: SparkSession,
    posts_path: str,
    metrics_path: str,
    merged_path: str,
    ledger: str,
    exec_date: DateLike,
    lower: DateLike,
    feeds: tuple[str, str] = ("posts", "metrics"),
    dates_from: str = "posts",
    published: bool = True,
) -> LeftOut:
    """``merge_posts`` over every run that no earlier day has merged, late ones and those of missed days included."""
    configure(spark)
    upper = parse_day(exec_date)
    runs = [runs_to_merge(spark, ledger, feed, upper) for feed in feeds]
    sides = [
        read_runs(spark, base, some, ddl(fields))
        for base, some, fields in zip((posts_path, metrics_path), runs, (POSTS_DELTA, METRICS_DELTA))
    ]
    left = _merge_stored(spark, *sides, merged_path, lower, upper, None, dates_from, published)
    for feed, some in zip(feeds, runs):
        record_merged(spark, ledger, feed, some, upper)
    return left


def _merge_stored(spark, posts, metrics, merged_path, lower, upper, batch_size, dates_from, published) -> LeftOut:
    if published and not is_published(spark, merged_path) and read_if_exists(spark, merged_path) is not None:
        raise ValueError(f"{merged_path} holds plain folders; publish them to a new path first")
    history = read_stored_posts(spark, merged_path, lower, upper)
    merged = merge_posts_metrics(posts, metrics, history, lower, upper, batch_size, dates_from)
    write_stored_posts(merged, merged_path, published)
    return LeftOut(without_id(posts), without_id(metrics))


class LeftOut(NamedTuple):
    posts: int
    metrics: int


def without_id(rows: DataFrame) -> int:
    """Rows without an id; the filter reaches the files, so only their statistics and ids are read."""
    return rows.where(F.col("id").isNull()).count()


def create_posts_table(
    spark: SparkSession, table: str, buckets: int, path: str | None = None
) -> None:
    """Merged posts by post date, bucketed by post."""
    create_bucketed(spark, table, MERGED_POSTS, STORED_DATE, POST_KEY, buckets, path)


def merge_posts_table(
    spark: SparkSession,
    posts_path: str,
    metrics_path: str,
    table: str,
    exec_date: DateLike,
    lower: DateLike,
    format: str = "parquet",
    batch_size: int | None = None,
    dates_from: str = "posts",
) -> LeftOut:
    """``merge_posts`` into a table of ``create_posts_table``.

    Only the day's deltas are shuffled. Merges leave one row per post and date,
    so no bucket of such a table can grow by one hot post.
    """
    configure(spark)
    upper = parse_day(exec_date)
    posts, metrics = read_deltas(spark, posts_path, metrics_path, upper, lower, format)
    stored = spark.table(table).where(F.col(STORED_DATE).between(F.lit(parse_day(lower)), F.lit(upper)))
    history = stored.drop(POST_DATE).withColumnRenamed(STORED_DATE, POST_DATE)
    merged = merge_posts_metrics(
        posts, metrics, history, lower, upper, batch_size, dates_from, bucket_count(spark, table)
    )
    replace_table_days(merged.withColumn(STORED_DATE, F.col(POST_DATE)), table)
    return LeftOut(without_id(posts), without_id(metrics))
