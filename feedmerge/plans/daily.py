"""The whole day: accounts first, then posts."""

from __future__ import annotations

from pyspark.sql import SparkSession

from feedmerge.functions.dates import DateLike
from feedmerge.plans.merge_blogs import merge_blogs
from feedmerge.plans.merge_posts import LeftOut, merge_posts


def merge_day(
    spark: SparkSession,
    blogs_path: str,
    merged_blogs_path: str,
    posts_path: str,
    metrics_path: str,
    merged_posts_path: str,
    exec_date: DateLike,
    lower: DateLike,
    prev_exec_date: DateLike | None = None,
    batch_size: int | None = None,
) -> LeftOut:
    """Returns what the post merge left out."""
    merge_blogs(spark, blogs_path, merged_blogs_path, exec_date, prev_exec_date)
    return merge_posts(
        spark, posts_path, metrics_path, merged_posts_path, exec_date, lower, batch_size=batch_size
    )
