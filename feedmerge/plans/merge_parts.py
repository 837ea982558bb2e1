"""Posts and metrics merged into stored posts of which only the parts with a changed post are read.

Each post date is split into parts by a digest of the post's id, kept by manifest. The ids of the
delta tell which parts can hold a row they change, without a false answer; the files of all
others are neither read nor written, and the new manifest names them again.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmerge.functions.dates import DateLike, parse_day
from feedmerge.functions.keys import key_bucket
from feedmerge.operators.join import DAY, filter_date_range
from feedmerge.plans.merge_posts import STORED_DATE, LeftOut, merge_posts_metrics, read_deltas, without_id
from feedmerge.schemas import MERGED_POSTS, POST_DATE, POST_KEY, ddl
from feedmerge.session import configure
from feedmerge.sinks.published import current, publish_partitions, read_versions

PARTS, PART = "parts", "part"
PLACE = [STORED_DATE, PARTS, PART]
STORED = ddl({**{k: v for k, v in MERGED_POSTS.items() if k != POST_DATE}, STORED_DATE: "DATE"})


class Merged(NamedTuple):
    left_out: LeftOut
    #: Stored parts whose files were read, and parts that were written.
    read: int
    written: int


def _part_count(manifest) -> int | None:
    """How many parts a date has; the middle folder is named after it."""
    return next((int(p.split("/")[1].partition("=")[2]) for p in manifest), None)


def touched_parts(posts: DataFrame, metrics: DataFrame, lower: DateLike, upper: DateLike, parts: int) -> set[str]:
    """Folders that can hold a row of the delta: at most the days of the range times ``parts``.

    Ids and dates alone are read, and each task sends a folder once.
    """
    sides = [
        filter_date_range(side.where(F.col("id").isNotNull()), "partdate", lower, upper).select(DAY, key_bucket("id", parts).alias(PART))
        for side in (posts, metrics)
    ]
    found = sides[0].union(sides[1]).distinct().collect()
    return {f"{STORED_DATE}={row[0]}/{PARTS}={parts}/{PART}={row[1]}" for row in found}


def _stored(spark: SparkSession, path: str, manifest, only=None) -> DataFrame | None:
    rows = read_versions(spark, path, manifest, only, STORED)
    return None if rows is None else rows.drop(PARTS, PART).withColumnRenamed(STORED_DATE, POST_DATE)


def merge_posts_parts(
    spark: SparkSession,
    posts_path: str,
    metrics_path: str,
    path: str,
    exec_date: DateLike,
    lower: DateLike,
    parts: int | None = None,
    dates_from: str = "posts",
) -> Merged:
    """``merge_posts`` into a table split in ``parts`` a date, 64 at first.

    Choose as many as make a part a file of a few hundred MB. The number stays as it is for the
    table's life, as files are kept as they lie. All parts change at once, by one manifest.
    """
    configure(spark)
    upper = parse_day(exec_date)
    posts, metrics = read_deltas(spark, posts_path, metrics_path, upper, lower)
    manifest = current(spark, path)[1]
    stored = _part_count(manifest)
    if parts is not None and stored not in (None, parts):
        raise ValueError(f"{path} has {stored} parts a date")
    count = stored or parts or 64
    touched = touched_parts(posts, metrics, lower, upper, count)
    history = _stored(spark, path, manifest, touched.__contains__)
    merged = merge_posts_metrics(posts, metrics, history, lower, upper, dates_from=dates_from)
    placed = merged.withColumns({STORED_DATE: F.col(POST_DATE), PARTS: F.lit(count), PART: key_bucket(POST_KEY, count)})
    written = publish_partitions(placed, path, PLACE)
    return Merged(LeftOut(without_id(posts), without_id(metrics)), len(touched & manifest.keys()), len(written))


def read_posts_parts(spark: SparkSession, path: str, lower: DateLike | None = None, upper: DateLike | None = None) -> DataFrame:
    """The stored posts, of a range of dates if given, whose other files are not opened; empty before the first merge."""
    first = "" if lower is None else f"{STORED_DATE}={parse_day(lower)}"
    last = "~" if upper is None else f"{STORED_DATE}={parse_day(upper)}"
    rows = _stored(spark, path, current(spark, path)[1], lambda p: first <= p.split("/")[0] <= last)
    return (spark.createDataFrame([], ddl(MERGED_POSTS)) if rows is None else rows).select(*MERGED_POSTS)
