"""Continuous upserts with ``foreachBatch``, merged when they are read.

State is the newest rows of each key, chosen by event time and log position and never by
arrival. A micro-batch only adds its own newest rows as a change; readers merge changes with the
stored partitions. Above ``COMPACT`` changes, a batch merges them into the partitions they touch
and publishes these at once, then withdraws the changes. Merging the same rows again alters nothing, so
a crash between the two, a repeated batch or a new checkpoint over an old base is harmless, and the
result is that of one batch over all rows, in whatever order and batches they came.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedmerge.functions.dates import DateLike
from feedmerge.functions.keys import key_bucket
from feedmerge.operators.join import (
    DAY,
    METRIC_ORDER,
    POST_ORDER,
    filter_date_range,
    merge_latest_posts_metrics,
)
from feedmerge.operators.latest import latest_per_key
from feedmerge.operators.overlay import conform
from feedmerge.operators.snapshot import ACCOUNT_KEY, latest_accounts
from feedmerge.schemas import METRICS_DELTA, POSTS_DELTA
from feedmerge.sinks.published import (
    current,
    publish_changes,
    publish_partitions,
    read_versions,
    vacuum,
    withdraw,
)

BUCKET = "bucket"
#: Changes that are kept beside the stored partitions.
COMPACT = 16
STATE_DAY = "stateday"


def _start(
    stream: DataFrame,
    checkpoint: str,
    trigger: dict | None,
    upsert: Callable[[DataFrame, int], None],
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


Newest = Callable[[DataFrame], DataFrame]


def _places(path: str) -> tuple[str, str]:
    """Where the changes and the stored partitions of a state lie."""
    base = path.rstrip("/")
    return f"{base}/changes", f"{base}/stored"


def read_state(spark: SparkSession, path: str, newest: Newest, by: str) -> DataFrame | None:
    """Stored partitions and changes merged, or None before the first batch.

    The changes are read first: those that are merged meanwhile then lie in both and count once.
    """
    changes, stored = _places(path)
    sides = [read_versions(spark, p, current(spark, p)[1]) for p in (changes, stored)]
    sides = [s for s in sides if s is not None]
    if not sides:
        return None
    if len(sides) == 2:
        kind = sides[0].schema[by].dataType
        sides[1] = sides[1].withColumn(by, F.col(by).cast(kind))
        return newest(sides[0].unionByName(sides[1], allowMissingColumns=True))
    return newest(sides[0])


def add_changes(fresh: DataFrame, path: str, by: str, newest: Newest, compact: int) -> None:
    """Publish the newest of some rows as a change; merge the changes if there are many."""
    held = publish_changes(newest(fresh), _places(path)[0])
    if held > compact:
        merge_changes(fresh.sparkSession, path, by, newest)


def merge_changes(spark: SparkSession, path: str, by: str, newest: Newest) -> list[str]:
    """Merge all changes into the stored partitions they touch; returns these partitions."""
    changes, stored = _places(path)
    versions = current(spark, changes)[1]
    rows = read_versions(spark, changes, versions)
    if rows is None:
        return []
    kind = rows.schema[by].dataType
    # one row per touched partition: buckets or days
    touched = {f"{by}={r[0]}" for r in rows.select(F.col(by).cast("string")).distinct().collect()}
    old = read_versions(spark, stored, current(spark, stored)[1], touched.__contains__)
    if old is not None:
        rows = old.withColumn(by, F.col(by).cast(kind)).unionByName(rows, allowMissingColumns=True)
    published = publish_partitions(newest(rows), stored, [by])
    withdraw(spark, changes, versions[""])
    vacuum(spark, changes, [])
    vacuum(spark, stored, [by])
    return published


def read_accounts(spark: SparkSession, base: str) -> DataFrame | None:
    """The accounts of ``stream_upsert_blogs``, or None before the first batch."""
    state = read_state(spark, base, latest_accounts, BUCKET)
    return None if state is None else state.drop(BUCKET)


def stream_upsert_blogs(
    blogs: DataFrame,
    base: str,
    checkpoint: str,
    merge_date: str | Column | None = None,
    trigger: dict | None = None,
    buckets: int = 64,
    compact: int = COMPACT,
) -> StreamingQuery:
    """Keep the newest row per account; late rows lose to newer stored ones.

    A batch writes its own rows only; above ``compact`` changes they are merged into
    ``buckets`` partitions by key.
    ``mergedate`` is the day of the row's own time unless ``merge_date`` fixes it.
    """
    if merge_date is None:
        merge_date = F.date_format("currenttimestamp", "yyyyMMdd")

    def upsert(batch: DataFrame, batch_id: int) -> None:
        stamped = batch.withColumn("mergedate", F.lit(merge_date))
        placed = stamped.withColumn(BUCKET, key_bucket(ACCOUNT_KEY, buckets))
        add_changes(placed, base, BUCKET, latest_accounts, compact)

    return _start(blogs, checkpoint, trigger, upsert)


def tag_feeds(posts: DataFrame, metrics: DataFrame) -> DataFrame:
    """Both feeds as one stream, so that a micro-batch holds rows of each."""
    return posts.select(F.struct(*POSTS_DELTA).alias("post")).unionByName(
        metrics.select(F.struct(*METRICS_DELTA).alias("metric")), allowMissingColumns=True
    )


SIDES = (("post", POST_ORDER), ("metric", METRIC_ORDER))


def newest_of(order) -> Newest:
    return lambda rows: latest_per_key(rows, ["id", STATE_DAY], order, ())


def read_upserted_posts(spark: SparkSession, path: str) -> DataFrame | None:
    """The merged posts of ``stream_upsert_posts``: counts and the latest day resolved."""
    posts, metrics = (
        read_state(spark, f"{path.rstrip('/')}/{name}s", newest_of(order), STATE_DAY) for name, order in SIDES
    )
    if posts is None and metrics is None:
        return None

    def side(rows: DataFrame | None, fields: dict[str, str]) -> DataFrame:
        if rows is None:
            empty = ", ".join(f"`{c}` {t}" for c, t in {**fields, DAY: "DATE"}.items())
            return spark.createDataFrame([], empty)
        return rows.withColumn(DAY, F.col(STATE_DAY).cast("date")).select(*fields, DAY)

    return conform(merge_latest_posts_metrics(side(posts, POSTS_DELTA), side(metrics, METRICS_DELTA)))


def stream_upsert_posts(
    posts: DataFrame,
    metrics: DataFrame,
    path: str,
    checkpoint: str,
    lower: DateLike,
    upper: DateLike,
    trigger: dict | None = None,
    compact: int = COMPACT,
) -> StreamingQuery:
    """Keep the newest post row and the newest metric row of every post and day.

    The two stay apart below ``path``, so it does not matter which came first;
    ``read_upserted_posts`` joins them. A batch writes its own rows only; above ``compact``
    changes they are merged into their days.
    """

    def upsert(batch: DataFrame, batch_id: int) -> None:
        for name, order in SIDES:
            rows = batch.where(F.col(name).isNotNull()).select(f"{name}.*").where("id is not null")
            dated = filter_date_range(rows, "partdate", lower, upper, STATE_DAY)
            add_changes(dated, f"{path.rstrip('/')}/{name}s", STATE_DAY, newest_of(order), compact)

    return _start(tag_feeds(posts, metrics), checkpoint, trigger, upsert)
