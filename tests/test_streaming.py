import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks import feeds
from feedmerge.operators import merge_accounts
from feedmerge.plans import METRICS, POSTS, merge_posts, merge_posts_metrics
from feedmerge.schemas import MERGED_POSTS, METRICS_DELTA, POSTS_DELTA, ddl
from feedmerge.sources.files import read_day
from feedmerge.streaming import (
    read_accounts,
    read_upserted_posts,
    stream_ingest,
    stream_upsert_blogs,
    stream_upsert_posts,
)
from helpers import metrics, posts, rows


def now():
    return F.lit("2024-01-20 06:00:00").cast("timestamp")


def arrivals(spark, sf, tmp_path, order=1):
    """The events as six files, so that a stream takes several batches."""
    path = str(tmp_path / "events")
    events = feeds.events(spark, sf)
    events.repartitionByRange(6, order * F.col("event_id")).write.parquet(path)
    return path


def stream(spark, path):
    return spark.readStream.schema(feeds.EVENTS).option("maxFilesPerTrigger", 2).parquet(path)


def test_ingest_reads_each_message_once(spark, sf, tmp_path):
    path, out, mark = arrivals(spark, sf, tmp_path), str(tmp_path / "out"), str(tmp_path / "mark")

    def run():
        messages = feeds.metric_messages(stream(spark, path))
        stream_ingest(METRICS, messages, out, mark, "2024-01-20", now()).awaitTermination()
        return read_day(spark, out, "2024-01-20")

    wanted = METRICS.rows(feeds.metric_messages(feeds.events(spark, sf)), "2024-01-20", now())
    assert rows(run().select(*METRICS.fields)) == rows(wanted)
    assert run().count() == wanted.count()
    late = feeds.events(spark, sf).limit(5).selectExpr(
        "event_id + 1000000 event_id", "ts", "user_id", "event_type", "value", "props"
    )
    late.write.mode("append").parquet(path)
    assert run().count() == wanted.count() + 5


def test_account_upserts_equal_one_merge(spark, sf, tmp_path):
    wanted = rows(merge_accounts(feeds.blogs(spark, sf, None), None, "20240120"))
    for order in (1, -1):
        folder = tmp_path / str(order)
        path, base = arrivals(spark, sf, folder, order), str(folder / "versions")
        stream_upsert_blogs(
            feeds.blog_rows(stream(spark, path)), base, str(folder / "mark"), "20240120"
        ).awaitTermination()
        assert rows(read_accounts(spark, base)) == wanted
    assert read_accounts(spark, str(tmp_path / "none")) is None


def test_a_repeated_batch_gives_the_same_accounts(spark, sf, tmp_path):
    path, base = arrivals(spark, sf, tmp_path), str(tmp_path / "versions")

    def run(mark):
        stream_upsert_blogs(
            feeds.blog_rows(stream(spark, path)), base, str(tmp_path / mark), "20240120"
        ).awaitTermination()
        return rows(read_accounts(spark, base))

    assert run("first") == run("second")


def test_a_new_checkpoint_goes_on_over_an_old_base(spark, sf, tmp_path):
    base = str(tmp_path / "accounts")
    for k in (0, 1):
        path = str(tmp_path / f"events{k}")
        feeds.events(spark, sf).where(F.col("user_id") % 2 == k).repartition(3).write.parquet(path)
        stream_upsert_blogs(
            feeds.blog_rows(stream(spark, path)), base, str(tmp_path / f"mark{k}"), "20240120"
        ).awaitTermination()
    wanted = merge_accounts(feeds.blogs(spark, sf, None), None, "20240120")
    assert rows(read_accounts(spark, base)) == rows(wanted)


@pytest.mark.parametrize(("order", "files"), [(1, 2), (-1, 2), (1, 1), (0, 3)])
def test_post_upserts_equal_one_merge(spark, sf, tmp_path, order, files):
    path, out = arrivals(spark, sf, tmp_path, order), str(tmp_path / "merged")
    if order == 0:  # rows of all times in every file
        path = str(tmp_path / "mixed")
        feeds.events(spark, sf).repartition(6, "event_id").write.parquet(path)

    def run(mark):
        source = spark.readStream.schema(feeds.EVENTS).option("maxFilesPerTrigger", files).parquet(path)
        stream_upsert_posts(
            feeds.post_rows(source.where("event_type in ('view', 'error')")),
            feeds.metric_rows(source.where("event_type = 'click'")),
            out,
            str(tmp_path / mark),
            "2024-01-05",
            "2024-01-20",
        ).awaitTermination()
        return rows(read_upserted_posts(spark, out).select(*MERGED_POSTS))

    wanted = rows(
        merge_posts_metrics(
            feeds.posts(spark, sf),
            feeds.metrics(spark, sf),
            None,
            "2024-01-05",
            "2024-01-20",
            dates_from="both",
        ).select(*MERGED_POSTS)
    )
    assert run("first") == wanted
    assert run("again") == wanted


def test_late_metric_and_early_metric_give_the_same_post(spark, tmp_path):
    post = {"id": "a", "partdate": dt.datetime(2024, 1, 6), "likescount": 1, "metrictimestamp": "1"}
    newer = {"id": "a", "partdate": "2024-01-06", "likes": 201, "metricstimestamp": "10:00"}
    older = {"id": "a", "partdate": "2024-01-06", "likes": 5, "metricstimestamp": "09:00"}
    for k, batches in enumerate(([newer, older, post], [post, newer, older], [older, post, newer])):
        out = str(tmp_path / f"out{k}")
        for n, row in enumerate(batches):
            here = tmp_path / f"in{k}-{n}"
            post_rows, metric_rows = ([row], []) if row is post else ([], [row])
            posts(spark, *post_rows).write.parquet(str(here / "posts"))
            metrics(spark, *metric_rows).write.parquet(str(here / "metrics"))
            read = lambda name, fields: spark.readStream.schema(ddl(fields)).parquet(str(here / name))  # noqa: B023, E731
            stream_upsert_posts(
                read("posts", POSTS_DELTA), read("metrics", METRICS_DELTA), out, str(here / "mark"), "2024-01-01", "2024-01-30"
            ).awaitTermination()
        assert [r.likescount for r in read_upserted_posts(spark, out).collect()] == [201]


def test_streamed_runs_feed_the_daily_merge(spark, sf, tmp_path):
    path = arrivals(spark, sf, tmp_path)
    for feed, messages, name in (
        (POSTS, feeds.post_messages, "posts"),
        (METRICS, feeds.metric_messages, "metrics"),
    ):
        sent = messages(stream(spark, path)).withColumn("timestamp", F.lit("2024-01-20 05:00:00").cast("timestamp"))
        stream_ingest(feed, sent, str(tmp_path / name), str(tmp_path / f"mark-{name}"), now=now()).awaitTermination()
    merge_posts(
        spark, str(tmp_path / "posts"), str(tmp_path / "metrics"), str(tmp_path / "merged"), "2024-01-20", "2024-01-05"
    )
    every = feeds.events(spark, sf)
    for name, made in (("p", feeds.post_messages(every)), ("m", feeds.metric_messages(every))):
        made.write.parquet(str(tmp_path / name))
    wanted = merge_posts_metrics(
        POSTS.rows(spark.read.parquet(str(tmp_path / "p")), "2024-01-20", now()),
        METRICS.rows(spark.read.parquet(str(tmp_path / "m")), "2024-01-20", now()),
        None,
        "2024-01-05",
        "2024-01-20",
    )
    got = spark.read.parquet(str(tmp_path / "merged"))
    assert rows(got.select(*MERGED_POSTS)) == rows(wanted.select(*MERGED_POSTS))
