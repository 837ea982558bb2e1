"""One query per operator, each over whole tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import feeds
from checks.feeds import EXEC_DATE, GROUP, LOWER, SNAPSHOT_DATE, TOPIC, plain
from checks.oracle import FIRST_RUN_ENDS, NOW
from feedmerge import functions as fn
from feedmerge import operators as op
from feedmerge import plans
from feedmerge.operators.join import DAY, days_of_range
from feedmerge.plans import daily
from feedmerge.plans.ingest import BROKEN, broken_path
from feedmerge.plans.merge_blogs import create_blogs_table, merge_blogs_runs, merge_blogs_table
from feedmerge.plans.merge_parts import merge_posts_parts, read_posts_parts
from feedmerge.plans.merge_posts import (
    create_posts_table,
    merge_posts_table,
    read_stored_posts,
    write_stored_posts,
)
from feedmerge.plans.snapshots import merge_blogs_incremental, read_accounts_of_day
from feedmerge.schemas import (
    MERGED_POSTS,
    METRICS_DELTA,
    POST_DATE,
    POST_JSON,
    POST_KEY,
    POSTS_DELTA,
    ddl,
)
from feedmerge.session import configure, scratch_dir
from feedmerge.sinks import (
    append_offsets,
    replace_partitions,
    run_path,
    write_clustered,
    write_run,
    write_snapshot,
)
from feedmerge.sinks.retention import remove_days
from feedmerge.sinks.tables import replace_table_days
from feedmerge.sources import evolution, files, ledger, log
from feedmerge.streaming import (
    read_accounts,
    read_upserted_posts,
    stream_ingest,
    stream_upsert_blogs,
    stream_upsert_posts,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return plain(build(configure(spark), sf))

    QUERIES[build.__name__.removesuffix("_query")] = run
    return run


def now():
    return F.lit(NOW).cast("timestamp")


def position(messages: DataFrame) -> DataFrame:
    return messages.select("partition", "offset")


def early(spark: SparkSession, sf: str) -> DataFrame:
    """The part of the log that a first run finds."""
    return feeds.events(spark, sf).where(F.col("ts") < F.lit(FIRST_RUN_ENDS).cast("timestamp_ntz"))


def late(spark: SparkSession, sf: str) -> DataFrame:
    """What the log has got when a second run comes: all the rest, rows without a time too."""
    is_early = F.col("ts") < F.lit(FIRST_RUN_ENDS).cast("timestamp_ntz")
    return feeds.events(spark, sf).where(~F.coalesce(is_early, F.lit(False)))


# Scans


@query
def scan_earliest(spark, sf):
    return position(log.replay(feeds.post_messages(feeds.events(spark, sf))))


@query
def scan_from_offsets(spark, sf):
    read = op.offsets_of(feeds.post_rows(early(spark, sf)), TOPIC, GROUP, EXEC_DATE, "06-00")
    starts = op.resume_offsets(read, feeds.topic_partitions(spark))
    return position(log.replay(feeds.post_messages(feeds.events(spark, sf)), starts))


@query
def scan_resume_or_earliest(spark, sf):
    path = scratch_dir(spark, "offsets")
    first = position(log.replay_resumed(feeds.post_messages(early(spark, sf)), path))
    read = first.select(
        F.col("partition").alias("kafkapartition"), F.col("offset").alias("kafkaoffset")
    )
    append_offsets(op.offsets_of(read, TOPIC, GROUP, EXEC_DATE, "06-00"), path, first_run=True)
    second = position(log.replay_resumed(feeds.post_messages(feeds.events(spark, sf)), path))
    return first.select(F.lit("first").alias("run"), "*").union(
        second.select(F.lit("second").alias("run"), "*")
    )


@query
def scan_day_deltas(spark, sf):
    base = scratch_dir(spark, "blogs")
    rows = feeds.blogs(spark, sf, None)
    day = dt.date.fromisoformat(EXEC_DATE)
    noon = dt.datetime.combine(day, dt.time(12))
    today, morning = F.col("execdate") == EXEC_DATE, F.col("currenttimestamp") < F.lit(noon)
    write_run(rows.where(today & morning), run_path(base, day, noon))
    write_run(rows.where(today & ~morning), run_path(base, day, noon + dt.timedelta(hours=12)))
    write_run(rows.where(~today), run_path(base, day - dt.timedelta(days=1), noon))
    return files.read_day(spark, base, EXEC_DATE)


@query
def scan_declared_schema(spark, sf):
    base = scratch_dir(spark, "posts")
    path = files.day_path(base, EXEC_DATE)
    feeds.posts(spark, sf, None).write.orc(f"{path}/06-00")
    return files.read_day(spark, base, EXEC_DATE, ddl(POSTS_DELTA), "orc")


@query
def scan_history_partitions(spark, sf):
    path = scratch_dir(spark, "history")
    write_stored_posts(history(spark, sf), path)
    stored = read_stored_posts(spark, path, LOWER, EXEC_DATE)
    days = in_range(feeds.posts(spark, sf)).select(F.col(DAY).alias(POST_DATE))
    days = days_of_range(days, LOWER, EXEC_DATE, POST_DATE)
    return op.filter_days(stored, days, POST_DATE).select(*MERGED_POSTS)


@query
def scan_csv(spark, sf):
    path = scratch_dir(spark, "csv")
    micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    rows = feeds.metrics(spark, sf, None)
    rows.write.option("header", True).option("timestampFormat", micros).csv(path)
    return files.read_csv(spark, path, ddl(METRICS_DELTA), required=["comments"])


DRIFT = {
    "2024-01-17": "to_json(struct(event_id id, cast(floor(value) as bigint) amount, user_id % 7 code, struct(user_id id) user, array(user_id % 3, event_id % 5) tags))",
    "2024-01-18": "to_json(struct(event_id id, cast(floor(value) as bigint) + 0.5D amount, user_id % 7 code, struct(user_id id, event_type kind) user, array(user_id % 3) tags))",
    "2024-01-19": "to_json(struct(event_id id, concat('c', user_id % 7) code, struct(concat('u', user_id) id) user, array(event_type) tags, user_id % 2 = 0 even))",
}


@query
def scan_evolved_schema(spark, sf):
    """Days up to 17, the 18th and those from the 19th on write other types, each as its messages infer them."""
    base = scratch_dir(spark, "drift")
    days = F.least(F.greatest(F.date_format("ts", "yyyy-MM-dd"), F.lit(min(DRIFT))), F.lit(max(DRIFT)))
    for day, message in DRIFT.items():
        sent = feeds.events(spark, sf).where(days == F.lit(day))
        sent = sent.select(F.expr(message).alias("value"), F.expr("cast(user_id % 16 as int)").alias("partition"), F.col("event_id").alias("offset"))
        rows = op.decode_json(sent, op.infer_json_schema(sent))
        evolution.register_schema(spark, base, rows.schema)
        write_run(rows, run_path(base, day, RUN_AT))
    read = evolution.read_evolved(spark, base, list(DRIFT))
    return read.select("id", "amount", "code", F.col("user.id").alias("user_id"), F.col("user.kind").alias("kind"), "tags", "even", "kafkaoffset")


# Decoding


def decoded_posts(decoded: DataFrame) -> DataFrame:
    return decoded.select(
        F.col("Url").alias("posturl"),
        F.col("CreateDate").alias("partdate"),
        F.col("Type").alias("posttype"),
        F.col("BlogansLanguage").alias("language"),
        F.col("IsSpam").alias("spam"),
        F.size("Topics").cast("int").alias("topics"),
        F.col("Author.Url").alias("author"),
        F.col("Blog.Metrics.FollowerCount").alias("followers"),
    )


@query
def decode_json(spark, sf):
    messages = feeds.post_messages(feeds.events(spark, sf))
    return decoded_posts(op.decode_json(messages, POST_JSON))


@query
def json_infer_schema(spark, sf):
    messages = feeds.post_messages(feeds.events(spark, sf))
    return decoded_posts(op.decode_json(messages, op.infer_json_schema(messages)))


@query
def decode_json_missing_fields(spark, sf):
    rows = feeds.posts(spark, sf, None)
    bare = F.struct(
        F.col("posturl").alias("Url"), F.date_format("partdate", feeds.STAMP).alias("CreateDate")
    )
    flat = plans.POSTS.rows(feeds.envelope(rows, bare), EXEC_DATE, now())
    return flat.select(
        "id", "posturl", "partdate", "authorurl", "blogfollowers", "commentscount", "topics"
    )


@query
def flatten_posts(spark, sf):
    return plans.POSTS.rows(feeds.post_messages(feeds.events(spark, sf)), EXEC_DATE, now())


@query
def flatten_blogs(spark, sf):
    return plans.BLOGS.rows(feeds.blog_messages(feeds.events(spark, sf)), EXEC_DATE, now())


@query
def flatten_metrics(spark, sf):
    return plans.METRICS.rows(feeds.metric_messages(feeds.events(spark, sf)), EXEC_DATE, now())


@query
def topics_ids(spark, sf):
    decoded = op.decode_json(feeds.post_messages(feeds.events(spark, sf)), POST_JSON)
    return decoded.select(
        F.col("kafkaoffset").alias("offset"), op.topic_ids("Topics").alias("topics")
    )


# Projections and filters


def all_posts(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.posts(spark, sf, feeds.ALL_POSTS)


def all_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.metrics(spark, sf, feeds.ALL_METRICS)


def in_range(rows: DataFrame) -> DataFrame:
    return op.filter_date_range(rows, "partdate", LOWER, EXEC_DATE)


@query
def suffix_collisions(spark, sf):
    return op.suffix_collisions(feeds.metrics(spark, sf, None), feeds.posts(spark, sf, None))


@query
def filter_date_range(spark, sf):
    chosen = ["kafkaoffset", F.col(DAY).alias("day")]
    return (
        in_range(feeds.posts(spark, sf, None))
        .select(*chosen)
        .union(in_range(feeds.metrics(spark, sf, None)).select(*chosen))
    )


@query
def filter_batch_dates(spark, sf):
    rows = all_metrics(spark, sf).withColumn(DAY, fn.as_date("partdate"))
    days = days_of_range(in_range(all_posts(spark, sf)), LOWER, EXEC_DATE)
    return (
        op.filter_days(rows, days)
        .select(F.lit("frame").alias("how"), "kafkaoffset")
        .union(
            op.filter_days(rows, [LOWER, EXEC_DATE]).select(
                F.lit("list").alias("how"), "kafkaoffset"
            )
        )
    )


@query
def distinct_partitions(spark, sf):
    days = op.distinct_days(in_range(all_posts(spark, sf)))
    return days.select(F.col(DAY).cast("string").alias("day")).orderBy("day")


# Joins and merges


@query
def merge_delta_posts_metrics(spark, sf):
    return op.join_posts_metrics(in_range(all_posts(spark, sf)), in_range(all_metrics(spark, sf)))


@query
def latest_post_with_metrics(spark, sf):
    return op.merge_latest_posts_metrics(
        in_range(all_posts(spark, sf)), in_range(all_metrics(spark, sf))
    )


def delta(spark, sf):
    posts, metrics = feeds.posts(spark, sf), feeds.metrics(spark, sf)
    return plans.merge_posts_metrics(posts, metrics, None, LOWER, EXEC_DATE)


def history(spark, sf):
    posts = feeds.posts(spark, sf, feeds.OLD_POSTS)
    metrics = feeds.metrics(spark, sf, feeds.OLD_METRICS)
    return plans.merge_posts_metrics(posts, metrics, None, "2024-01-01", "2024-01-30")


@query
def latest_posts_metrics_fused(spark, sf):
    posts, metrics = all_posts(spark, sf), all_metrics(spark, sf)
    return plans.merge_posts_metrics(posts, metrics, None, LOWER, EXEC_DATE)


@query
def overlay_history(spark, sf):
    return op.overlay_history(delta(spark, sf), history(spark, sf))


@query
def merge_posts_history(spark, sf):
    return op.merge_history(delta(spark, sf), history(spark, sf))


@query
def merge_posts_metrics(spark, sf):
    posts, metrics = feeds.posts(spark, sf), feeds.metrics(spark, sf)
    return plans.merge_posts_metrics(posts, metrics, history(spark, sf), LOWER, EXEC_DATE)


@query
def merge_posts_batched(spark, sf):
    posts, metrics = feeds.posts(spark, sf), feeds.metrics(spark, sf)
    return plans.merge_posts_metrics(
        posts, metrics, history(spark, sf), LOWER, EXEC_DATE, batch_size=7
    )


@query
def merge_posts_first_run(spark, sf):
    base = scratch_dir(spark, "first")
    posts, metrics, merged = f"{base}/posts", f"{base}/metrics", f"{base}/merged"
    all_posts(spark, sf).write.parquet(f"{files.day_path(posts, EXEC_DATE)}/06-00")
    all_metrics(spark, sf).write.parquet(f"{files.day_path(metrics, EXEC_DATE)}/06-00")
    plans.merge_posts(spark, posts, metrics, merged, EXEC_DATE, LOWER)
    return spark.read.parquet(merged).select(*MERGED_POSTS)


@query
def dedupe_blogs_delta(spark, sf):
    return op.latest_accounts(feeds.blogs(spark, sf, None))


def snapshot(spark, sf):
    old = feeds.blogs(spark, sf, feeds.OLD_BLOGS)
    return op.merge_accounts(old, None, SNAPSHOT_DATE.replace("-", ""))


@query
def union_history_delta(spark, sf):
    return op.union_by_name(snapshot(spark, sf), feeds.blogs(spark, sf))


@query
def merge_blogs(spark, sf):
    merge_date = EXEC_DATE.replace("-", "")
    return op.merge_accounts(feeds.blogs(spark, sf), snapshot(spark, sf), merge_date)


@query
def merge_blogs_first_run(spark, sf):
    base = scratch_dir(spark, "accounts")
    feeds.blogs(spark, sf, None).write.parquet(f"{files.day_path(base + '/blogs', EXEC_DATE)}/06-00")
    return spark.read.parquet(
        plans.merge_blogs(spark, f"{base}/blogs", f"{base}/merged", EXEC_DATE)
    )


@query
def latest_per_key(spark, sf):
    order = [
        "l_shipdate",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
        "l_quantity",
        "l_discount",
        "l_tax",
    ]
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    return op.latest_per_key(lines, ["l_orderkey"], order, ())


# Offsets


@query
def offsets_commit(spark, sf):
    path = scratch_dir(spark, "offsets")
    rows = feeds.post_rows(early(spark, sf))
    append_offsets(op.offsets_of(rows, TOPIC, GROUP, EXEC_DATE, "06-00"), path, first_run=True)
    late = feeds.events(spark, sf).where(F.col("ts") >= F.lit(FIRST_RUN_ENDS).cast("timestamp_ntz"))
    append_offsets(op.offsets_of(feeds.post_rows(late), TOPIC, GROUP, EXEC_DATE, "07-00"), path)
    return spark.read.parquet(path)


@query
def offsets_latest_run(spark, sf):
    return op.latest_run(feeds.offset_log(spark, sf), TOPIC, GROUP)


def resumed(spark, sf, **how):
    partitions = feeds.topic_partitions(spark)
    return op.resume_offsets(feeds.offset_log(spark, sf), partitions, topic=TOPIC, group=GROUP, **how)


@query
def offsets_resume(spark, sf):
    return resumed(spark, sf)


@query
def offsets_resume_latest_run(spark, sf):
    return resumed(spark, sf, scope="latest_run", missing=-1)


@query
def offsets_compact(spark, sf):
    return op.compact_offsets(feeds.offset_log(spark, sf))


@query
def offsets_json(spark, sf):
    return op.starting_offsets_json(resumed(spark, sf), TOPIC)


# Sinks


@query
def sink_run_dir(spark, sf):
    path = scratch_dir(spark, "run")
    rows = feeds.blog_messages(feeds.events(spark, sf))
    write_run(plans.BLOGS.rows(rows, EXEC_DATE, now()), path)
    return spark.read.parquet(path)


@query
def sink_partitioned(spark, sf):
    path = scratch_dir(spark, "run")
    write_run(feeds.posts(spark, sf, None), path, plans.POSTS.day_of)
    return spark.read.parquet(path)


@query
def sink_clustered(spark, sf):
    path = scratch_dir(spark, "run")
    write_clustered(feeds.posts(spark, sf, None), path, "id", files=16, day_of=plans.POSTS.day_of)
    return spark.read.parquet(path)


@query
def sink_snapshot(spark, sf):
    base = scratch_dir(spark, "snapshot")
    every = op.merge_accounts(feeds.blogs(spark, sf, None), None, SNAPSHOT_DATE.replace("-", ""))
    return spark.read.parquet(write_snapshot(every, base, SNAPSHOT_DATE, "accountid", files=8))


@query
def replace_partitions_query(spark, sf):
    path = scratch_dir(spark, "merged")
    write_stored_posts(history(spark, sf), path)
    stored = read_stored_posts(spark, path, LOWER, EXEC_DATE)
    posts, metrics = feeds.posts(spark, sf), feeds.metrics(spark, sf)
    merged = plans.merge_posts_metrics(posts, metrics, stored, LOWER, EXEC_DATE)
    write_stored_posts(merged, path)
    return spark.read.parquet(path).select(*MERGED_POSTS)


@query
def merge_blogs_bucketed(spark, sf):
    base, table = scratch_dir(spark, "bucketed"), f"accounts_{uuid.uuid4().hex}"
    create_blogs_table(spark, table, 4, f"{base}/table")
    old = snapshot(spark, sf).withColumn("snapshotdate", F.lit(SNAPSHOT_DATE).cast("date"))
    replace_table_days(old, table)
    feeds.blogs(spark, sf).write.parquet(f"{files.day_path(base + '/blogs', EXEC_DATE)}/06-00")
    merge_blogs_table(spark, f"{base}/blogs", table, EXEC_DATE)
    today = spark.table(table).where(F.col("snapshotdate") == F.lit(EXEC_DATE).cast("date"))
    return today.drop("snapshotdate")


@query
def merge_posts_bucketed(spark, sf):
    base, table = scratch_dir(spark, "bucketed"), f"posts_{uuid.uuid4().hex}"
    create_posts_table(spark, table, 4, f"{base}/table")
    old = history(spark, sf).withColumn("partdate", F.col(POST_DATE))
    replace_table_days(old, table)
    for name, rows in {"posts": feeds.posts, "metrics": feeds.metrics}.items():
        rows(spark, sf).write.parquet(f"{files.day_path(f'{base}/{name}', EXEC_DATE)}/06-00")
    merge_posts_table(spark, f"{base}/posts", f"{base}/metrics", table, EXEC_DATE, LOWER)
    return spark.table(table).select(*MERGED_POSTS)


@query
def merge_posts_by_parts(spark, sf):
    """Stored posts come as a first merge of their own; the day's then touches some parts."""
    base = scratch_dir(spark, "parts")
    old, posts, metrics = f"{base}/merged", f"{base}/posts", f"{base}/metrics"
    sides = {
        "2024-01-30": (feeds.posts(spark, sf, feeds.OLD_POSTS), feeds.metrics(spark, sf, feeds.OLD_METRICS), "2024-01-01"),
        EXEC_DATE: (feeds.posts(spark, sf), feeds.metrics(spark, sf), LOWER),
    }
    for day, (new_posts, new_metrics, lower) in sides.items():
        write_run(new_posts, run_path(posts, day, RUN_AT), plans.POSTS.day_of)
        write_run(new_metrics, run_path(metrics, day, RUN_AT), plans.METRICS.day_of)
        merge_posts_parts(spark, posts, metrics, old, day, lower, parts=8)
    return read_posts_parts(spark, old)


# Pipelines

RUN_AT = dt.datetime(2024, 1, 20, 6)


LOG_BLOCK = 16 << 20


def ingested(spark, sf, feed, messages, topic) -> DataFrame:
    """Two runs, the second after the offsets of the first: rows, broken text, offsets, counts.

    The log grows between them. Its files and row groups are even, however the events lie in theirs, so
    that reading it uses all cores.
    """
    base = scratch_dir(spark, "ingest")
    rows, offsets = f"{base}/rows", f"{base}/offsets"
    runs = []
    for k, events in enumerate((early(spark, sf), late(spark, sf))):
        added = feeds.with_broken(messages(events.repartition("event_id")))
        added.write.option("parquet.block.size", LOG_BLOCK).parquet(f"{base}/log{k}")
        grown = spark.read.parquet(*[f"{base}/log{i}" for i in range(k + 1)])
        sent = log.replay_resumed(grown, offsets, topic, GROUP)
        at = RUN_AT + dt.timedelta(hours=k)
        runs.append(plans.ingest(feed, sent, rows, offsets, topic, GROUP, EXEC_DATE, at, now()))
    place = ["kafkapartition", "kafkaoffset"]
    none = F.lit(None).cast("string")
    kept = files.read_day(spark, rows, EXEC_DATE).select(F.lit("row").alias("kind"), *place, F.col(feed.key).alias("text"))
    broken = [spark.read.parquet(broken_path(rows, r.path)) for r in runs]
    texts = broken[0].union(broken[1]).select(F.lit("broken").alias("kind"), *place, F.col(BROKEN).alias("text"))
    logged = spark.read.parquet(offsets).select(F.lit("offset").alias("kind"), place[0], F.col("latestoffset").alias(place[1]), none.alias("text"))
    counts = spark.createDataFrame(
        [("count", k, n, what) for k, r in enumerate(runs) for what, n in zip(("rows", "keyless", "broken"), r[1:])],
        "kind STRING, kafkapartition INT, kafkaoffset BIGINT, text STRING",
    )
    return kept.union(texts).union(logged).union(counts)


@query
def ingest_posts(spark, sf):
    return ingested(spark, sf, plans.POSTS, feeds.post_messages, "Posts")


@query
def ingest_metrics(spark, sf):
    return ingested(spark, sf, plans.METRICS, feeds.metric_messages, "Metrics")


@query
def ingest_blogs(spark, sf):
    return ingested(spark, sf, plans.BLOGS, feeds.blog_messages, "Blogs")


@query
def merge_blogs_after_gap(spark, sf):
    """Day 17 is merged, day 18 is missed, day 19 takes both."""
    base = scratch_dir(spark, "gap")
    rows, days = feeds.blogs(spark, sf, None), ["2024-01-17", "2024-01-18", "2024-01-19"]
    for day in days:
        write_run(rows.where(F.col("execdate") == day), run_path(f"{base}/blogs", day, RUN_AT))
    plans.merge_blogs(spark, f"{base}/blogs", f"{base}/merged", days[0])
    return spark.read.parquet(plans.merge_blogs(spark, f"{base}/blogs", f"{base}/merged", days[-1]))


@query
def merge_blogs_layers(spark, sf):
    """Four days one after the other; buckets are rewritten at the third layer."""
    base, rows = scratch_dir(spark, "layers"), feeds.blogs(spark, sf, None)
    for day in ("2024-01-17", "2024-01-18", "2024-01-19", EXEC_DATE):
        write_run(rows.where(F.col("execdate") == day), run_path(f"{base}/blogs", day, RUN_AT))
        merge_blogs_incremental(spark, f"{base}/blogs", f"{base}/accounts", day, buckets=16, layers=2)
    return read_accounts_of_day(spark, f"{base}/accounts", EXEC_DATE)


LATE_DAYS = ["2024-01-17", "2024-01-18", "2024-01-19"]


@query
def merge_late_runs(spark, sf):
    """Of every day a third comes late, after that day was merged, and the next merge takes it; day 18 has no merge."""
    base, rows = scratch_dir(spark, "late"), feeds.blogs(spark, sf, None)
    blogs, accounts, noted = (f"{base}/{n}" for n in ("blogs", "accounts", "ledger"))

    def send(day, late):
        run = run_path(blogs, day, RUN_AT + dt.timedelta(hours=late))
        write_run(rows.where(F.col("execdate") == day).where((F.col("kafkaoffset") % 3 == 0) == F.lit(bool(late))), run)
        ledger.record_written(spark, noted, "blogs", [run])

    for day in LATE_DAYS:
        send(day, 0)
        if day != LATE_DAYS[1]:
            merge_blogs_runs(spark, blogs, accounts, noted, day)
        send(day, 1)
    merge_blogs_runs(spark, blogs, accounts, noted, EXEC_DATE)
    return spark.read.parquet(files.day_path(accounts, EXEC_DATE))


@query
def offset_gaps(spark, sf):
    """Reads that miss every seventh message of some partitions and repeat others, against what was committed."""
    rows = feeds.events(spark, sf).selectExpr("cast(user_id % 16 as int) kafkapartition", "event_id kafkaoffset")
    ends = rows.groupBy("kafkapartition").agg((F.max("kafkaoffset") + 3).alias("latestoffset"))
    read = rows.where("kafkaoffset % 7 <> 3")
    return op.offset_gaps(read.union(rows.where("kafkaoffset % 11 = 5")), ends, block=1000)


@query
def merge_day(spark, sf):
    """Two days of all feeds over stored posts and a stored snapshot."""
    base = scratch_dir(spark, "day")
    blogs, posts, metrics, accounts, merged = (f"{base}/{n}" for n in ("blogs", "posts", "metrics", "accounts", "merged"))
    write_stored_posts(history(spark, sf), merged)
    write_snapshot(snapshot(spark, sf), accounts, SNAPSHOT_DATE, "accountid")
    for k, day in enumerate(("2024-01-19", EXEC_DATE)):
        half = F.col("kafkaoffset") % 2 == k
        write_run(feeds.blogs(spark, sf).where(half), run_path(blogs, day, RUN_AT))
        write_run(feeds.posts(spark, sf).where(half), run_path(posts, day, RUN_AT), plans.POSTS.day_of)
        write_run(feeds.metrics(spark, sf).where(half), run_path(metrics, day, RUN_AT), plans.METRICS.day_of)
        daily.merge_day(spark, blogs, accounts, posts, metrics, merged, day, LOWER)
    shown = ["likescount", "viewscount", "commentscount", "kafkaoffset"]
    kept = spark.read.parquet(merged).select(F.lit("post").alias("kind"), F.col(POST_KEY).alias("key"), F.col(POST_DATE).cast("string").alias("day"), *shown)
    newest = spark.read.parquet(files.day_path(accounts, EXEC_DATE))
    return kept.union(newest.select(F.lit("account"), "accountid", "mergedate", *shown))


# Retention


@query
def retention_keep(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    return op.kept(orders, "o_orderdate", "1997-01-01", "1998-12-31")


@query
def retention_expired(spark, sf):
    lower, upper = "1997-01-01", "1998-12-31"
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    gone = op.expired(orders, "o_orderdate", lower, upper)
    counts = gone.groupBy(fn.as_date("o_orderdate").alias("day")).agg(
        F.count("*").alias("rows_expired")
    )
    days = fn.date_series(spark, lower, upper)
    return days.join(counts, "day", "left").select(
        "day", F.coalesce("rows_expired", F.lit(0).cast("bigint")).alias("rows_expired")
    )


@query
def retention_remove(spark, sf):
    base = scratch_dir(spark, "deltas")
    rows = feeds.blogs(spark, sf, None).select("accountid", "kafkaoffset", "execdate")
    replace_partitions(rows, base, ["execdate"])
    remove_days(spark, base, LOWER, EXEC_DATE)
    return spark.read.schema("accountid STRING, kafkaoffset BIGINT, execdate STRING").parquet(base)


@query
def retention_guarded(spark, sf):
    """An hourly run for each hour of events; those of every fifth hour are not merged yet."""
    hours = feeds.events(spark, sf).groupBy(F.date_format("ts", "yyyyMMdd/'run='HH").alias("run"), F.to_date("ts").alias("runday")).agg(F.max(F.hour("ts")).alias("h"))
    written = hours.select(F.lit("events").alias("feed"), "run", "runday", F.lit(None).cast("date").alias("mergedday"))
    merged = hours.where((F.dayofmonth("runday") % 3 != 0) | (F.col("h") % 5 != 0)).select(F.lit("events").alias("feed"), "run", "runday", F.date_add("runday", 1).alias("mergedday"))
    return plain(ledger.guarded_days(written.union(merged), LOWER, EXEC_DATE))


# Scalar functions


def page_keys(spark, sf, algorithm):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    return pages.select("page_id", fn.url_key("url", algorithm).alias("url_key"))


@query
def url_key(spark, sf):
    return page_keys(spark, sf, "MD5")


@query
def url_key_sha1(spark, sf):
    return page_keys(spark, sf, "SHA-1")


@query
def url_key_sha256(spark, sf):
    return page_keys(spark, sf, "SHA-256")


@query
def key_bucket(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_custkey").alias("c_custkey"))
    customers = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey")
    bucket = fn.key_bucket(F.concat(F.lit("c/"), F.col("c_custkey")), 255)
    return orders.union(customers).select("c_custkey", bucket.alias("bucket"))


@query
def exec_date_formats(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    return orders.select(
        "o_orderkey",
        fn.compact_date("o_orderdate").alias("compact"),
        fn.as_date("o_orderdate").cast("string").alias("dashed"),
    )


@query
def run_window(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    defaults = fn.run_window("o_orderdate")
    return orders.select("o_orderkey", *[c.alias(name) for name, c in defaults.items()])


# Streaming


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events as a file stream; the pattern fits a file and a folder of that name."""
    return spark.readStream.schema(feeds.EVENTS).parquet(f"{sf}/events.parquet*")


def late_event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events in eight files, two to a micro-batch, each with rows of all times."""
    path = scratch_dir(spark, "events")
    feeds.events(spark, sf).repartition(8, "event_id").write.parquet(path)
    return spark.readStream.schema(feeds.EVENTS).option("maxFilesPerTrigger", 2).parquet(path)


def streamed(spark, sf, feed, messages, fields) -> DataFrame:
    base = scratch_dir(spark, "stream")
    stream_ingest(
        feed, messages, f"{base}/rows", f"{base}/checkpoint", EXEC_DATE, now()
    ).awaitTermination()
    return files.read_day(spark, f"{base}/rows", EXEC_DATE).select(*fields)


@query
def stream_ingest_posts(spark, sf):
    messages = feeds.post_messages(event_stream(spark, sf))
    return streamed(spark, sf, plans.POSTS, messages, plans.POSTS.fields)


@query
def stream_ingest_metrics(spark, sf):
    messages = feeds.metric_messages(event_stream(spark, sf))
    return streamed(spark, sf, plans.METRICS, messages, plans.METRICS.fields)


@query
def stream_ingest_blogs(spark, sf):
    messages = feeds.blog_messages(event_stream(spark, sf))
    return streamed(spark, sf, plans.BLOGS, messages, plans.BLOGS.fields)


@query
def stream_upsert_blogs_query(spark, sf):
    base = scratch_dir(spark, "accounts")
    stream_upsert_blogs(
        feeds.blog_rows(late_event_stream(spark, sf)),
        f"{base}/accounts",
        f"{base}/checkpoint",
        EXEC_DATE.replace("-", ""),
    ).awaitTermination()
    return read_accounts(spark, f"{base}/accounts")


@query
def stream_upsert_posts_query(spark, sf):
    base = scratch_dir(spark, "posts")
    stream = late_event_stream(spark, sf)
    stream_upsert_posts(
        feeds.post_rows(stream.where(F.col("event_type").isin(*feeds.ALL_POSTS))),
        feeds.metric_rows(stream.where(F.col("event_type").isin(*feeds.ALL_METRICS))),
        f"{base}/merged",
        f"{base}/checkpoint",
        LOWER,
        EXEC_DATE,
    ).awaitTermination()
    return read_upserted_posts(spark, f"{base}/merged").select(*MERGED_POSTS)
