import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks import feeds
from feedmerge.plans import BLOGS, POSTS, count_rows, ingest, merge_blogs, merge_posts
from feedmerge.plans.daily import merge_day
from feedmerge.plans.ingest import broken_path
from feedmerge.plans.merge_blogs import create_blogs_table, merge_blogs_table
from feedmerge.plans.merge_posts import (
    create_posts_table,
    merge_posts_metrics,
    merge_posts_table,
    read_deltas,
    read_stored_posts,
    write_stored_posts,
)
from feedmerge.operators import filter_date_range, merge_accounts
from feedmerge.schemas import MERGED_POSTS, METRICS_DELTA, POST_DATE, POSTS_DELTA, ddl
from feedmerge.sinks import replace_partitions, run_path, write_run
from feedmerge.sinks.retention import drop_table_days, expired_names, remove_days
from feedmerge.sinks.tables import bucket_count, replace_table_days
from feedmerge.sources.files import child_names, read_csv, read_day, read_snapshot_before
from feedmerge.sources.log import replay_resumed
from helpers import metrics, plan, posts, rows

DAY = "2024-01-20"
NOW = dt.datetime(2024, 1, 20, 6, 30)


def events(spark, sf):
    return feeds.events(spark, sf)


def test_ingest_resumes_and_repeats_nothing(spark, sf, tmp_path):
    base, log = str(tmp_path / "posts"), str(tmp_path / "offsets")
    all_events = events(spark, sf)
    sent = feeds.post_messages(all_events)
    early = feeds.post_messages(all_events.where("ts < timestamp_ntz'2024-01-10'"))
    first = ingest(POSTS, replay_resumed(early, log), base, log, "Posts", "g", DAY, NOW)
    later = NOW + dt.timedelta(hours=1)
    second = ingest(POSTS, replay_resumed(sent, log), base, log, "Posts", "g", DAY, later)
    third = ingest(
        POSTS, replay_resumed(sent, log), base, log, "Posts", "g", DAY, later + dt.timedelta(hours=1)
    )
    assert first < second < third
    assert spark.read.parquet(first.path).count() == early.count()
    both = read_day(spark, base, DAY)
    assert both.count() == sent.count() == both.select("kafkapartition", "kafkaoffset").distinct().count()
    assert "postdate" in both.columns
    logged = spark.read.parquet(log)
    assert logged.select("exectime").distinct().count() == 2


def test_ingest_of_an_empty_batch(spark, sf, tmp_path):
    base, log = str(tmp_path / "blogs"), str(tmp_path / "offsets")
    none = feeds.blog_messages(events(spark, sf).where("false"))
    path, *_ = ingest(BLOGS, none, base, log, "Blogs", "g", DAY, NOW)
    assert spark.read.parquet(path).count() == 0


def test_rows_without_key_are_counted(spark, tmp_path):
    base, log = str(tmp_path / "posts"), str(tmp_path / "offsets")
    texts = ['{"Url": "u", "CreateDate": "2024-01-06"}', "{broken", '{"Type": 1}']
    sent = spark.createDataFrame(
        [(bytearray(t, "utf8"), 0, i) for i, t in enumerate(texts)],
        "value BINARY, partition INT, offset BIGINT",
    )
    done = ingest(POSTS, sent, base, log, "Posts", "g", DAY, NOW)
    assert count_rows(spark, POSTS, done.path) == (3, 2)
    assert done[1:] == (3, 2, 1)
    kept = spark.read.parquet(broken_path(base, done.path)).collect()
    assert [(r.kafkaoffset, r.brokentext) for r in kept] == [(1, "{broken")]
    assert spark.read.parquet(log).first().latestoffset == 2


def test_run_folders_sort_by_time():
    zone = dt.timezone(dt.timedelta(hours=3))
    evening = run_path("/b", DAY, dt.datetime(2024, 1, 21, 2, 59, tzinfo=zone))
    after_midnight = run_path("/b", DAY, dt.datetime(2024, 1, 21, 3, 1, tzinfo=zone))
    assert evening < after_midnight
    assert evening.startswith("/b/20240120/run=20240120T2359")


def test_blog_merge_over_three_days(spark, sf, tmp_path):
    base, out = str(tmp_path / "blogs"), str(tmp_path / "merged")
    days = [dt.date(2024, 1, d) for d in (10, 11, 13)]
    rows_all = feeds.blogs(spark, sf, None)
    for day in days:
        write_run(rows_all.where(F.col("execdate") == str(day)), run_path(base, day, NOW))
    assert read_snapshot_before(spark, out, days[0]) is None
    for day in days:
        merge_blogs(spark, base, out, day)
    final = spark.read.parquet(f"{out}/20240113")
    wanted = rows_all.where(F.col("execdate").isin([str(d) for d in days]))
    assert final.count() == wanted.select("accountid").distinct().count()
    newest = wanted.groupBy("accountid").agg(F.max("currenttimestamp").alias("currenttimestamp"))
    assert rows(final.select("accountid", "currenttimestamp")) == rows(newest)
    before = rows(final)
    merge_blogs(spark, base, out, days[-1], prev_exec_date="20240111")
    assert rows(spark.read.parquet(f"{out}/20240113")) == before
    with pytest.raises(ValueError):
        merge_blogs(spark, base, out, days[-1], prev_exec_date=days[-1])


def test_missed_days_are_merged(spark, sf, tmp_path):
    base, out = str(tmp_path / "blogs"), str(tmp_path / "merged")
    rows_all = feeds.blogs(spark, sf, None)
    days = [dt.date(2024, 1, d) for d in (17, 18, 19)]
    for day in days:
        write_run(rows_all.where(F.col("execdate") == str(day)), run_path(base, day, NOW))
    create_blogs_table(spark, "gap_accounts", 3, f"{tmp_path}/table")
    for day in (days[0], days[2]):
        merge_blogs(spark, base, out, day)
        merge_blogs_table(spark, base, "gap_accounts", day)
    wanted = rows_all.where(F.col("execdate").isin([str(d) for d in days]))
    accounts = wanted.select("accountid").distinct().count()
    assert spark.read.parquet(f"{out}/20240119").count() == accounts
    table = spark.table("gap_accounts").where("snapshotdate = date'2024-01-19'")
    assert table.count() == accounts
    spark.sql("DROP TABLE gap_accounts")


def test_only_unfinished_snapshots_are_an_error(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "20240101"))
    (tmp_path / "20240101" / "_SUCCESS").unlink()
    with pytest.raises(ValueError, match="20240101|2024-01-01"):
        read_snapshot_before(spark, str(tmp_path), "2024-01-03")


def test_unfinished_snapshot_is_passed_over(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "20240101"))
    (tmp_path / "20240102").mkdir()
    (tmp_path / "notes").mkdir()
    assert read_snapshot_before(spark, str(tmp_path), "2024-01-03").count() == 1
    assert read_snapshot_before(spark, str(tmp_path), "2024-01-01") is None


def write_day(spark, base, day, post_rows, metric_rows):
    write_run(posts(spark, *post_rows), run_path(f"{base}/posts", day, NOW), "partdate")
    write_run(metrics(spark, *metric_rows), run_path(f"{base}/metrics", day, NOW), "partdate")


def at(day):
    return dt.datetime(2024, 1, day)


DAYS = [
    (
        "2024-01-06",
        [
            {"id": "a", "partdate": at(5), "likescount": 1, "metrictimestamp": "1"},
            {"id": "b", "partdate": at(6), "likescount": 1, "metrictimestamp": "1"},
        ],
        [{"id": "a", "partdate": "2024-01-05", "likes": 7, "metricstimestamp": "1"}],
    ),
    (
        "2024-01-07",
        [{"id": "c", "partdate": at(6), "likescount": 3, "metrictimestamp": "2"}],
        [
            {"id": "b", "partdate": "2024-01-06", "likes": 9, "metricstimestamp": "2"},
            {"id": "a", "partdate": "2024-01-05", "likes": 8, "metricstimestamp": "2"},
        ],
    ),
]
STORED = {("a", "2024-01-05", 7), ("b", "2024-01-06", 9), ("c", "2024-01-06", 3)}


def stored(df):
    return {(r.post_id, str(r.partdate), r.likescount) for r in df.collect()}


def test_post_merge_touches_only_processed_dates(spark, tmp_path):
    base, out = str(tmp_path), str(tmp_path / "merged")
    for day, post_rows, metric_rows in DAYS:
        write_day(spark, base, day, post_rows, metric_rows)
        untouched = tmp_path / "merged" / "partdate=2024-01-05"
        before = sorted(untouched.glob("*.parquet")) if untouched.exists() else None
        merge_posts(spark, f"{base}/posts", f"{base}/metrics", out, day, "2024-01-01")
    assert stored(spark.read.parquet(out)) == STORED
    assert sorted(untouched.glob("*.parquet")) == before
    merge_posts(spark, f"{base}/posts", f"{base}/metrics", out, DAYS[-1][0], "2024-01-01")
    assert stored(spark.read.parquet(out)) == STORED


def test_post_merge_into_a_bucketed_table(spark, tmp_path):
    base = str(tmp_path)
    create_posts_table(spark, "bucketed_posts", 3, f"{base}/table")
    assert bucket_count(spark, "bucketed_posts") == 3
    for day, post_rows, metric_rows in DAYS:
        write_day(spark, base, day, post_rows, metric_rows)
        merge_posts_table(
            spark, f"{base}/posts", f"{base}/metrics", "bucketed_posts", day, "2024-01-01"
        )
    assert stored(spark.table("bucketed_posts")) == STORED
    spark.sql("DROP TABLE bucketed_posts")


def test_history_is_pruned_while_the_merge_runs(spark, sf, tmp_path):
    path = str(tmp_path / "merged")
    history = merge_posts_metrics(
        feeds.posts(spark, sf), feeds.metrics(spark, sf), None, "2024-01-01", "2024-01-30"
    )
    write_stored_posts(history, path)
    stored = read_stored_posts(spark, path, "2024-01-05", DAY)
    two_days = feeds.posts(spark, sf).where("day(partdate) in (6, 7)")
    merged = merge_posts_metrics(two_days, feeds.metrics(spark, sf), stored, "2024-01-05", DAY)
    assert "dynamicpruning" in plan(merged)
    assert {str(r[0]) for r in merged.select(POST_DATE).distinct().collect()} == {
        "2024-01-06",
        "2024-01-07",
    }


def exchanges_above(text, marker):
    """Shuffles on the way from the result down to the first line with ``marker``."""
    lines = text.split("Initial Plan")[0].splitlines()
    first = next(i for i, line in enumerate(lines) if marker in line)
    return sum("Exchange hashpartitioning" in line for line in lines[:first])


def test_bucketed_history_is_not_shuffled(spark, sf, tmp_path):
    create_posts_table(spark, "plan_posts", 8, str(tmp_path / "table"))
    history = spark.table("plan_posts").drop(POST_DATE).withColumnRenamed("partdate", POST_DATE)
    merged = merge_posts_metrics(
        feeds.posts(spark, sf), feeds.metrics(spark, sf), history, "2024-01-05", DAY, buckets=8
    )
    text = plan(merged)
    assert "plan_posts" in text
    assert exchanges_above(text, "plan_posts") == 0
    assert "Bucketed: true" in text
    spark.sql("DROP TABLE plan_posts")


@pytest.mark.parametrize("buckets", [8, 5])
def test_bucketed_snapshot_is_not_shuffled(spark, sf, tmp_path, buckets):
    table = f"plan_blogs_{buckets}"
    create_blogs_table(spark, table, buckets, str(tmp_path / "table"))
    old = merge_accounts(feeds.blogs(spark, sf, feeds.OLD_BLOGS), None, "20240114")
    replace_table_days(old.withColumn("snapshotdate", F.lit(dt.date(2024, 1, 14))), table)
    snapshot = spark.table(table).where("snapshotdate = date'2024-01-14'")
    delta = feeds.blogs(spark, sf).withColumn("snapshotdate", F.lit(dt.date(2024, 1, 20)))
    merged = merge_accounts(delta, snapshot, "20240120", buckets).drop("snapshotdate")
    text = plan(merged)
    assert exchanges_above(text, table) == 0 and "Bucketed: true" in text
    assert rows(merged) == rows(merge_accounts(feeds.blogs(spark, sf), old, "20240120"))
    spark.sql(f"DROP TABLE {table}")


def test_blog_merge_into_a_bucketed_table(spark, sf, tmp_path):
    base = str(tmp_path / "blogs")
    create_blogs_table(spark, "bucketed_blogs", 4, str(tmp_path / "table"))
    rows_all = feeds.blogs(spark, sf, None)
    for day in ("2024-01-10", "2024-01-11"):
        write_run(rows_all.where(F.col("execdate") == day), run_path(base, day, NOW))
        merge_blogs_table(spark, base, "bucketed_blogs", day)
        merge_blogs(spark, base, str(tmp_path / "merged"), day)
    found = spark.table("bucketed_blogs").where("snapshotdate = date'2024-01-11'")
    plain = spark.read.parquet(str(tmp_path / "merged" / "20240111"))
    assert rows(found.select(*plain.columns)) == rows(plain)
    assert drop_table_days(spark, "bucketed_blogs", "snapshotdate", "2024-01-01", "2024-01-10") == [
        "snapshotdate=2024-01-10"
    ]
    assert spark.table("bucketed_blogs").select("snapshotdate").distinct().count() == 1
    spark.sql("DROP TABLE bucketed_blogs")


def test_whole_day(spark, sf, tmp_path):
    base = str(tmp_path)
    write_run(feeds.blogs(spark, sf), run_path(f"{base}/blogs", DAY, NOW))
    write_run(feeds.posts(spark, sf), run_path(f"{base}/posts", DAY, NOW), "partdate")
    write_run(feeds.metrics(spark, sf), run_path(f"{base}/metrics", DAY, NOW), "partdate")
    merge_day(
        spark,
        f"{base}/blogs",
        f"{base}/merged_blogs",
        f"{base}/posts",
        f"{base}/metrics",
        f"{base}/merged_posts",
        DAY,
        "2024-01-05",
    )
    assert child_names(spark, f"{base}/merged_blogs") == ["20240120"]
    found = spark.read.parquet(f"{base}/merged_posts").select(*MERGED_POSTS)
    wanted = merge_posts_metrics(
        feeds.posts(spark, sf), feeds.metrics(spark, sf), None, "2024-01-05", DAY
    )
    assert rows(found) == rows(wanted)


def test_deltas_prune_by_day_and_by_row_group(spark, sf, tmp_path):
    base = str(tmp_path)
    for hours in (0, 1):
        run = NOW + dt.timedelta(hours=hours)
        write_run(feeds.posts(spark, sf), run_path(f"{base}/posts", DAY, run), "partdate")
        write_run(feeds.metrics(spark, sf), run_path(f"{base}/metrics", DAY, run), "partdate")
    posts, metrics = read_deltas(spark, f"{base}/posts", f"{base}/metrics", DAY, "2024-01-05")
    assert posts.columns == list(POSTS_DELTA) and metrics.columns == list(METRICS_DELTA)
    kept = filter_date_range(posts, "partdate", "2024-01-05", DAY)
    assert kept.count() == 2 * filter_date_range(
        feeds.posts(spark, sf), "partdate", "2024-01-05", DAY
    ).count()
    text = plan(kept)
    assert "(postdate" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(partdate," in text


def test_partitions_replaced_while_read(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id", "id % 2 d").write.partitionBy("d").parquet(path)
    even = spark.read.parquet(path).where("d = 0").selectExpr("id + 100 id", "d")
    replace_partitions(even, path, ["d"])
    found = {(r.id, r.d) for r in spark.read.parquet(path).collect()}
    assert found == {(i, 1) for i in (1, 3, 5, 7, 9)} | {(100 + i, 0) for i in (0, 2, 4, 6, 8)}


def test_csv_with_header(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text(",".join(METRICS_DELTA) + "\n" + "1,u" + "," * 15 + "\n" + "2" + "," * 16 + "\n")
    df = read_csv(spark, str(path), ddl(METRICS_DELTA), required=["blogurl"])
    assert [(r.blogtype, r.blogurl, r.likes) for r in df.collect()] == [(1, "u", None)]


@pytest.mark.parametrize("style", ["%Y%m%d", "%Y-%m-%d", "day=%Y-%m-%d"])
@pytest.mark.parametrize("skip_trash", [True, False])
def test_retention_removes_both_bounds(spark, tmp_path, style, skip_trash):
    days = [dt.date(2024, 1, d) for d in range(1, 6)]
    for day in days:
        (tmp_path / f"{day:{style}}").mkdir()
    (tmp_path / "temp").mkdir()
    gone = remove_days(spark, str(tmp_path), "2024-01-02", "2024-01-04", skip_trash)
    assert gone == [f"{d:{style}}" for d in days[1:4]]
    assert child_names(spark, str(tmp_path)) == sorted([f"{days[0]:{style}}", f"{days[4]:{style}}", "temp"])
    assert remove_days(spark, str(tmp_path / "none"), "2024-01-02", "2024-01-04") == []


def test_names_that_are_no_days_never_expire():
    names = ["temp", "20240199", "2024-01-02x", "_SUCCESS", "p=5", "20240102"]
    assert expired_names(names, "2024-01-01", "2024-01-31") == ["20240102"]
