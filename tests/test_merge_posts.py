import datetime as dt

import pytest
from pyspark.sql import functions as F

from feedmerge.operators import (
    filter_date_range,
    join_posts_metrics,
    latest_posts_with_metrics,
    merge_history,
    merge_latest_posts_metrics,
    overlay_history,
    overlay_once,
    suffix_collisions,
)
from feedmerge.plans import merge_posts_metrics
from feedmerge.schemas import MERGED_POSTS, METRICS_DELTA, POSTS_DELTA, ddl
from helpers import merged, metrics, plan, posts, random_feeds, rows

LOWER, UPPER = "2024-01-05", "2024-01-20"


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def dated(df):
    return filter_date_range(df, "partdate", "2024-01-01", "2024-01-30")


def run(spark, post_rows, metric_rows, history=None, **options):
    return merge_posts_metrics(
        posts(spark, *post_rows), metrics(spark, *metric_rows), history, LOWER, UPPER, **options
    )


def test_merged_schema_is_the_union_of_both_feeds():
    assert len(POSTS_DELTA) == 24 and len(METRICS_DELTA) == 17 and len(MERGED_POSTS) == 35
    assert list(MERGED_POSTS)[-2:] == ["partdate_pmd", "post_id"]


def test_only_collisions_are_suffixed(spark):
    left, right = spark.createDataFrame([], "a INT, b INT"), spark.createDataFrame([], "b INT, c INT")
    assert suffix_collisions(right, left).columns == ["b_metrics", "c"]


def test_metric_counts_win_and_null_falls_back(spark):
    post = {"id": "x", "partdate": at(6), "commentscount": 1, "likescount": 2, "viewscount": 3}
    metric = {"id": "x", "partdate": "2024-01-06T09:00:00", "comments": 10, "likes": None}
    row = join_posts_metrics(dated(posts(spark, post)), dated(metrics(spark, metric))).first()
    assert (row.commentscount, row.likescount, row.viewscount, row.repostscount) == (10, 2, 3, None)
    assert (row.post_id, row.partdate_pmd) == ("x", dt.date(2024, 1, 6))


def test_join_needs_the_same_day_and_a_key(spark):
    joined = join_posts_metrics(
        dated(posts(spark, {"id": "x", "partdate": at(6)}, {"id": None, "partdate": at(6)})),
        dated(
            metrics(
                spark,
                {"id": "x", "partdate": "2024-01-07"},
                {"id": None, "partdate": "2024-01-06"},
            )
        ),
    )
    assert joined.count() == 4


@pytest.mark.parametrize("seed", range(4))
def test_split_join_equals_a_full_outer_join(spark, seed):
    post_rows, metric_rows = random_feeds(seed)
    p, m = dated(posts(spark, *post_rows)), dated(metrics(spark, *metric_rows))
    plain = p.alias("p").join(
        m.alias("m"),
        (F.col("p.id") == F.col("m.id")) & (F.col("p.__day") == F.col("m.__day")),
        "full_outer",
    ).select(
        F.coalesce("p.id", "m.id").alias("post_id"),
        F.coalesce("p.__day", "m.__day").alias("partdate_pmd"),
        F.coalesce("m.comments", "p.commentscount").alias("commentscount"),
        F.coalesce("m.likes", "p.likescount").alias("likescount"),
        F.col("p.kafkaoffset").alias("kafkaoffset"),
        F.col("m.kafkaoffset").alias("kafkaoffset_metrics"),
    )
    joined = join_posts_metrics(p, m)
    assert set(joined.columns) == set(MERGED_POSTS)
    assert rows(joined.select(*plain.columns)) == rows(plain)


@pytest.mark.parametrize("seed", range(6))
def test_reduced_join_picks_the_same_rows_as_all_pairs(spark, seed):
    post_rows, metric_rows = random_feeds(seed)
    p, m = dated(posts(spark, *post_rows)), dated(metrics(spark, *metric_rows))
    pairs = latest_posts_with_metrics(join_posts_metrics(p, m))
    assert rows(merge_latest_posts_metrics(p, m)) == rows(pairs)


def test_hot_post_makes_no_pairs(spark):
    days = spark.range(20_000).selectExpr("*", "timestamp'2024-01-06' t")
    hot_posts = posts(spark).unionByName(
        days.selectExpr("concat('hot', id % 1) id", "t partdate", "id kafkaoffset"),
        allowMissingColumns=True,
    )
    hot_metrics = metrics(spark).unionByName(
        days.selectExpr("concat('hot', id % 1) id", "'2024-01-06' partdate", "id kafkaoffset"),
        allowMissingColumns=True,
    )
    row = merge_posts_metrics(hot_posts, hot_metrics, None, LOWER, UPPER).collect()
    assert [(r.post_id, r.kafkaoffset, r.kafkaoffset_metrics) for r in row] == [
        ("hot0", 19_999, 19_999)
    ]


def test_bounds_are_inclusive(spark):
    found = run(spark, [{"id": f"d{d}", "partdate": at(d, 23)} for d in (4, 5, 20, 21)], [])
    assert {r.post_id for r in found.collect()} == {"d5", "d20"}


def test_metrics_follow_the_days_of_posts(spark):
    args = [{"id": "x", "partdate": at(6)}], [
        {"id": "y", "partdate": "2024-01-06T01:00:00"},
        {"id": "z", "partdate": "2024-01-07T01:00:00"},
    ]
    assert {r.post_id for r in run(spark, *args).collect()} == {"x", "y"}
    both = run(spark, *args, dates_from="both")
    assert {r.post_id for r in both.collect()} == {"x", "y", "z"}


def test_batches_keep_one_row_each(spark):
    feed = [{"id": "x", "partdate": at(d), "metrictimestamp": f"{d:02}"} for d in (6, 7, 8)], []
    assert run(spark, *feed).count() == 1
    assert {r.metrictimestamp for r in run(spark, *feed, batch_size=2).collect()} == {"07", "08"}
    assert run(spark, *feed, batch_size=1).count() == 3
    assert run(spark, *feed, batch_size=10).count() == 1


def test_rows_without_id_are_left_out(spark):
    found = run(spark, [{"partdate": at(6)}, {"id": "x", "partdate": at(6)}], [{"partdate": "2024-01-06"}])
    assert [r.post_id for r in found.collect()] == ["x"]


def test_empty_feeds(spark):
    history = merged(spark, {"post_id": "h", "partdate_pmd": dt.date(2024, 1, 6)})
    assert run(spark, [], [], history).count() == 0


def shuffles(df):
    return plan(df).count("Exchange hashpartitioning")


def wide(spark, make, name):
    """A feed whose size Spark cannot guess, so that it plans no broadcast."""
    return make(spark).unionByName(
        spark.range(100).selectExpr("concat('x', id % 7) id", f"{name} partdate", "id kafkaoffset"),
        allowMissingColumns=True,
    )


def test_reduced_join_shuffles_each_side_once_and_the_result_once(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = dated(wide(spark, posts, "timestamp'2024-01-06'"))
        m = dated(wide(spark, metrics, "'2024-01-06'"))
        assert shuffles(merge_latest_posts_metrics(p, m)) == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


DAY = dt.date(2024, 1, 6)


def test_null_never_erases(spark):
    delta = merged(
        spark, {"post_id": "x", "partdate_pmd": DAY, "commentscount": 5, "topics": None, "isspam": False}
    )
    history = merged(
        spark,
        {"post_id": "x", "partdate_pmd": DAY, "commentscount": 1, "topics": [1, None], "isspam": True},
    )
    row = overlay_history(delta, history).first()
    assert (row.commentscount, row.topics, row.isspam) == (5, [1, None], False)


def test_overlay_keeps_unmatched_and_null_keys(spark):
    delta = merged(spark, {"post_id": "new", "partdate_pmd": DAY}, {"partdate_pmd": DAY, "blogid": "d"})
    history = merged(
        spark,
        {"post_id": "old", "partdate_pmd": DAY},
        {"post_id": "new", "partdate_pmd": dt.date(2024, 1, 7)},
        {"partdate_pmd": DAY, "blogid": "h"},
    )
    assert overlay_history(delta, history).count() == 5


def test_history_may_have_other_columns(spark):
    delta = merged(spark, {"post_id": "x", "partdate_pmd": DAY, "blogid": "b"})
    history = spark.createDataFrame(
        [("extra", 4, "x", DAY)], "more STRING, likescount BIGINT, post_id STRING, partdate_pmd DATE"
    )
    row = overlay_history(delta, history).first()
    assert (row.blogid, row.likescount) == ("b", 4)
    assert overlay_history(delta, history).columns == list(MERGED_POSTS)


def test_readings_of_a_post_stay_apart_until_the_delta_has_one(spark):
    history = merged(
        spark,
        *[
            {"post_id": "x", "partdate_pmd": DAY, "metrictimestamp": t, "metricstimestamp": m, "kafkaoffset": i}
            for i, (t, m) in enumerate([("1", "a"), ("1", "b"), ("2", None), (None, None), (None, "z")])
        ],
    )
    silent = merged(spark, {"post_id": "x", "partdate_pmd": DAY, "likescount": 1})
    kept = merge_history(silent, history).collect()
    assert {(r.metrictimestamp, r.metricstimestamp, r.likescount) for r in kept} == {
        ("1", "b", 1),
        ("2", None, 1),
        (None, "z", 1),
    }
    reading = merged(spark, {"post_id": "x", "partdate_pmd": DAY, "metrictimestamp": "3"})
    assert [(r.metrictimestamp, r.metricstimestamp) for r in merge_history(reading, history).collect()] == [
        ("3", "z")
    ]


@pytest.mark.parametrize("seed", range(3))
def test_merging_twice_changes_nothing(spark, seed):
    old = merge_posts_metrics(*feeds(spark, seed + 50), None, "2024-01-01", "2024-01-30")
    once = run(spark, *random_feeds(seed), old)
    twice = run(spark, *random_feeds(seed), once)
    assert rows(twice) == rows(once)
    keys = [(r.partdate_pmd, r.post_id) for r in once.collect()]
    assert len(keys) == len(set(keys))


def feeds(spark, seed):
    post_rows, metric_rows = random_feeds(seed)
    return posts(spark, *post_rows), metrics(spark, *metric_rows)


def test_hot_history_key_is_split_and_kept_whole(spark):
    """A third of the history under one key: AQE splits its partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    ids = spark.range(0, 30_000, 1, 16)
    post = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), "id"))
    history = merged(spark).unionByName(
        ids.select(
            post.alias("post_id"),
            F.lit(DAY).alias("partdate_pmd"),
            F.col("id").cast("string").alias("metrictimestamp"),
            F.md5(F.col("id").cast("string")).alias("blogurl"),
        ),
        allowMissingColumns=True,
    )
    delta = merged(spark).unionByName(
        spark.range(1000)
        .selectExpr("if(id = 0, 'hot', concat('n', id)) post_id", "date'2024-01-06' partdate_pmd", "id likescount")
        .repartition(4),
        allowMissingColumns=True,
    )
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        result = merge_history(delta, history)
        found = result.groupBy(F.col("post_id") == "hot").count().collect()
        shown = result.select("post_id", "metrictimestamp", "likescount")
        shown.collect()
        assert "skew=true" in plan(shown)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r[0]: r[1] for r in found} == {True: 10_000, False: 20_000 + 999}


def test_hot_id_is_split_in_the_join_of_all_pairs(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    ids = spark.range(0, 30_000, 1, 16)
    key = "if(id % 3 = 0, 'hot', concat('p', id)) id"
    p = posts(spark).unionByName(
        ids.selectExpr(key, "timestamp'2024-01-06' partdate", "md5(string(id)) posturl"),
        allowMissingColumns=True,
    )
    m = metrics(spark).unionByName(
        ids.where("id > 3").selectExpr(
            "if(id = 5, 'hot', concat('p', id)) id", "'2024-01-06' partdate", "id likes"
        ),
        allowMissingColumns=True,
    )
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = join_posts_metrics(dated(p), dated(m)).select("post_id", "posturl", "likescount")
        found = joined.collect()
        assert "skew=true" in plan(joined)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    hot = [r for r in found if r.post_id == "hot"]
    assert len(hot) == 10_000 and {r.likescount for r in hot} == {5}
    # Every metric but the hot one keeps its own row; posts 1, 2 and 5 have none.
    assert len(found) == 10_000 + 29_995 + 3


@pytest.mark.parametrize("seed", range(4))
def test_one_shuffle_overlay_equals_the_join(spark, seed):
    old = merge_posts_metrics(*feeds(spark, seed + 50), None, "2024-01-01", "2024-01-30")
    new = merge_posts_metrics(*feeds(spark, seed), None, "2024-01-01", "2024-01-30")
    nulls = merged(spark, {"partdate_pmd": DAY, "blogid": "n"}, {"post_id": "p1", "blogid": "d"})
    old, new = old.unionByName(nulls), new.unionByName(nulls)
    assert rows(overlay_once(new, old)) == rows(overlay_history(new, old))
    assert rows(merge_history(new, old, once=True)) == rows(merge_history(new, old))


def test_stored_posts_are_scanned_and_shuffled_once(spark, tmp_path):
    path = str(tmp_path / "stored")
    old = merge_posts_metrics(*feeds(spark, 50), None, "2024-01-01", "2024-01-30")
    old.write.parquet(path)
    stored = spark.read.parquet(path)
    delta = spark.createDataFrame([], ddl(MERGED_POSTS)).unionByName(merged(spark, {"post_id": "x", "partdate_pmd": DAY}))
    text = plan(merge_history(delta, stored, once=True))
    assert text.count("FileScan parquet") == 1
    assert text.count("Exchange hashpartitioning") == 1
