"""The feeds, derived from the ``events`` table.

Posts repeat, within a day and over a week; some have several metrics on a day
and some have none. An account is one of ten a user keeps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EXEC_DATE = "2024-01-20"
LOWER = "2024-01-05"
SNAPSHOT_DATE = "2024-01-14"
TOPIC = "Posts"
GROUP = "g1"

EVENTS = """event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING,
    value DOUBLE, props STRING"""

# Which event types play which feed.
POSTS = ("view", "error")
METRICS = ("click",)
OLD_POSTS = ("signup",)
OLD_METRICS = ("purchase",)
BLOGS = ("view", "click")
OLD_BLOGS = ("signup", "purchase", "error")
# Without a history to lay them over, all event types are new.
ALL_POSTS = POSTS + OLD_POSTS
ALL_METRICS = METRICS + OLD_METRICS
BROKEN_TEXT = "{broken "

# Odd users write one post a day; even ones keep one post for a week.
POST_URL = """concat('https://p.example/', user_id, '/', date_format(
    case when user_id % 2 = 0 then date_trunc('week', ts) else ts end, 'yyyy-MM-dd'))"""

STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
# A part of the feeds writes times of other zones, so that an instant late or early in a
# day carries the date of the day after or before.
METRIC_TIME = f"""case when event_id % 7 = 0
    then concat(date_format(ts + interval 3 hours, "{STAMP}"), '+03:00')
    else date_format(ts, "{STAMP}") end"""
POST_TIME = f"""concat(
    date_format(partdate - make_interval(0, 0, 0, 0, if(kafkaoffset % 7 = 0, 5, 0)), "{STAMP}"),
    if(kafkaoffset % 7 = 0, '-05:00', ''))"""


def events(spark: SparkSession, sf: str, types: Sequence[str] | None = None) -> DataFrame:
    rows = spark.read.schema(EVENTS).parquet(f"{sf}/events.parquet")
    return rows if types is None else rows.where(F.col("event_type").isin(*types))


def post_rows(rows: DataFrame) -> DataFrame:
    return rows.selectExpr(
        "concat('https://a.example/', user_id) authorurl",
        "user_id % 4 accounttype",
        "user_id * 10 accountfollowers",
        "user_id % 3 bloganslanguage",
        "event_id % 500 blogfollowers",
        "md5(concat('blog/', user_id)) blogid",
        "user_id % 5 blogtype",
        "cast(floor(value) as bigint) commentscount",
        f"md5({POST_URL}) id",
        "event_id % 50 = 0 isspam",
        "event_id % 97 likescount",
        f'date_format(ts, "{STAMP}") metrictimestamp',
        "case when event_id % 4 = 0 then md5(concat('parent/', user_id % 20)) end parentid",
        "cast(ts as timestamp) partdate",
        "event_id % 6 posttype",
        f"{POST_URL} posturl",
        "event_id % 13 repostscount",
        "user_id % 7 socialnetworktype",
        "array(event_id % 9, case when event_id % 11 <> 0 then user_id % 9 end) topics",
        "case when event_id % 3 <> 0 then event_id % 1000 end viewscount",
        "cast(ts + interval 1 hour as timestamp) currenttimestamp",
        "cast(user_id % 16 as int) kafkapartition",
        "event_id kafkaoffset",
        f"'{EXEC_DATE}' execdate",
    )


def metric_rows(rows: DataFrame) -> DataFrame:
    return rows.selectExpr(
        "user_id % 5 blogtype",
        "concat('https://b.example/', user_id) blogurl",
        f"{METRIC_TIME} partdate",
        "case when event_id % 5 <> 0 then event_id % 200 end comments",
        "event_id % 300 likes",
        "event_id % 40 reposts",
        "event_id % 5000 views",
        "event_id % 11 commentnegativecount",
        "event_id % 12 commentpositivecount",
        f'date_format(ts, "{STAMP}") metricstimestamp',
        "event_id % 2 metricstype",
        f"{POST_URL} metricsurl",
        "cast(ts + interval 2 hour as timestamp) currenttimestamp",
        "cast(user_id % 16 as int) kafkapartition",
        "event_id kafkaoffset",
        f"md5({POST_URL}) id",
        f"'{EXEC_DATE}' execdate",
    )


def blog_rows(rows: DataFrame) -> DataFrame:
    return rows.selectExpr(
        "md5(concat('blog/', user_id, '/', event_id % 10)) accountid",
        "concat('https://b.example/', user_id, '/', event_id % 10) accounturl",
        "case when user_id % 3 <> 0 then concat('https://i.example/', user_id) end avatarurl",
        f'date_format(ts, "{STAMP}") partdate',
        "concat('nick', event_id % 7) nickname",
        "concat('nick', event_id % 7) name",
        "concat('1990-01-', 10 + user_id % 10) birthdate",
        "user_id % 4 educationlevel",
        "user_id % 7 socialnetworktype",
        "user_id % 5 blogtype",
        "cast(user_id % 16 as int) kafkapartition",
        "event_id kafkaoffset",
        "value commentsaverage",
        "value / 2 repostsaverage",
        "value * 2 viewsaverage",
        "value / 4 likesaverage",
        "value / 8 postsaverage",
        "event_id % 100 commentscount",
        "event_id % 10 repostscount",
        "event_id % 1000 viewscount",
        "event_id % 300 likescount",
        "event_id % 20 postscount",
        "date_format(ts, 'yyyy-MM-dd') execdate",
        "cast(ts as timestamp) currenttimestamp",
    )


def posts(spark: SparkSession, sf: str, types: Sequence[str] | None = POSTS) -> DataFrame:
    return post_rows(events(spark, sf, types))


def metrics(spark: SparkSession, sf: str, types: Sequence[str] | None = METRICS) -> DataFrame:
    return metric_rows(events(spark, sf, types))


def blogs(spark: SparkSession, sf: str, types: Sequence[str] | None = BLOGS) -> DataFrame:
    return blog_rows(events(spark, sf, types))


def envelope(rows: DataFrame, message: Column, topic: str = TOPIC) -> DataFrame:
    """Flat rows as the log would carry them."""
    return rows.select(
        F.lit(None).cast("binary").alias("key"),
        F.to_json(message).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.col("kafkapartition").alias("partition"),
        F.col("kafkaoffset").alias("offset"),
        F.col("currenttimestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def stamp(column: str) -> str:
    return f'date_format({column}, "{STAMP}")'


POST_MESSAGE = f"""struct(
    struct(authorurl as Url, accounttype as Type, socialnetworktype as ProviderType) as Author,
    struct(accountfollowers as FollowerCount, commentscount as CommentCount,
           likescount as LikeCount, repostscount as RepostCount, viewscount as ViewCount,
           metrictimestamp as Timestamp) as Metrics,
    bloganslanguage as BlogansLanguage,
    struct(blogid as UrlHash, blogtype as Type,
           struct(blogfollowers as FollowerCount) as Metrics) as Blog,
    posturl as Url, isspam as IsSpam, struct(parentid as UrlHash) as Parent,
    {POST_TIME} as CreateDate, posttype as Type,
    transform(topics, t -> struct(t as Id)) as Topics)"""

METRIC_MESSAGE = """struct(
    struct(blogtype as Type, blogurl as Url) as Blog,
    partdate as CreateDate,
    struct(comments as CommentCount, likes as LikeCount, reposts as RepostCount,
           views as ViewCount, commentnegativecount as CommentNegativeCount,
           commentpositivecount as CommentPositiveCount,
           metricstimestamp as Timestamp) as Metrics,
    metricstype as Type, metricsurl as Url)"""

BLOG_MESSAGE = """struct(
    accountid as UrlHash, accounturl as Url, avatarurl as AvatarUrl, partdate as CreateDate,
    struct(commentsaverage as CommentCount, repostsaverage as RepostCount,
           viewsaverage as ViewCount, likesaverage as LikeCount,
           postsaverage as PostCount) as MetricsAvg1w,
    struct(commentscount as CommentCount, repostscount as RepostCount, viewscount as ViewCount,
           likescount as LikeCount, postscount as PostCount) as Metrics,
    nickname as Nick, birthdate as DateOfBirth, educationlevel as EducationLevel,
    socialnetworktype as ProviderType, blogtype as Type)"""


def post_messages(rows: DataFrame) -> DataFrame:
    return envelope(post_rows(rows), F.expr(POST_MESSAGE))


def with_broken(messages: DataFrame) -> DataFrame:
    """Every twentieth message as text that is no JSON."""
    text = F.concat(F.lit(BROKEN_TEXT), F.col("offset").cast("string")).cast("binary")
    return messages.withColumn("value", F.when(F.col("offset") % 20 == 0, text).otherwise(F.col("value")))


def metric_messages(rows: DataFrame) -> DataFrame:
    return envelope(metric_rows(rows), F.expr(METRIC_MESSAGE), "Metrics")


def blog_messages(rows: DataFrame) -> DataFrame:
    return envelope(blog_rows(rows), F.expr(BLOG_MESSAGE), "Blogs")


def offset_log(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly runs of three topics and two groups; most miss some of the 16 log partitions."""
    return (
        events(spark, sf)
        .groupBy(
            F.expr("cast(user_id % 16 as int)").alias("kafkapartition"),
            F.date_format("ts", "yyyy-MM-dd").alias("execdate"),
            F.date_format("ts", "HH-'00'").alias("exectime"),
            F.expr(
                "case when event_type in ('view', 'error') then 'Posts' "
                "when event_type = 'signup' then 'Blogs' else 'Metrics' end"
            ).alias("topic"),
            F.expr("concat('g', 1 + event_id % 2)").alias("consumergroup"),
        )
        .agg(F.max("event_id").alias("latestoffset"))
        .select("kafkapartition", "latestoffset", "topic", "consumergroup", "execdate", "exectime")
    )


def topic_partitions(spark: SparkSession) -> DataFrame:
    """All partitions of the topic; the log has never seen the last two."""
    return spark.range(18).selectExpr("cast(id as int) kafkapartition")


def plain(df: DataFrame) -> DataFrame:
    """Dates, times and arrays as text, so that engines agree on every value."""
    shown = []
    for name, kind in df.dtypes:
        if kind in ("timestamp", "timestamp_ntz"):
            shown.append(f"date_format({name}, 'yyyy-MM-dd HH:mm:ss.SSSSSS') as {name}")
        elif kind == "date":
            shown.append(f"cast({name} as string) as {name}")
        elif kind.startswith("array"):
            shown.append(f"array_join(cast({name} as array<string>), ',', 'null') as {name}")
        else:
            shown.append(f"`{name}`")
    return df.selectExpr(*shown)
