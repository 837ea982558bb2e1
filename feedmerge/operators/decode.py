"""JSON messages to flat feed rows."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmerge.functions.keys import url_key

# Source path of every flat column.
BLOG_PATHS = {
    "accountid": "UrlHash",
    "accounturl": "Url",
    "avatarurl": "AvatarUrl",
    "partdate": "CreateDate",
    "nickname": "Nick",
    "name": "Nick",
    "birthdate": "DateOfBirth",
    "educationlevel": "EducationLevel",
    "socialnetworktype": "ProviderType",
    "blogtype": "Type",
    "kafkapartition": "kafkapartition",
    "kafkaoffset": "kafkaoffset",
    "commentsaverage": "MetricsAvg1w.CommentCount",
    "repostsaverage": "MetricsAvg1w.RepostCount",
    "viewsaverage": "MetricsAvg1w.ViewCount",
    "likesaverage": "MetricsAvg1w.LikeCount",
    "postsaverage": "MetricsAvg1w.PostCount",
    "commentscount": "Metrics.CommentCount",
    "repostscount": "Metrics.RepostCount",
    "viewscount": "Metrics.ViewCount",
    "likescount": "Metrics.LikeCount",
    "postscount": "Metrics.PostCount",
}

POST_PATHS = {
    "authorurl": "Author.Url",
    "accounttype": "Author.Type",
    "accountfollowers": "Metrics.FollowerCount",
    "bloganslanguage": "BlogansLanguage",
    "blogfollowers": "Blog.Metrics.FollowerCount",
    "blogid": "Blog.UrlHash",
    "blogtype": "Blog.Type",
    "commentscount": "Metrics.CommentCount",
    "id": "Url",
    "isspam": "IsSpam",
    "likescount": "Metrics.LikeCount",
    "metrictimestamp": "Metrics.Timestamp",
    "parentid": "Parent.UrlHash",
    "partdate": "CreateDate",
    "posttype": "Type",
    "posturl": "Url",
    "repostscount": "Metrics.RepostCount",
    "socialnetworktype": "Author.ProviderType",
    "topics": "Topics",
    "viewscount": "Metrics.ViewCount",
    "currenttimestamp": "currenttimestamp",
    "kafkapartition": "kafkapartition",
    "kafkaoffset": "kafkaoffset",
}

METRIC_PATHS = {
    "blogtype": "Blog.Type",
    "blogurl": "Blog.Url",
    "partdate": "CreateDate",
    "comments": "Metrics.CommentCount",
    "likes": "Metrics.LikeCount",
    "reposts": "Metrics.RepostCount",
    "views": "Metrics.ViewCount",
    "commentnegativecount": "Metrics.CommentNegativeCount",
    "commentpositivecount": "Metrics.CommentPositiveCount",
    "metricstimestamp": "Metrics.Timestamp",
    "metricstype": "Type",
    "metricsurl": "Url",
    "currenttimestamp": "currenttimestamp",
    "kafkapartition": "kafkapartition",
    "kafkaoffset": "kafkaoffset",
    "id": "Url",
}


def infer_json_schema(messages: DataFrame, column: str = "value", fraction: float | None = None) -> str:
    """Schema of the JSON text in ``column``, merged over all messages, as DDL.

    One aggregation over parsed variants with map-side partials. Numbers with a
    fraction become doubles; fields of mixed or unknown type become strings.
    """
    sample = messages if fraction is None else messages.sample(fraction)
    text = F.col(column).cast("string")
    merged = sample.select(F.schema_of_variant_agg(F.try_parse_json(text))).first()[0]
    if not merged or not merged.startswith("OBJECT<"):
        raise ValueError("no JSON object among the messages")
    typed = re.sub(r"DECIMAL\(\d+,\s*\d+\)|FLOAT", "DOUBLE", merged)
    typed = re.sub(r"(: |<)(?:VARIANT|VOID)\b", r"\1STRING", typed)
    return typed.replace("OBJECT<", "STRUCT<")


def decode_json(messages: DataFrame, schema: str, corrupt_column: str | None = None) -> DataFrame:
    """Parse the log's ``value`` with ``schema`` and expand it to columns.

    Fields missing from a message are null, and so are all fields of broken
    text; name a ``corrupt_column`` to keep that text.
    """
    options = {}
    if corrupt_column:
        schema = f"{schema}, `{corrupt_column}` STRING"
        options = {"columnNameOfCorruptRecord": corrupt_column}
    parsed = messages.select(
        F.from_json(F.col("value").cast("string"), schema, options).alias("message"),
        F.col("partition").alias("kafkapartition"),
        F.col("offset").alias("kafkaoffset"),
    )
    return parsed.select("message.*", "kafkapartition", "kafkaoffset")


def topic_ids(column: Column | str = "Topics") -> Column:
    """Ids of an array of topic structs; null arrays and null ids are kept."""
    return F.transform(column, lambda topic: topic["Id"])


def _flatten(decoded: DataFrame, paths: dict[str, str], now: Column | None) -> DataFrame:
    clock = F.current_timestamp() if now is None else now
    return decoded.withColumn("currenttimestamp", clock).selectExpr(
        *[f"{path} as {name}" for name, path in paths.items()]
    )


def flatten_blogs(decoded: DataFrame, exec_date: str, now: Column | None = None) -> DataFrame:
    flat = _flatten(decoded, {**BLOG_PATHS, "currenttimestamp": "currenttimestamp"}, now)
    return flat.select(
        *BLOG_PATHS, F.lit(exec_date).alias("execdate"), "currenttimestamp"
    )


def flatten_posts(decoded: DataFrame, exec_date: str, now: Column | None = None) -> DataFrame:
    return _flatten(decoded, POST_PATHS, now).withColumns(
        {
            "id": url_key("posturl"),
            "partdate": F.col("partdate").try_cast("timestamp"),
            "topics": topic_ids("topics"),
            "execdate": F.lit(exec_date),
        }
    )


def flatten_metrics(decoded: DataFrame, exec_date: str, now: Column | None = None) -> DataFrame:
    return _flatten(decoded, METRIC_PATHS, now).withColumns(
        {"id": url_key("metricsurl"), "execdate": F.lit(exec_date)}
    )
