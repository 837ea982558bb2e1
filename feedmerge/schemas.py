"""Schemas of the three feeds, as DDL so that importing needs no session."""

from __future__ import annotations

# The JSON wire format of the feeds.
BLOG_JSON = """
    UrlHash STRING,
    Url STRING,
    AvatarUrl STRING,
    CreateDate STRING,
    MetricsAvg1w STRUCT<CommentCount: DOUBLE, RepostCount: DOUBLE, ViewCount: DOUBLE,
                        LikeCount: DOUBLE, PostCount: DOUBLE>,
    Metrics STRUCT<CommentCount: BIGINT, RepostCount: BIGINT, ViewCount: BIGINT,
                   LikeCount: BIGINT, PostCount: BIGINT>,
    Nick STRING,
    DateOfBirth STRING,
    EducationLevel BIGINT,
    ProviderType BIGINT,
    Type BIGINT
"""

POST_JSON = """
    Author STRUCT<Url: STRING, Type: BIGINT, ProviderType: BIGINT>,
    Metrics STRUCT<FollowerCount: BIGINT, CommentCount: BIGINT, LikeCount: BIGINT,
                   RepostCount: BIGINT, ViewCount: BIGINT, Timestamp: STRING>,
    BlogansLanguage BIGINT,
    Blog STRUCT<UrlHash: STRING, Type: BIGINT, Metrics: STRUCT<FollowerCount: BIGINT>>,
    Url STRING,
    IsSpam BOOLEAN,
    Parent STRUCT<UrlHash: STRING>,
    CreateDate STRING,
    Type BIGINT,
    Topics ARRAY<STRUCT<Id: BIGINT>>
"""

METRIC_JSON = """
    Blog STRUCT<Type: BIGINT, Url: STRING>,
    CreateDate STRING,
    Metrics STRUCT<CommentCount: BIGINT, LikeCount: BIGINT, RepostCount: BIGINT,
                   ViewCount: BIGINT, CommentNegativeCount: BIGINT,
                   CommentPositiveCount: BIGINT, Timestamp: STRING>,
    Type BIGINT,
    Url STRING
"""

# Names, order and types of the flat feed tables.
BLOGS_DELTA = {
    "accountid": "STRING",
    "accounturl": "STRING",
    "avatarurl": "STRING",
    "partdate": "STRING",
    "nickname": "STRING",
    "name": "STRING",
    "birthdate": "STRING",
    "educationlevel": "BIGINT",
    "socialnetworktype": "BIGINT",
    "blogtype": "BIGINT",
    "kafkapartition": "INT",
    "kafkaoffset": "BIGINT",
    "commentsaverage": "DOUBLE",
    "repostsaverage": "DOUBLE",
    "viewsaverage": "DOUBLE",
    "likesaverage": "DOUBLE",
    "postsaverage": "DOUBLE",
    "commentscount": "BIGINT",
    "repostscount": "BIGINT",
    "viewscount": "BIGINT",
    "likescount": "BIGINT",
    "postscount": "BIGINT",
    "execdate": "STRING",
    "currenttimestamp": "TIMESTAMP",
}

POSTS_DELTA = {
    "authorurl": "STRING",
    "accounttype": "BIGINT",
    "accountfollowers": "BIGINT",
    "bloganslanguage": "BIGINT",
    "blogfollowers": "BIGINT",
    "blogid": "STRING",
    "blogtype": "BIGINT",
    "commentscount": "BIGINT",
    "id": "STRING",
    "isspam": "BOOLEAN",
    "likescount": "BIGINT",
    "metrictimestamp": "STRING",
    "parentid": "STRING",
    "partdate": "TIMESTAMP",
    "posttype": "BIGINT",
    "posturl": "STRING",
    "repostscount": "BIGINT",
    "socialnetworktype": "BIGINT",
    "topics": "ARRAY<BIGINT>",
    "viewscount": "BIGINT",
    "currenttimestamp": "TIMESTAMP",
    "kafkapartition": "INT",
    "kafkaoffset": "BIGINT",
    "execdate": "STRING",
}

METRICS_DELTA = {
    "blogtype": "BIGINT",
    "blogurl": "STRING",
    "partdate": "STRING",
    "comments": "BIGINT",
    "likes": "BIGINT",
    "reposts": "BIGINT",
    "views": "BIGINT",
    "commentnegativecount": "BIGINT",
    "commentpositivecount": "BIGINT",
    "metricstimestamp": "STRING",
    "metricstype": "BIGINT",
    "metricsurl": "STRING",
    "currenttimestamp": "TIMESTAMP",
    "kafkapartition": "INT",
    "kafkaoffset": "BIGINT",
    "id": "STRING",
    "execdate": "STRING",
}

OFFSET_LOG = {
    "kafkapartition": "INT",
    "latestoffset": "BIGINT",
    "topic": "STRING",
    "consumergroup": "STRING",
    "execdate": "STRING",
    "exectime": "STRING",
}

# Which metric count overrides which post count.
COUNT_OVERRIDES = {
    "commentscount": "comments",
    "likescount": "likes",
    "repostscount": "reposts",
    "viewscount": "views",
}

RIGHT_SUFFIX = "_metrics"
POST_KEY = "post_id"
POST_DATE = "partdate_pmd"


def merged_schema() -> dict[str, str]:
    """The merged post table: post columns, the metric columns that are not
    folded into a count, then the resolved date and key."""
    merged = {c: t for c, t in POSTS_DELTA.items() if c not in ("id", "partdate")}
    for column, kind in METRICS_DELTA.items():
        if column in ("id", "partdate") or column in COUNT_OVERRIDES.values():
            continue
        merged[column + RIGHT_SUFFIX if column in POSTS_DELTA else column] = kind
    return {**merged, POST_DATE: "DATE", POST_KEY: "STRING"}


MERGED_POSTS = merged_schema()


def ddl(fields: dict[str, str]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in fields.items())
