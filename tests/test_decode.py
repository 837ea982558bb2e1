import datetime as dt
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from feedmerge.operators import decode_json, infer_json_schema
from feedmerge.plans import BLOGS, METRICS, POSTS
from feedmerge.schemas import BLOGS_DELTA, METRICS_DELTA, POST_JSON, POSTS_DELTA
from feedmerge.sources.log import ENVELOPE
from helpers import frame

NOW = dt.datetime(2024, 1, 20, 6)


def messages(spark, *values):
    texts = [v if isinstance(v, str) or v is None else json.dumps(v) for v in values]
    return frame(
        spark,
        ENVELOPE,
        [
            {"value": None if t is None else bytearray(t, "utf8"), "partition": 3, "offset": i}
            for i, t in enumerate(texts)
        ],
    )


def flat(spark, feed, *values):
    return feed.rows(messages(spark, *values), "2024-01-20", F.lit(NOW)).collect()


@pytest.mark.parametrize(
    "feed, fields", [(BLOGS, BLOGS_DELTA), (POSTS, POSTS_DELTA), (METRICS, METRICS_DELTA)]
)
def test_flat_schema_is_the_declared_one(spark, feed, fields):
    df = feed.rows(messages(spark), "2024-01-20", F.lit(NOW))
    assert dict(df.dtypes) == {c: t.lower() for c, t in fields.items()}
    assert df.columns == list(fields)
    assert df.count() == 0


def test_post_fields(spark):
    post = {
        "Author": {"Url": "au", "Type": 1, "ProviderType": 7},
        "Metrics": {"FollowerCount": 5, "CommentCount": 6, "Timestamp": "2024-01-02T00:00:00"},
        "Blog": {"UrlHash": "bh", "Type": 2, "Metrics": {"FollowerCount": 9}},
        "Url": "https://p.example/1",
        "Parent": {"UrlHash": "ph"},
        "CreateDate": "2024-01-01T23:30:00+03:00",
        "Topics": [{"Id": 1}, {"Id": None}, None],
    }
    row = flat(spark, POSTS, post)[0]
    assert (row.authorurl, row.socialnetworktype, row.blogfollowers) == ("au", 7, 9)
    assert (row.accountfollowers, row.commentscount, row.viewscount) == (5, 6, None)
    assert row.id == hashlib.md5(b"https://p.example/1").hexdigest()
    assert row.partdate == dt.datetime(2024, 1, 1, 20, 30)
    assert row.topics == [1, None, None]
    assert (row.kafkapartition, row.kafkaoffset, row.currenttimestamp) == (3, 0, NOW)


def test_missing_structs_and_fields_are_null(spark):
    row = flat(spark, POSTS, {"Url": "u"})[0]
    assert row.posturl == "u" and row.id is not None
    assert (row.authorurl, row.blogfollowers, row.topics, row.partdate) == (None,) * 4
    metric = flat(spark, METRICS, {"Url": "u", "Metrics": {"LikeCount": 4}})[0]
    assert (metric.likes, metric.comments, metric.blogurl) == (4, None, None)


def test_broken_messages_become_null_rows(spark):
    broken, empty, good = flat(spark, POSTS, "{not json", None, {"Url": "u"})
    assert broken.posturl is None and broken.id is None
    assert empty.posturl is None and good.posturl == "u"
    assert broken.kafkaoffset == 0


def test_null_url_gives_null_key(spark):
    assert flat(spark, METRICS, {"Type": 1})[0].id is None


def test_bad_date_is_null(spark):
    assert flat(spark, POSTS, {"Url": "u", "CreateDate": "soon"})[0].partdate is None


def test_corrupt_text_is_kept_on_request(spark):
    decoded = decode_json(messages(spark, "{not json", {"Url": "u"}), POST_JSON, "_corrupt_record")
    assert [r._corrupt_record for r in decoded.collect()] == ["{not json", None]


def test_nick_fills_both_names(spark):
    row = flat(spark, BLOGS, {"UrlHash": "h", "Nick": "n", "MetricsAvg1w": {"LikeCount": 1.5}})[0]
    assert (row.accountid, row.nickname, row.name, row.likesaverage) == ("h", "n", "n", 1.5)


def test_inferred_schema_covers_all_messages(spark):
    found = infer_json_schema(
        messages(spark, {"a": 1, "b": {"c": 1.5}}, {"b": {"d": None}, "e": [{"f": True}]}, "oops")
    )
    decoded = decode_json(messages(spark, {"b": {"c": 2}, "e": [{"f": False}]}), found)
    assert dict(decoded.dtypes)["b"] == "struct<c:double,d:string>"
    assert decoded.selectExpr("b.c", "e[0].f").first() == (2.0, False)


def test_inferring_from_nothing_is_refused(spark):
    with pytest.raises(ValueError):
        infer_json_schema(messages(spark))
