import random

from checks.compare import rows_of
from feedmerge.schemas import MERGED_POSTS, METRICS_DELTA, POSTS_DELTA, ddl


def rows(df):
    """Column names and rows, both in a repeatable order."""
    return rows_of(df.columns, df.collect())


def frame(spark, fields, records):
    """Rows given as dicts; columns left out are null."""
    return spark.createDataFrame(
        [tuple(r.get(c) for c in fields) for r in records], ddl(fields)
    )


def posts(spark, *records):
    return frame(spark, POSTS_DELTA, records)


def metrics(spark, *records):
    return frame(spark, METRICS_DELTA, records)


def merged(spark, *records):
    return frame(spark, MERGED_POSTS, records)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def random_feeds(seed, n=60, ids=6, days=4):
    """Posts and metrics with many repeats, ties, nulls and unmatched rows."""
    import datetime as dt

    rng = random.Random(seed)

    def maybe(value, p=0.2):
        return None if rng.random() < p else value

    post_rows, metric_rows = [], []
    for i in range(n):
        when = dt.datetime(2024, 1, 4 + rng.randrange(days), rng.randrange(24))
        common = {
            "id": maybe(f"p{rng.randrange(ids)}", 0.1),
            "kafkaoffset": i,
            "kafkapartition": rng.randrange(3),
            "currenttimestamp": when,
        }
        if rng.random() < 0.5:
            post_rows.append(
                {
                    **common,
                    "partdate": when,
                    "metrictimestamp": maybe(f"2024-01-0{rng.randrange(1, 5)}"),
                    "commentscount": maybe(rng.randrange(9)),
                    "likescount": maybe(rng.randrange(9)),
                    "authorurl": maybe(f"a{i}"),
                    "topics": maybe([i]),
                }
            )
        else:
            metric_rows.append(
                {
                    **common,
                    "partdate": when.isoformat(),
                    "metricstimestamp": maybe(f"2024-01-0{rng.randrange(1, 5)}"),
                    "comments": maybe(rng.randrange(9)),
                    "likes": maybe(rng.randrange(9)),
                    "blogurl": maybe(f"b{i}"),
                }
            )
    return post_rows, metric_rows
