"""What tells the three feeds apart."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from feedmerge.operators.decode import decode_json, flatten_blogs, flatten_metrics, flatten_posts
from feedmerge.schemas import (
    BLOG_JSON,
    BLOGS_DELTA,
    METRIC_JSON,
    METRICS_DELTA,
    POST_JSON,
    POSTS_DELTA,
)


@dataclass(frozen=True)
class Feed:
    json_schema: str
    fields: dict[str, str]
    flatten: Callable[..., DataFrame]
    key: str
    day_of: str | None = None

    def rows(
        self,
        messages: DataFrame,
        exec_date: str,
        now: Column | None = None,
        json_schema: str | None = None,
    ) -> DataFrame:
        """Messages to flat rows, for batches and streams alike."""
        decoded = decode_json(messages, json_schema or self.json_schema)
        return self.flatten(decoded, exec_date, now)


BLOGS = Feed(BLOG_JSON, BLOGS_DELTA, flatten_blogs, "accountid")
POSTS = Feed(POST_JSON, POSTS_DELTA, flatten_posts, "id", day_of="partdate")
METRICS = Feed(METRIC_JSON, METRICS_DELTA, flatten_metrics, "id", day_of="partdate")
