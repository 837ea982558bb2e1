from feedmerge.plans.feeds import BLOGS, METRICS, POSTS, Feed
from feedmerge.plans.ingest import count_rows, ingest
from feedmerge.plans.merge_blogs import merge_blogs
from feedmerge.plans.merge_posts import merge_posts, merge_posts_metrics

__all__ = [
    "BLOGS",
    "METRICS",
    "POSTS",
    "Feed",
    "count_rows",
    "ingest",
    "merge_blogs",
    "merge_posts",
    "merge_posts_metrics",
]
