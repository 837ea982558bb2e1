from feedmerge.streaming.ingest import stream_ingest
from feedmerge.streaming.upsert import (
    read_accounts,
    read_upserted_posts,
    stream_upsert_blogs,
    stream_upsert_posts,
)

__all__ = [
    "read_accounts",
    "read_upserted_posts",
    "stream_ingest",
    "stream_upsert_blogs",
    "stream_upsert_posts",
]
