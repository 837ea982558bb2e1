from feedmerge.operators.coverage import islands, offset_gaps
from feedmerge.operators.decode import (
    decode_json,
    flatten_blogs,
    flatten_metrics,
    flatten_posts,
    infer_json_schema,
    topic_ids,
)
from feedmerge.operators.join import (
    distinct_days,
    filter_date_range,
    filter_days,
    join_posts_metrics,
    latest_posts_with_metrics,
    merge_latest_posts_metrics,
    suffix_collisions,
)
from feedmerge.operators.latest import latest_per_key
from feedmerge.operators.offsets import (
    compact_offsets,
    latest_run,
    of_reader,
    offsets_of,
    resume_offsets,
    starting_offsets_json,
)
from feedmerge.operators.overlay import merge_history, overlay_history, overlay_once
from feedmerge.operators.retention import expired, kept
from feedmerge.operators.snapshot import latest_accounts, merge_accounts, union_by_name
from feedmerge.operators.widen import widen, widest

__all__ = [
    "islands",
    "offset_gaps",
    "compact_offsets",
    "decode_json",
    "distinct_days",
    "expired",
    "filter_date_range",
    "filter_days",
    "flatten_blogs",
    "flatten_metrics",
    "flatten_posts",
    "infer_json_schema",
    "join_posts_metrics",
    "kept",
    "latest_accounts",
    "latest_per_key",
    "latest_posts_with_metrics",
    "latest_run",
    "merge_accounts",
    "merge_history",
    "merge_latest_posts_metrics",
    "of_reader",
    "offsets_of",
    "overlay_history",
    "overlay_once",
    "resume_offsets",
    "starting_offsets_json",
    "suffix_collisions",
    "topic_ids",
    "union_by_name",
    "widen",
    "widest",
]
