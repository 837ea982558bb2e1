from feedmerge.sinks.files import (
    append_offsets,
    replace_partitions,
    run_path,
    write_clustered,
    write_run,
    write_snapshot,
)
from feedmerge.sinks.published import publish_partitions, read_published, vacuum

__all__ = [
    "append_offsets",
    "publish_partitions",
    "read_published",
    "replace_partitions",
    "vacuum",
    "run_path",
    "write_clustered",
    "write_run",
    "write_snapshot",
]
