"""Time the headline queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the tables and the cores. Each query runs
once to warm up, then the median of three full runs counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from checks.compare import session
from checks.registry import QUERIES

HEADLINES = [
    "merge_posts_metrics",
    "merge_posts_history",
    "merge_delta_posts_metrics",
    "latest_posts_metrics_fused",
    "merge_blogs",
    "latest_per_key",
    "decode_json",
    "flatten_posts",
    "flatten_metrics",
    "flatten_blogs",
    "offsets_commit",
    "offsets_resume",
    "replace_partitions",
    "stream_ingest_posts",
    "stream_upsert_blogs",
    "retention_keep",
    "url_key",
]
RUNS = 3


def timed(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = session(cpus)
    seconds = {}
    for name in sys.argv[1:] or HEADLINES:
        timed(spark, name, sf_dir)
        seconds[name] = round(statistics.median(timed(spark, name, sf_dir) for _ in range(RUNS)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": cpus,
                "spark": spark.version,
                "runs": RUNS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
