"""Session settings the merges rely on, and the shared scratch folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The history overlay keeps one hash partitioning from its join through its
    # dedupe. This lets AQE give that up, and shuffle once more, only when a
    # key turns out to be hot.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="feedmerge-")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one named in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def broadcast_within(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast if ``df`` has at most ``max_rows`` rows, which are kept.

    The rows that were read for the check are the ones that are broadcast, so what
    ``df`` is made of runs once. Anything larger is returned as it is, and the join
    shuffles instead.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
