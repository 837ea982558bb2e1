"""Account snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmerge.operators.latest import LOG_POSITION, latest_per_key

ACCOUNT_KEY = "accountid"


def latest_accounts(blogs: DataFrame) -> DataFrame:
    """Newest row per account; of a row delivered twice, the one merged last."""
    tiebreak = [c for c in (*LOG_POSITION, "mergedate") if c in blogs.columns]
    return latest_per_key(blogs, [ACCOUNT_KEY], ["currenttimestamp"], tiebreak)


def union_by_name(history: DataFrame, delta: DataFrame) -> DataFrame:
    """All rows of both; a column only one side has is null on the other."""
    return history.unionByName(delta, allowMissingColumns=True)


def merge_accounts(
    delta: DataFrame, snapshot: DataFrame | None, merge_date: str, buckets: int | None = None
) -> DataFrame:
    """Newest row per account over the day's delta and the previous snapshot.

    One dedupe over the union is enough: the newest row of the union is the
    newest of the snapshot and the newest of the delta. Of a snapshot already
    spread by account, give the number of ``buckets``: the delta is then brought
    to the same spread, which the union keeps, and the snapshot is not shuffled.
    For this, pass the table's scan with all its columns; a projection on top of
    it would hide the spread from the union.
    """
    fresh = delta.withColumn("mergedate", F.lit(merge_date))
    if snapshot is None:
        return latest_accounts(fresh)
    if buckets is not None:
        fresh = latest_accounts(fresh).repartition(buckets, ACCOUNT_KEY)
    return latest_accounts(union_by_name(snapshot, fresh))
