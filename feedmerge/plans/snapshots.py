"""Account snapshots that share files between days.

The accounts lie in a published table, spread over buckets by a digest of their key; every day
has a manifest of its own. A day writes its changed accounts as a layer of the buckets they fall
in, and names the files of all others again. A bucket that has too many layers is rewritten to
one, so a day writes in proportion to its changes, and a day's snapshot stays readable until
``vacuum``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmerge.functions.dates import DateLike, parse_day
from feedmerge.functions.keys import key_bucket
from feedmerge.operators.snapshot import ACCOUNT_KEY, latest_accounts, merge_accounts
from feedmerge.schemas import BLOGS_DELTA, ddl
from feedmerge.sinks.published import Manifest, manifest_numbers, put_manifest, read_manifest, read_versions, write_version
from feedmerge.sources.files import read_days_after

BUCKETS, BUCKET = "buckets", "bucket"
SPREAD = [BUCKETS, BUCKET]
STORED = ddl({**BLOGS_DELTA, "mergedate": "STRING"})
# Manifest numbers are yyyyMMdd followed by the attempt, so they sort by day.
ATTEMPTS = 10_000


def _day_of(number: int):
    return parse_day(str(number // ATTEMPTS))


def snapshot_days(spark: SparkSession, path: str) -> list:
    """Days that have a snapshot, oldest first."""
    return sorted({_day_of(n) for n in manifest_numbers(spark, path)})


def _newest(spark: SparkSession, path: str, up_to: int) -> int | None:
    return max((n for n in manifest_numbers(spark, path) if n < up_to), default=None)


def _bucket_count(manifest: Manifest) -> int | None:
    """How many buckets the accounts are spread over; it is the name of the upper folder."""
    return next((int(p.split("/")[0].partition("=")[2]) for p in manifest), None)


def _accounts(spark: SparkSession, path: str, manifest: Manifest) -> DataFrame | None:
    """Newest row per account; only buckets with several layers are shuffled."""
    flat = read_versions(spark, path, {p: v for p, v in manifest.items() if len(v) == 1}, schema=STORED)
    layered = read_versions(spark, path, {p: v for p, v in manifest.items() if len(v) > 1}, schema=STORED)
    parts = [p for p in (flat, None if layered is None else latest_accounts(layered)) if p is not None]
    if not parts:
        return None
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _spread(accounts: DataFrame, buckets: int) -> DataFrame:
    return accounts.withColumns({BUCKETS: F.lit(buckets), BUCKET: key_bucket(ACCOUNT_KEY, buckets)})


def merge_blogs_incremental(
    spark: SparkSession,
    blogs_path: str,
    path: str,
    exec_date: DateLike,
    buckets: int | None = None,
    layers: int = 4,
) -> list[str]:
    """Merge all deltas since the newest snapshot before the day into the day's; returns the buckets rewritten whole.

    Without ``buckets`` their number stays, 256 at first; another number spreads all accounts anew.
    Choose it so that a bucket is a file of a few hundred MB. With ``layers=1`` every changed
    bucket is rewritten. A day without rows gets the snapshot before it. The day's state is one
    manifest, put in place last: a merge that dies is done again, and one that repeats a day
    starts from the same snapshot before it.
    """
    if layers < 1:
        raise ValueError("a bucket has at least one layer")
    day = parse_day(exec_date)
    first = int(f"{day:%Y%m%d}") * ATTEMPTS
    before = _newest(spark, path, first)
    held = {} if before is None else read_manifest(spark, path, before)
    delta = read_days_after(spark, blogs_path, None if before is None else _day_of(before), day, ddl(BLOGS_DELTA))
    stored = _bucket_count(held)
    count = buckets or stored or 256
    if stored not in (None, count):
        everything = _spread(merge_accounts(delta, _accounts(spark, path, held).drop(*SPREAD), f"{day:%Y%m%d}"), count)
        version, changed = write_version(everything, path, SPREAD)
        manifest = {p: [version] for p in changed}
        rewritten = changed
    else:
        fresh = _spread(merge_accounts(delta, None, f"{day:%Y%m%d}"), count)
        version, changed = write_version(fresh, path, SPREAD)
        manifest = {**held, **{p: [*held.get(p, []), version] for p in changed}}
        full = {p: v for p, v in manifest.items() if len(v) > layers}
        rewritten = []
        if full:
            whole, rewritten = write_version(latest_accounts(read_versions(spark, path, full, schema=STORED)), path, SPREAD)
            manifest.update({p: [whole] for p in rewritten})
    attempts = [n for n in manifest_numbers(spark, path) if first <= n < first + ATTEMPTS]
    put_manifest(spark, path, max(attempts, default=first - 1) + 1, manifest)
    return rewritten


def read_accounts_of_day(spark: SparkSession, path: str, exec_date: DateLike | None = None) -> DataFrame:
    """The snapshot of a day, or the newest; a day without one is an error."""
    numbers = manifest_numbers(spark, path)
    if exec_date is not None:
        numbers = [n for n in numbers if _day_of(n) == parse_day(exec_date)]
    if not numbers:
        raise ValueError(f"there is no snapshot {'' if exec_date is None else f'of {exec_date} '}at {path}")
    accounts = _accounts(spark, path, read_manifest(spark, path, numbers[-1]))
    if accounts is None:
        raise ValueError(f"the snapshot at {path} has no accounts")
    return accounts.drop(*SPREAD)
