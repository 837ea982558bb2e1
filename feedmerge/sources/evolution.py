"""A feed's schema through time, and reads of runs that were written with different ones.

Schemas lie below ``base/_schemas``, one numbered file a version, each as wide as the one before.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from feedmerge.functions.dates import DateLike
from feedmerge.operators.widen import widen, widest
from feedmerge.sinks.published import current, manifest_numbers, put_manifest, read_manifest
from feedmerge.sources.files import child_names, day_path, finished_runs


def _place(base: str) -> str:
    return f"{base.rstrip('/')}/_schemas"


def stored_schema(spark: SparkSession, base: str, version: int | None = None) -> tuple[int, StructType]:
    """The newest schema of a feed, or that of a version, with its number; 0 and no columns before the first."""
    if version is None:
        version, stored = current(spark, _place(base))
    else:
        stored = read_manifest(spark, _place(base), version)
    return version, StructType.fromJson(stored) if stored else StructType()


def schema_versions(spark: SparkSession, base: str) -> list[int]:
    return manifest_numbers(spark, _place(base))


def register_schema(spark: SparkSession, base: str, schema: StructType) -> int:
    """Widen the feed's schema by that of a run; returns the version that holds it.

    A run that adds nothing leaves the version as it is. Of two writers that add something at
    once, the slower one is refused and may try again.
    """
    version, stored = stored_schema(spark, base)
    wider = widest(stored, schema)
    if wider == stored:
        return version
    put_manifest(spark, _place(base), version + 1, json.loads(wider.json()))
    return version + 1


def read_evolved(
    spark: SparkSession, base: str, days: Sequence[DateLike], version: int | None = None
) -> DataFrame:
    """All finished runs of the days as one frame, in the feed's schema.

    Runs are scanned together with those of the same schema, which parquet footers tell, one a
    run. Runs written without ``register_schema`` widen the result; with ``version`` they have
    to fit it. Days without a folder have no rows. Every scan keeps its own pruning and pushdown, as
    columns that have the wide type already are passed on as they are.
    """
    target = stored_schema(spark, base, version)[1]
    # folders below a run, such as those of days, are no columns of the feed
    flat = spark.read.option("recursiveFileLookup", True)
    scans: dict[str, list[str]] = {}
    for day in days:
        path = day_path(base, day)
        names = finished_runs(spark, base, day)
        if not names and any(n[0] not in "._" for n in child_names(spark, path)):
            raise ValueError(f"no finished run below {path}")
        for name in names:
            run = f"{path}/{name}"
            scans.setdefault(flat.parquet(run).schema.json(), []).append(run)
    schemas = [StructType.fromJson(json.loads(s)) for s in scans]
    if version is None:
        target = functools.reduce(widest, schemas, target)
    if not target.fields:
        raise ValueError(f"no run and no schema below {base}")
    frames = [widen(flat.schema(s).parquet(*runs), target) for s, runs in zip(schemas, scans.values())]
    return functools.reduce(DataFrame.union, frames or [spark.createDataFrame([], target)])
