"""Bounded ingest: read, flatten, write the run, then log how far it got."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmerge.operators.decode import decode_json
from feedmerge.operators.offsets import offsets_of
from feedmerge.plans.feeds import Feed
from feedmerge.sinks.files import append_offsets, run_path, write_run


BROKEN = "brokentext"


class Ingested(NamedTuple):
    path: str
    rows: int
    keyless: int
    broken: int


def ingest(
    feed: Feed,
    messages: DataFrame,
    base: str,
    offsets_path: str,
    topic: str,
    group: str,
    exec_date: str,
    run_at: dt.datetime,
    now: Column | None = None,
) -> Ingested:
    """Write one run of a feed; return its folder and what it holds.

    Offsets come from the rows that were written, after they were, so a crash in
    between repeats messages and never loses any; the merges drop repeats. The text of
    messages that are no JSON is kept below ``base/_broken``, before the offsets are
    logged.
    """
    spark = messages.sparkSession
    path = run_path(base, exec_date, run_at)
    write_run(feed.rows(messages, exec_date, now), path, feed.day_of)
    rows, keyless = count_rows(spark, feed, path)
    broken = keep_broken(feed, messages, path, base, exec_date) if keyless else 0
    written = spark.read.schema("kafkapartition INT, kafkaoffset BIGINT").parquet(path)
    run_time = run_at.astimezone(dt.timezone.utc) if run_at.tzinfo else run_at
    stamp = f"{run_time:%Y-%m-%dT%H:%M:%S.%f}"
    append_offsets(offsets_of(written, topic, group, exec_date, stamp), offsets_path)
    return Ingested(path, rows, keyless, broken)


def broken_path(base: str, run: str) -> str:
    """Where the broken text of a run is kept; readers of days pass over it."""
    day, name = run.rstrip("/").rsplit("/", 2)[-2:]
    return f"{base.rstrip('/')}/_broken/{day}/{name}"


def keep_broken(feed: Feed, messages: DataFrame, run: str, base: str, exec_date: str) -> int:
    """Write the text of a run's broken messages aside and count them.

    Reads the messages again, and of them only those up to the offsets that the run holds: a log read
    that is open at its end is longer the second time, and what came since belongs to the next run.
    """
    spark = messages.sparkSession
    held = spark.read.schema("kafkapartition INT, kafkaoffset BIGINT").parquet(run)
    path = broken_path(base, run)
    broken_texts(feed, messages, held, exec_date).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).count()


def broken_texts(feed: Feed, messages: DataFrame, held: DataFrame, exec_date: str) -> DataFrame:
    """Text of the messages up to the offsets in ``held`` that are no JSON.

    The text is looked at only where the offset fits. As a plain filter, Spark would parse each
    message before the joins of a replay, also those that earlier runs have read.
    """
    # one row for each log partition
    ends = held.groupBy(F.col("kafkapartition").alias("partition")).agg(F.max("kafkaoffset").alias("_end"))
    near = messages.join(F.broadcast(ends), "partition")
    fits = near.withColumn("value", F.when(F.col("offset") <= F.col("_end"), F.col("value")))
    text = decode_json(fits, feed.json_schema, BROKEN).where(F.col(BROKEN).isNotNull())
    return text.select("kafkapartition", "kafkaoffset", BROKEN, F.lit(exec_date).alias("execdate"))


def count_rows(spark: SparkSession, feed: Feed, path: str) -> tuple[int, int]:
    """Rows of a written run, and those without a key: broken text or no URL."""
    keys = spark.read.schema(f"{feed.key} STRING").parquet(path)
    return tuple(keys.select(F.count("*"), F.count_if(F.col(feed.key).isNull())).first())
