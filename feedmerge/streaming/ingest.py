"""Continuous ingest. The checkpoint takes the place of the offset log."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedmerge.plans.feeds import Feed
from feedmerge.plans.ingest import count_rows, keep_broken
from feedmerge.sinks.files import write_run
from feedmerge.sources.files import RUN, day_path
from feedmerge.sources.ledger import record_written


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream that owns a checkpoint; it survives restarts."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def stream_ingest(
    feed: Feed,
    messages: DataFrame,
    path: str,
    checkpoint: str,
    exec_date: str | None = None,
    now: Column | None = None,
    trigger: dict | None = None,
    ledger: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Write a stream of messages as runs that the daily merges read.

    Each micro-batch writes ``path/yyyyMMdd/run=<stream>-<batch>`` and a repeated batch
    overwrites its own folder, so every message is there exactly once. The day is
    that of the messages' own timestamp, which a repeated batch finds again, unless
    ``exec_date`` fixes it; messages without a timestamp go with the batch's newest day. The text of
    messages that are no JSON is kept below ``path/_broken``, as bounded ingest does. With a
    ``ledger``, runs are noted there under the feed's ``name``, and merges by ledger take them even
    if their day has passed. By default the stream reads what is there and stops.
    """
    if ledger is not None and name is None:
        raise ValueError("a ledger needs the feed's name")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = f"{RUN}={stream_id(spark, checkpoint)}-{batch_id:012d}"
        batch.persist()
        try:
            if exec_date is not None:
                days = [exec_date]
            else:
                # one row per day of a micro-batch
                found = batch.select(F.to_date("timestamp").cast("string").alias("d")).distinct().collect()
                days = sorted(r.d for r in found if r.d is not None)
                if found and not days:
                    days = [f"{dt.date.today()}"]
            written = []
            for day in days:
                own = F.coalesce(F.to_date("timestamp"), F.lit(days[-1]).cast("date")) == F.lit(day).cast("date")
                part = batch if exec_date is not None else batch.where(own)
                folder = f"{day_path(path, day)}/{run}"
                write_run(feed.rows(part, day, now), folder, feed.day_of)
                if count_rows(spark, feed, folder)[1]:
                    keep_broken(feed, part, folder, path, day)
                written.append(folder)
            if ledger is not None:
                record_written(spark, ledger, name, written)
        finally:
            batch.unpersist()

    return (
        messages.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
