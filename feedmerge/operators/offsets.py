"""The offset log: what was read, and where the next read starts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Special offsets of the log's starting-offsets JSON.
LATEST = -1
EARLIEST = -2


def offsets_of(
    delta: DataFrame, topic: str, group: str, exec_date: Column | str, exec_time: Column | str
) -> DataFrame:
    """Highest offset of each log partition, stamped with the run that read it."""
    return delta.groupBy("kafkapartition").agg(
        F.max("kafkaoffset").alias("latestoffset"),
        F.lit(topic).alias("topic"),
        F.lit(group).alias("consumergroup"),
        F.lit(exec_date).alias("execdate"),
        F.lit(exec_time).alias("exectime"),
    )


def of_reader(log: DataFrame, topic: str | None, group: str | None) -> DataFrame:
    """The log's rows of one topic and group; both filters reach its files."""
    if topic is not None:
        log = log.where(F.col("topic") == topic)
    return log if group is None else log.where(F.col("consumergroup") == group)


def compact_offsets(log: DataFrame) -> DataFrame:
    """The log cut to the newest run of each reader and its highest offset per partition.

    All runs resume from it as from the whole log, so a log that has grown can be
    replaced by this.
    """
    reader = ["topic", "consumergroup", "kafkapartition"]
    highest = F.struct("latestoffset", "execdate", "exectime")
    found = log.groupBy(*reader).agg(F.max(highest).alias("top"))
    return found.select(
        "kafkapartition", "top.latestoffset", "topic", "consumergroup", "top.execdate", "top.exectime"
    )


def latest_run(log: DataFrame, topic: str | None = None, group: str | None = None) -> DataFrame:
    """Rows of the newest run in the log, with the offset to read next."""
    log = of_reader(log, topic, group)
    run = F.struct("execdate", "exectime")
    # One row by construction: a global aggregate.
    newest = F.broadcast(log.agg(F.max(run).alias("run")).select("run.*"))
    return log.join(newest, ["execdate", "exectime"]).select(
        "kafkapartition",
        (F.col("latestoffset") + 1).alias("startingoffset"),
        "execdate",
        "exectime",
    )


def resume_offsets(
    log: DataFrame,
    partitions: DataFrame,
    scope: str = "all_runs",
    missing: int = EARLIEST,
    topic: str | None = None,
    group: str | None = None,
) -> DataFrame:
    """Starting offset of every topic partition.

    ``all_runs`` continues each partition after its own highest offset and reads
    unseen partitions from the start, so nothing is skipped. ``latest_run`` with
    ``missing=LATEST`` trusts the newest run alone, and skips partitions that
    were silent in it. A log of several topics or groups needs ``topic`` and
    ``group``; without them its offsets would mix, so the query fails.
    """
    log = of_reader(log, topic, group)
    if scope == "all_runs":
        reader = F.struct("topic", "consumergroup")
        seen = log.groupBy("kafkapartition").agg(
            F.when(
                F.min(reader) != F.max(reader),
                F.raise_error(F.lit("the offset log has several topics or groups: name one")),
            )
            .otherwise(F.max("latestoffset") + 1)
            .cast("bigint")
            .alias("startingoffset")
        )
    elif scope == "latest_run":
        seen = latest_run(log).select("kafkapartition", "startingoffset")
    else:
        raise ValueError(f"unknown scope {scope!r}")
    return partitions.join(seen, "kafkapartition", "left").select(
        "kafkapartition",
        F.coalesce("startingoffset", F.lit(missing).cast("bigint")).alias("startingoffset"),
    )


def starting_offsets_json(offsets: DataFrame, topic: str) -> DataFrame:
    """One row holding the JSON that a bounded log read takes as its start.

    The group it collects has one small entry per topic partition.
    """
    entries = F.array_sort(F.collect_list(F.struct("kafkapartition", "startingoffset")))
    by_partition = F.map_from_entries(
        F.transform(
            entries,
            lambda e: F.struct(e["kafkapartition"].cast("string"), e["startingoffset"]),
        )
    )
    return offsets.agg(
        F.to_json(F.create_map(F.lit(topic), by_partition)).alias("startingoffsets")
    )
