"""Message logs: Kafka, or any table with the same envelope columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmerge.operators.offsets import (
    EARLIEST,
    LATEST,
    of_reader,
    resume_offsets,
    starting_offsets_json,
)
from feedmerge.session import broadcast_within
from feedmerge.sources.files import read_if_exists

# The columns of a message log.
ENVELOPE = {
    "key": "BINARY",
    "value": "BINARY",
    "topic": "STRING",
    "partition": "INT",
    "offset": "BIGINT",
    "timestamp": "TIMESTAMP",
    "timestampType": "INT",
}
MAX_PARTITIONS = 100_000


def kafka_options(
    servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    group: str | None = None,
    bounded: bool = True,
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "false",
    }
    if bounded:
        options["endingOffsets"] = "latest"
    if group:
        options["kafka.group.id"] = group
    return options


def read_kafka(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    group: str | None = None,
) -> DataFrame:
    """Everything from the starting offsets to the newest message of now."""
    options = kafka_options(servers, topic, starting_offsets, group)
    return spark.read.format("kafka").options(**options).load()


def stream_kafka(
    spark: SparkSession, servers: str, topic: str, starting_offsets: str = "earliest"
) -> DataFrame:
    options = kafka_options(servers, topic, starting_offsets, bounded=False)
    return spark.readStream.format("kafka").options(**options).load()


def read_kafka_resumed(
    spark: SparkSession,
    servers: str,
    topic: str,
    group: str,
    offsets_path: str,
    partitions: DataFrame,
    **resume,
) -> DataFrame:
    """Continue after the offset log at ``offsets_path``, or start at the earliest."""
    log = read_if_exists(spark, offsets_path)
    if log is None or of_reader(log, topic, group).isEmpty():
        return read_kafka(spark, servers, topic, group=group)
    starts = resume_offsets(log, partitions, topic=topic, group=group, **resume)
    start = starting_offsets_json(starts, topic)
    return read_kafka(spark, servers, topic, start.first()[0], group)


def replay(messages: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """A stored log from the given offsets on; partitions without one are read whole.

    ``starts`` holds one row per log partition, which is checked before it is
    broadcast, so the log itself is filtered in place and never shuffled.
    """
    if starts is None:
        return messages
    small = broadcast_within(starts.select("kafkapartition", "startingoffset"), MAX_PARTITIONS)
    start = F.coalesce("startingoffset", F.lit(EARLIEST))
    return (
        messages.join(small, F.col("partition") == F.col("kafkapartition"), "left")
        .where((start != LATEST) & (F.col("offset") >= start))
        .select(*messages.columns)
    )


def replay_resumed(
    messages: DataFrame,
    offsets_path: str,
    topic: str | None = None,
    group: str | None = None,
    **resume,
) -> DataFrame:
    """Continue a stored log after its offset log, or read it all on the first run.

    An offset log of several topics or groups needs both names.
    """
    log = read_if_exists(messages.sparkSession, offsets_path)
    if log is None or of_reader(log, topic, group).isEmpty():
        return messages
    partitions = of_reader(log, topic, group).select("kafkapartition").distinct()
    return replay(messages, resume_offsets(log, partitions, topic=topic, group=group, **resume))
