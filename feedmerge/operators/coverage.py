"""What a feed's offsets cover: lost and repeated ranges of each log partition."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PARTITION, OFFSET = "kafkapartition", "kafkaoffset"
#: Offsets of one block are ranked by one task; ranges of blocks are joined after.
BLOCK = 1 << 20


def islands(offsets: DataFrame, block: int = BLOCK) -> DataFrame:
    """kafkapartition, first, last: the maximal ranges of the given distinct offsets.

    A partition's offsets are cut into blocks first, so that no task holds a partition; only
    the ranges of its blocks meet, which are few where offsets are dense.
    """
    placed = offsets.select(PARTITION, OFFSET, F.floor(F.col(OFFSET) / block).alias("_block"))
    inside = Window.partitionBy(PARTITION, "_block").orderBy(OFFSET)
    ranges = (
        placed.withColumn("_island", F.col(OFFSET) - F.row_number().over(inside))
        .groupBy(PARTITION, "_block", "_island")
        .agg(F.min(OFFSET).alias("first"), F.max(OFFSET).alias("last"))
    )
    across = Window.partitionBy(PARTITION).orderBy("first")
    starts = (F.col("first") > F.lag("last").over(across) + 1).cast("int")
    joined = ranges.withColumn("_new", F.coalesce(starts, F.lit(1))).withColumn("_range", F.sum("_new").over(across))
    return joined.groupBy(PARTITION, "_range").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("_range")


def offset_gaps(rows: DataFrame, committed: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """kind, kafkapartition, first, last, offsets: ranges that are lost, or that came more than once.

    Lost are offsets between the first one that was read and the newest, of the rows or of ``committed``
    (``kafkapartition``, ``latestoffset``), that no row has; a committed partition without any row is lost
    up to its commit from offset 0. Rows without a partition or an offset are not looked at.
    """
    known = rows.where(F.col(PARTITION).isNotNull() & F.col(OFFSET).isNotNull())
    times = known.groupBy(PARTITION, OFFSET).agg(F.count(F.lit(1)).alias("_times"))
    read = islands(times, block)
    bounds = read.select(PARTITION, "first", "last")
    if committed is not None:
        ends = committed.where(F.col("latestoffset").isNotNull()).groupBy(PARTITION).agg(F.max("latestoffset").alias("_end"))
        # a mark just after the commit ends the last gap; one before offset 0 begins that of an unread partition
        marks = ends.join(read.groupBy(PARTITION).agg(F.max("last").alias("_last")), PARTITION, "left")
        after = marks.where(F.col("_last").isNull() | (F.col("_last") < F.col("_end")))
        bounds = bounds.unionByName(after.select(PARTITION, (F.col("_end") + 1).alias("first"), F.col("_end").alias("last")))
        unread = marks.where(F.col("_last").isNull())
        bounds = bounds.unionByName(unread.select(PARTITION, F.lit(-1).cast("long").alias("first"), F.lit(-1).cast("long").alias("last")))
    by = Window.partitionBy(PARTITION).orderBy("first")
    before = bounds.withColumn("_before", F.lag("last").over(by))
    lost = before.where(F.col("_before") + 1 < F.col("first")).select(
        F.lit("lost").alias("kind"), PARTITION, (F.col("_before") + 1).alias("first"), (F.col("first") - 1).alias("last")
    )
    repeated = islands(times.where("_times > 1"), block).select(F.lit("repeated").alias("kind"), PARTITION, "first", "last")
    return lost.unionByName(repeated).withColumn("offsets", F.col("last") - F.col("first") + 1)
