"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LOG_POSITION = ("kafkaoffset", "kafkapartition")


def newest_first(columns: Sequence[Column | str]) -> list[Column]:
    return [F.desc_nulls_last(c) if isinstance(c, str) else c for c in columns]


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    tiebreak: Sequence[Column | str] = LOG_POSITION,
) -> DataFrame:
    """Keep the newest row of every key; null keys form one group of their own.

    Catalyst turns ``row_number() = 1`` into a per-task limit below the shuffle,
    so a task sends at most one row per key and a hot key stays small. The
    tiebreak makes the choice among equal rows repeatable.
    """
    newest = Window.partitionBy(*keys).orderBy(*newest_first([*order, *tiebreak]))
    ranked = df.withColumn("__rank", F.row_number().over(newest))
    return ranked.where(F.col("__rank") == 1).drop("__rank")
