"""A delta laid over stored history, column by column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmerge.operators.latest import latest_per_key
from feedmerge.schemas import MERGED_POSTS, POST_DATE, POST_KEY

OVERLAY_KEYS = (POST_DATE, POST_KEY)
HISTORY_ORDER = ("metricstimestamp", "currenttimestamp")
HISTORY_TIEBREAK = (
    "kafkaoffset_metrics",
    "kafkapartition_metrics",
    "kafkaoffset",
    "kafkapartition",
)


def conform(df: DataFrame, fields: dict[str, str] = MERGED_POSTS) -> DataFrame:
    """The given columns in the given order; those missing are null."""
    present = df.columns
    if present == list(fields):
        return df
    return df.selectExpr(
        *[f"`{c}`" if c in present else f"cast(null as {t}) as `{c}`" for c, t in fields.items()]
    )


STORED = "__stored_"


def _match(keys: Sequence[str], spread_by: Sequence[str] | None) -> list[Column]:
    """Equal keys of a delta and a history whose columns are prefixed."""
    pairs = [(k, F.col(STORED + k), F.col(k)) for k in keys]
    # A key that does not spread is compared as a range, which keeps it out of
    # the keys that the join is planned on.
    return [
        h == d if spread_by is None or k in spread_by else (h >= d) & (h <= d) for k, h, d in pairs
    ]


def overlay_history(
    delta: DataFrame,
    history: DataFrame,
    keys: Sequence[str] = OVERLAY_KEYS,
    fields: dict[str, str] = MERGED_POSTS,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Non-null delta values win, otherwise history stays; a null key matches nothing.

    A full outer merge written as history left join delta, plus the delta rows
    history lacks. Both parts keep the hash partitioning of the keys, so a dedupe
    on more columns needs no further shuffle, and AQE can split a hot history
    key. ``delta`` should have one row per key.

    If both sides are spread by some of the keys already, name these in
    ``spread_by``: the join uses that spread and shuffles neither side.
    """
    # Renamed columns and not a table alias: qualified attributes would hide from
    # the union that both parts are spread alike.
    new = conform(delta, fields)
    old = conform(history, fields).selectExpr(*[f"`{c}` as `{STORED}{c}`" for c in fields])
    match = _match(keys, spread_by)
    updated = old.join(new, match, "left").selectExpr(
        *[
            f"`{STORED}{c}` as `{c}`" if c in keys else f"coalesce(`{c}`, `{STORED}{c}`) as `{c}`"
            for c in fields
        ]
    )
    stored_keys = old.select(*[STORED + k for k in keys]).distinct()
    return updated.unionByName(new.join(stored_keys, match, "left_anti"))


NEW, LAID, NEXT = "__new", "__laid", "__next"


def overlay_once(
    delta: DataFrame,
    history: DataFrame,
    keys: Sequence[str] = OVERLAY_KEYS,
    fields: dict[str, str] = MERGED_POSTS,
) -> DataFrame:
    """``overlay_history`` with one scan and one shuffle of history, for few rows per key.

    Both sides are shuffled together by the keys. A window hands the delta's row to
    the history rows of its key, and the delta's row itself stays only if the key is
    new. A key's rows meet in one task: merges leave few per key, and a history
    with hot keys belongs to ``overlay_history``.
    """
    sides = (
        conform(history, fields)
        .withColumn(NEW, F.lit(False))
        .unionByName(conform(delta, fields).withColumn(NEW, F.lit(True)))
    )
    known = F.lit(True)
    for k in keys:
        known &= F.col(k).isNotNull()
    per_key = Window.partitionBy(*keys).orderBy(F.desc(NEW))
    row = F.struct(*[c for c in fields if c not in keys])
    laid = sides.select(
        "*",
        F.when(known, F.first(F.when(F.col(NEW), row)).over(per_key)).alias(LAID),
        F.lead(NEW).over(per_key).alias(NEXT),
    )
    # A new row comes first in its key: an old row after it means that history has the key.
    kept = laid.where(~F.col(NEW) | F.coalesce(NEXT, F.lit(True)) | ~known)
    return kept.select(
        *[F.col(c) if c in keys else F.coalesce(F.col(LAID)[c], F.col(c)).alias(c) for c in fields]
    )


def merge_history(
    delta: DataFrame,
    history: DataFrame,
    spread_by: Sequence[str] | None = None,
    once: bool = False,
) -> DataFrame:
    """Overlay, then the newest row per post and reading within each post date.

    ``once`` reads and shuffles a history with few rows per key one time.
    """
    if once:
        merged = overlay_once(delta, history)
    else:
        merged = overlay_history(delta, history, spread_by=spread_by)
    return latest_per_key(
        merged, [POST_DATE, POST_KEY, "metrictimestamp"], HISTORY_ORDER, HISTORY_TIEBREAK
    )
