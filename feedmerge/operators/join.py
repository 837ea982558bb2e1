"""Posts with their metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedmerge.functions.dates import DateLike, as_date, in_date_range, parse_day
from feedmerge.operators.latest import latest_per_key
from feedmerge.schemas import COUNT_OVERRIDES, POST_DATE, POST_KEY, RIGHT_SUFFIX

DAY = "__day"
BATCH = "__batch"
MAX_RANGE_DAYS = 100_000
POST_ORDER = ("metrictimestamp", "kafkaoffset", "kafkapartition")
METRIC_ORDER = ("metricstimestamp", "kafkaoffset", "kafkapartition")
MERGED_ORDER = ("metricstimestamp", "metrictimestamp")
MERGED_TIEBREAK = (
    "kafkaoffset_metrics",
    "kafkapartition_metrics",
    "kafkaoffset",
    "kafkapartition",
    POST_DATE,
)


def filter_date_range(
    df: DataFrame, column: str, lower: DateLike, upper: DateLike, day: str = DAY
) -> DataFrame:
    """Rows on days from ``lower`` to ``upper``, with that day in column ``day``."""
    return df.where(in_date_range(df, column, lower, upper)).withColumn(day, as_date(column))


def distinct_days(df: DataFrame, day: str = DAY) -> DataFrame:
    return df.select(day).where(F.col(day).isNotNull()).distinct()


def filter_days(df: DataFrame, days: DataFrame | Sequence[DateLike], day: str = DAY) -> DataFrame:
    """Rows on the given days: a list becomes an ``IN``, a frame a semi join."""
    if isinstance(days, DataFrame):
        return df.join(days.select(day), day, "left_semi")
    return df.where(F.col(day).isin([parse_day(d) for d in days]))


def broadcast_days(days: DataFrame, lower: DateLike, upper: DateLike) -> DataFrame:
    """Hint a broadcast of a frame with one row per day, if the range is sane."""
    span = (parse_day(upper) - parse_day(lower)).days + 1
    return F.broadcast(days) if span <= MAX_RANGE_DAYS else days


def days_of_range(df: DataFrame, lower: DateLike, upper: DateLike, day: str = DAY) -> DataFrame:
    """Distinct days of a frame already limited to a range, ready to be joined."""
    return broadcast_days(distinct_days(df, day), lower, upper)


def suffix_collisions(right: DataFrame, left: DataFrame, suffix: str = RIGHT_SUFFIX) -> DataFrame:
    """Rename the columns of ``right`` that ``left`` has too, and no others."""
    shared = set(left.columns) & set(right.columns)
    return right.withColumnsRenamed({c: c + suffix for c in right.columns if c in shared})


def _sides(posts: DataFrame, metrics: DataFrame, scope: Sequence[str]):
    left = posts.drop("partdate")
    right = suffix_collisions(metrics.drop("partdate"), left)
    keys = [(k, k + RIGHT_SUFFIX) for k in ("id", DAY, *scope)]
    return left.alias("p"), right.alias("m"), keys


def _resolve(joined: DataFrame, keys: Sequence[tuple[str, str]]) -> DataFrame:
    """Pick keys from the side that has them, and counts from the metric first."""
    names = {"id": POST_KEY, DAY: POST_DATE}
    used = {c for pair in keys for c in pair} | set(COUNT_OVERRIDES.values())
    kept = [
        f"coalesce(`{COUNT_OVERRIDES[c]}`, `{c}`) as `{c}`" if c in COUNT_OVERRIDES else f"`{c}`"
        for c in joined.columns
        if c not in used
    ]
    # The date goes before the key, as in the merged schema.
    ends = [
        f"coalesce(`{left}`, `{right}`) as `{names.get(left, left)}`"
        for left, right in sorted(keys, key=lambda pair: pair[0] == "id")
    ]
    return joined.selectExpr(*kept, *ends)


def join_posts_metrics(posts: DataFrame, metrics: DataFrame) -> DataFrame:
    """Full outer join on the same id and day, every matching pair included.

    Both sides need the day column that ``filter_date_range`` adds. The matched
    and the unmatched rows are joined apart: AQE can split a hot key on either
    side of an inner or anti join, but never in a full outer one.
    """
    left, right, keys = _sides(posts, metrics, ())
    match = [F.col(f"p.{a}") == F.col(f"m.{b}") for a, b in keys]
    left_keys = left.select(*[a for a, _ in keys]).distinct().alias("p")
    right_keys = right.select(*[b for _, b in keys]).distinct().alias("m")
    pairs = left.join(right, match, "inner")
    posts_only = left.join(right_keys, match, "left_anti")
    metrics_only = right.join(left_keys, match, "left_anti")
    rows = pairs.unionByName(posts_only, allowMissingColumns=True)
    return _resolve(rows.unionByName(metrics_only, allowMissingColumns=True), keys)


def latest_posts_with_metrics(merged: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """One row per post: the newest metric, then the newest post reading."""
    return latest_per_key(merged, [POST_KEY, *scope], MERGED_ORDER, MERGED_TIEBREAK)


def merge_latest_posts_metrics(
    posts: DataFrame, metrics: DataFrame, scope: Sequence[str] = ()
) -> DataFrame:
    """``latest_posts_with_metrics(join_posts_metrics(...))`` without the pairs.

    The winner of a group of pairs is its newest metric beside its newest post,
    so each side is cut to one row per id and day before the join. The join is
    then one to one and shuffles nothing, whatever the size of a key.
    """
    keys = ["id", DAY, *scope]
    left, right, pairs = _sides(
        latest_per_key(posts, keys, POST_ORDER, ()),
        latest_per_key(metrics, keys, METRIC_ORDER, ()),
        scope,
    )
    match = [F.col(f"p.{a}") == F.col(f"m.{b}") for a, b in pairs]
    joined = _resolve(left.join(right, match, "full_outer"), pairs)
    return latest_posts_with_metrics(joined, scope)


def number_batches(days: DataFrame, batch_size: int, day: str = DAY) -> DataFrame:
    """Group sorted days into batches; ``days`` has one row per day of a range."""
    position = F.row_number().over(Window.orderBy(day)) - 1
    return days.withColumn(BATCH, F.floor(position / batch_size).cast("int"))
