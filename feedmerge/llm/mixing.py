"""Mixing sources to target weights: whole passes, then a subset sum for the rest.

Sources have weights and share a budget; a source's target stops at ``MOST`` times its
size and what it cannot use goes to the others by weight. Each source first gives as
many whole passes over its documents as its target holds. The remaining budget is a
bounded knapsack over document lengths: documents are counted by exact length, an
equal share of every length is taken, and dynamic programming over the counts that are
left finds the lengths whose sum comes nearest to what remains. Which documents of a
length are taken is decided by a seeded hash.

The dynamic programme is a bit set of reachable sums of at most ``DP_WORDS`` words, or fewer than the
shortest document left has; what lies above that bound is first filled with the longest documents left. It runs
once for each source, over its number of distinct lengths, which is at most the square root of
twice its words.

Targets come from one window over the sources, which are few beside documents: the sources that hit
their cap are a prefix in order of cap by weight. Documents are ranked inside a
length by splitting its hash range into parts of about ``PART`` documents, so a
length that many copies share is ranked by many tasks.

A null text has size 0. Documents of size 0 add nothing and take 0. A null source
is a source of its own, last in order. Rows with equal ids are ranked by their
text's checksum; equal rows are interchangeable. Reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, aside

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEED = 42
DP_WORDS = 1 << 16
PART = 256


def with_size(docs: DataFrame) -> DataFrame:
    """Adds ``_size``, the number of words, and the source as a key that is never null."""
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    return docs.withColumn("_size", words).withColumn("_null", F.col("source").isNull()).withColumn("_source", F.coalesce("source", F.lit("")))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """_null, _source, source_size and target. ``sizes`` has a row for each source.

    A source is capped if giving every source in order of cap by weight the same
    rate would pass its cap; the rest share what the capped leave.
    """
    order = Window.orderBy("_null", F.encode("_source", "utf-8"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighted = sizes.withColumn("_w", F.element_at(cycle, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    capped = weighted.withColumn("_cap", (F.col("source_size") * most).cast("double"))
    every = Window.partitionBy()
    rate = Window.orderBy(F.col("_cap") / F.col("_w"), "_null", "_source")
    before = rate.rowsBetween(Window.unboundedPreceding, -1)
    rest = rate.rowsBetween(0, Window.unboundedFollowing)
    budget = F.sum("source_size").over(every) * F.lit(share)
    level = (budget - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_w").over(rest)
    found = capped.withColumn("_level", level).withColumn("_free", F.col("_level") * F.col("_w") < F.col("_cap"))
    # the level of the first source that is not capped holds for all after it
    shared = F.min(F.when(F.col("_free"), F.struct(F.col("_cap") / F.col("_w"), F.col("_null"), F.col("_source"), F.col("_level")))).over(every)
    target = F.when(shared.isNull(), F.col("_cap")).otherwise(F.least("_cap", shared["_level"] * F.col("_w")))
    return found.select("_null", "_source", "source_size", target.alias("target"))


def choose_lengths(counts: dict[int, int], budget: int, dp_words: int = DP_WORDS) -> dict[int, int]:
    """How many documents of each length to take so that the words come nearest to ``budget``."""
    total = sum(n * c for n, c in counts.items())
    if budget >= total:
        return dict(counts)
    taken = {n: c * budget // total for n, c in counts.items()}
    left = budget - sum(n * c for n, c in taken.items())
    for n in sorted(counts, reverse=True):
        if left <= dp_words or not n:
            break
        more = min(counts[n] - taken[n], (left - dp_words + n - 1) // n, left // n)
        taken[n] += more
        left -= more * n
    if left <= 0:
        return taken
    # bit i of reach: i words can be made; keep a little above the budget too
    top = 2 * left + 1
    mask, reach, steps = (1 << top) - 1, 1, []
    for n in sorted(counts):
        spare, size = min(counts[n] - taken[n], top // max(n, 1)), 1
        while spare > 0 and n and not reach >> left & 1:
            size = min(size, spare)
            steps.append((n, size, reach))
            reach |= reach << n * size & mask
            spare -= size
            size *= 2
    best = next(s for d in range(left + 1) for s in (left - d, left + d) if reach >> s & 1)
    for n, size, before in reversed(steps):
        if not before >> best & 1:
            taken[n] += size
            best -= n * size
    return taken


def plan(histogram: DataFrame, dp_words: int = DP_WORDS) -> DataFrame:
    """For each source and length: whole passes, and documents taken once more.

    One group holds the distinct lengths of one source.
    """

    def run(pdf):
        target, size = float(pdf["target"].iloc[0]), int(pdf["source_size"].iloc[0])
        passes = int(target // size) if size else 0
        counts = dict(zip(pdf["_size"].tolist(), pdf["_count"].tolist()))
        extra = choose_lengths(counts, round(target - passes * size), dp_words) if size else {}
        pdf["_passes"] = passes
        pdf["_extra"] = [extra.get(n, 0) for n in pdf["_size"].tolist()]
        return pdf

    schema = "_null boolean, _source string, _size bigint, _count bigint, source_size bigint, target double, _passes bigint, _extra bigint"
    return histogram.groupBy("_null", "_source").applyInPandas(run, schema)


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = SEED
) -> DataFrame:
    """``docs`` with ``_size``, ``source_size``, ``target`` and ``_times``, how often the mix takes a row."""
    scratch = Scratch(docs.sparkSession, "mixing")
    sized = with_size(docs)
    histogram = scratch.put(sized.groupBy("_null", "_source", "_size").agg(F.count(F.lit(1)).alias("_count")))
    sizes = histogram.groupBy("_null", "_source").agg(F.sum(F.col("_size") * F.col("_count")).alias("source_size"))
    goal = targets(sizes, weights, share, most)
    planned = scratch.put(plan(histogram.join(goal, ["_null", "_source"])))
    text = F.coalesce("text", F.lit(""))
    hashed = sized.withColumn("_h", F.xxhash64(F.lit(seed), "doc_id", F.xxhash64(text)))
    key = ["_null", "_source", "_size"]
    parts = F.pmod(F.shiftrightunsigned("_h", 20), F.ceil(F.col("_count") / F.lit(PART)).cast("long"))
    # ids and hashes only: texts stay out of the ranking
    narrow = hashed.select(*key, "_h").join(planned.where("_extra > 0 and _extra < _count"), key).withColumn("_part", parts)
    held = narrow.groupBy(*key, "_part").agg(F.count(F.lit(1)).alias("_n"), F.first("_extra").alias("_extra"))
    up_to = Window.partitionBy(*key).orderBy("_part")
    quota = scratch.put(
        held.withColumn("_quota", F.col("_extra") - (F.sum("_n").over(up_to) - F.col("_n"))).select(*key, "_part", "_quota")
    )
    spread = hashed.join(planned, key).withColumn("_part", parts)
    # a part is taken whole, in part or not at all; only those in part need a rank
    spread = spread.join(quota.where("_quota > 0"), [*key, "_part"], "left")
    rank = F.row_number().over(Window.partitionBy(*key, "_part").orderBy("_h", "doc_id"))
    once = F.when(F.col("_extra") == 0, False).when(F.col("_extra") >= F.col("_count"), True).otherwise(F.coalesce(rank <= F.col("_quota"), F.lit(False)))
    return spread.withColumn("_times", F.col("_passes") + once.cast("long"))


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns for every row of ``docs``."""
    return mix_sources(docs.select("doc_id", "text", "source")).select(
        "doc_id",
        F.col("_size").alias("size"),
        "source_size",
        "target",
        (F.col("_size") * F.col("_times")).alias("taken"),
    )


def mixture(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them."""
    hidden, back = aside(docs, "doc_id", "text", "source")
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times")))
    return back(mix_sources(hidden).where("_times > 0").select(*hidden.columns, times.alias("_copy")))
