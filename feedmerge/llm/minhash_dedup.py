"""Near-duplicates by MinHash bands with sequential Bayesian verification.

1. Every whole text becomes its set of ``SHINGLE``-word shingles (64-bit hashes), a MinHash signature
   of ``HASHES`` values and a 128-bit key of the set. Rows with equal sets form one class, represented
   by its smallest id; only representatives go on.
2. Signatures are cut into bands. The smallest id in a bucket of equal band values leads it.
   Every document is a candidate with the leader it shares most buckets with, so a large
   group makes a star and not all pairs.
3. Candidates compare their signatures batch by batch. After each batch the posterior
   of the similarity, given the matches so far and a uniform prior, is bounded: if it
   reaches the threshold with a probability below ``MISS``, the pair is dropped. Survivors
   are verified on the full sets of their texts, which settles every link.
4. Verified links give components. In a bucket whose members lie in several, members of
   other components are candidates with its leader. A bucket that is still not of one
   component may hide a link that is not to its leader: its members are cut into blocks and
   blocks are compared, only between components, by the same sequential test and by
   their sets in 32-bit hashes; what is left is verified on full sets and joins components. So all pairs that share a bucket are settled.

With ``HASHES`` = 128 and bands of 4, a pair at exactly the threshold of 0.75 shares no
bucket with probability 5e-6; above it less. Nothing is capped or sampled.

Documents with fewer words than a shingle are one shingle of all their words. Null and
empty texts and those without words have no shingles, are linked with nothing and
kept. Rows with one doc_id count as one document: their classes are linked. A row without
doc_id is linked with nothing; its component_id is null and it is kept.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ByteTables, PowerTable, Scratch, Words, mix, sliced, with_columns
from .components import components

SHINGLE = 5
THRESHOLD = (3, 4)
HASHES = 128
BAND = 4
MISS = 1e-6
BATCH = 16
BLOCK = 256
#: Equal 32-bit hashes of different shingles that a pair may have before it is misjudged; it
#: grows with the squared sizes, as the expected number of them does.
SLACK = 4


def shingle_sets(texts: pa.Array, tables: ByteTables, powers: PowerTable, n: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = Words(texts, tables, powers)
    hashed = words.hashes(n)
    out = []
    for a, b in zip(words.starts.tolist(), words.ends.tolist()):
        if b - a >= n:
            out.append(np.unique(hashed[a : b - n + 1]))
        elif b > a:
            out.append(words.hashes(n, np.array([a]), np.array([b - 1])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


class MinHash:
    def __init__(self, hashes: int = HASHES, seed: int = 42):
        rng = np.random.default_rng(seed)
        self.a = rng.integers(1, 1 << 32, (hashes, 1), dtype=np.uint64).astype(np.uint32) | np.uint32(1)
        self.b = rng.integers(0, 1 << 32, (hashes, 1), dtype=np.uint64).astype(np.uint32)

    def sign(self, members: np.ndarray, most: int = 4096) -> np.ndarray:
        """The smallest permuted value of the set under each hash."""
        low = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        with np.errstate(over="ignore"):
            for i in range(0, len(members), most):
                x = members[i : i + most]
                high, part = (x >> np.uint64(32)).astype(np.uint32), x.astype(np.uint32)
                y = (part ^ (high >> np.uint32(7))) * self.a + (high ^ self.b)
                low = np.minimum(low, y.min(axis=1))
        return low


def least_matches(hashes: int = HASHES, batch: int = BATCH, threshold: float = THRESHOLD[0] / THRESHOLD[1], miss: float = MISS) -> list[tuple[int, int]]:
    """(n, m): after n hashes a pair with fewer than m matches is dropped.

    With m of n matches and a uniform prior the similarity is Beta(m + 1, n - m + 1),
    which reaches t with the probability that Binomial(n + 1, t) is at most m.
    """
    out = []
    for n in range(batch, hashes + 1, batch):
        below, m = 0.0, 0
        for k in range(n + 2):
            below += math.comb(n + 1, k) * threshold**k * (1 - threshold) ** (n + 1 - k)
            if below >= miss:
                m = k
                break
        out.append((n, m))
    return out


def survives(a: np.ndarray, b: np.ndarray, rule: list[tuple[int, int]]) -> np.ndarray:
    """Which rows of two signature matrices pass every batch; dropped rows are not compared further."""
    alive = np.arange(len(a))
    matches = np.zeros(len(a), np.int64)
    before = 0
    for n, m in rule:
        matches[alive] += (a[alive, before:n] == b[alive, before:n]).sum(axis=1)
        alive = alive[matches[alive] >= m]
        before = n
    out = np.zeros(len(a), bool)
    out[alive] = True
    return out


def matrix(column: pa.Array) -> np.ndarray:
    """Signatures of a binary column as rows."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), -1)


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_key and sig of every row."""

    def make():
        tables, powers, minhash = ByteTables.not_space(), PowerTable(), MinHash()

        def work(batch):
            sets = shingle_sets(batch.column("text"), tables, powers)
            return {
                "n_shingles": [len(s) for s in sets],
                "set_key": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                "sig": [minhash.sign(s).tobytes() if len(s) else None for s in sets],
            }

        return work

    return with_columns(docs.select("doc_id", "text"), "n_shingles bigint, set_key binary, sig binary", make).drop("text")


def buckets_of(sig: np.ndarray, band: int = BAND) -> np.ndarray:
    """The bucket of each band of each signature."""
    values = sig.astype(np.uint64)
    with np.errstate(over="ignore"):
        h = np.arange(values.shape[1] // band, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
        for i in range(band):
            h = mix(h ^ values[:, i::band]) + np.uint64(i + 1)
    return h.view(np.int64)


def banded(reps: DataFrame, band: int = BAND) -> DataFrame:
    """(bucket, id): a row for each band of each signature."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            found = buckets_of(matrix(batch.column("sig")), band)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.ravel()), pa.array(np.repeat(batch.column("id").to_numpy(zero_copy_only=False), found.shape[1]))],
                names=["bucket", "id"],
            )

    return reps.select("id", "sig").mapInArrow(run, "bucket bigint, id bigint")


def sequential(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures pass the sequential test."""
    rule = least_matches()

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                ok = survives(matrix(batch.column("sa")), matrix(batch.column("sb")), rule)
                yield batch.select(["a", "b"]).filter(pa.array(ok))

    side = lambda c: reps.select(F.col("id").alias(c), F.col("sig").alias(f"s{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a bigint, b bigint")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Adds ``linked``: the exact decision on the full shingle sets of both texts."""
    up, down = THRESHOLD

    def make():
        tables, powers = ByteTables.not_space(), PowerTable()

        def work(batch):
            a, b = (shingle_sets(batch.column(c), tables, powers) for c in ("ta", "tb"))
            same = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(a, b)]
            return {"linked": [down * s >= up * (len(x) + len(y) - s) for s, x, y in zip(same, a, b)]}

        return work

    side = lambda c: texts.select(F.col("id").alias(c), F.col("text").alias(f"t{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return with_columns(both, "linked boolean", make, "tb").select("a", "b", "linked")


def short_sets(texts: DataFrame) -> DataFrame:
    """(id, short): the sets as sorted distinct 32-bit hashes, for tests inside blocks."""

    def make():
        tables, powers = ByteTables.not_space(), PowerTable()

        def work(batch):
            sets = shingle_sets(batch.column("text"), tables, powers)
            return {"short": [np.unique(x.astype(np.uint32)).tobytes() for x in sets]}

        return work

    return with_columns(texts.select("id", "text"), "short binary", make).drop("text")


def compare_blocks(members: DataFrame) -> DataFrame:
    """Pairs of different components in one bucket that are worth an exact check.

    ``members``: bucket, id, component, sig, short, ``n`` (members of the bucket) and ``own``
    (members of the component in it). A component of more than half a block has
    blocks of its own, small ones share blocks, and no two blocks of one component meet.

    A pair is looked at in the first bucket it shares. If it passes the sequential test,
    its 32-bit sets tell its similarity up to a few equal hashes. Pairs below the
    threshold by more than the allowance in shingles are dropped, those above it by as much are
    thinned to a forest that connects the same members, and those in between all stay.
    """
    rule = least_matches()
    large = F.col("own") > BLOCK // 2
    within = F.when(large, F.pmod(F.xxhash64("id"), F.ceil(F.col("own") / BLOCK).cast("long"))).otherwise(
        F.pmod(F.xxhash64("component"), F.ceil(F.col("n") / (BLOCK // 2)).cast("long"))
    )
    alone = F.when(large, F.col("component"))
    blocks = members.groupBy("bucket", alone.alias("alone"), within.alias("part")).agg(
        F.collect_list(F.struct("id", "component", "sig", "short")).alias("m")
    )
    side = lambda c: blocks.select("bucket", F.struct(F.coalesce("alone", F.lit(-1).cast("long")), F.col("alone").isNull(), "part").alias(f"k{c}"), F.col("alone").alias(f"o{c}"), F.col("m").alias(f"m{c}"))
    met = side("a").join(side("b"), "bucket").where("ka <= kb and (oa is null or ob is null or oa <> ob)")

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                bucket = batch.column("bucket")[row].as_py()
                (ia, ca, sa, ta), (ib, cb, sb, tb) = (_unpack(batch.column(c)[row].as_py()) for c in ("ma", "mb"))
                x, y = np.nonzero((ca[:, None] != cb[None, :]) & (ia[:, None] != ib[None, :]))
                if batch.column("same")[row].as_py():
                    x, y = x[x < y], y[x < y]
                ha, hb = buckets_of(sa), buckets_of(sb)
                found = []
                for i in range(0, len(x), 4096):
                    p, q = x[i : i + 4096], y[i : i + 4096]
                    ok = survives(sa[p], sb[q], rule)
                    p, q = p[ok], q[ok]
                    same = ha[p] == hb[q]
                    first = ha[p, same.argmax(axis=1)] == bucket
                    found += zip(p[first].tolist(), q[first].tolist())
                pairs = _worth_checking(found, ia, ib, ta, tb)
                a, b = (np.array([r[k] for r in pairs], np.int64) for k in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    return met.select("bucket", (F.col("ka") == F.col("kb")).alias("same"), "ma", "mb").mapInArrow(run, "a bigint, b bigint").distinct()


def _worth_checking(found, ia, ib, ta, tb) -> list[tuple[int, int]]:
    up, down = THRESHOLD
    root: dict[int, int] = {}

    def top(v: int) -> int:
        while root.setdefault(v, v) != v:
            root[v] = root[root[v]]
            v = root[v]
        return v

    out = []
    for i, j in found:
        u, v = ta[i], tb[j]
        same = len(np.intersect1d(u, v, assume_unique=True))
        margin = down * same - up * (len(u) + len(v) - same)
        # long sets have equal 32-bit hashes of their own
        slack = (SLACK + ((len(u) + len(v)) ** 2 >> 31)) * (up + down)
        if margin < -slack:
            continue
        a, b = int(ia[i]), int(ib[j])
        if margin > slack:
            p, q = top(a), top(b)
            if p == q:
                continue
            root[p] = q
        out.append((a, b))
    return out


def still_split(inside: DataFrame, found: DataFrame, scratch: Scratch) -> DataFrame:
    """Members of the buckets that lie in several components, with those and their leader's."""
    placed = inside.join(found, "id", "left").withColumn("component", F.coalesce("component_id", "id"))
    parts = placed.groupBy("bucket").agg(
        F.min("component").alias("_low"),
        F.max("component").alias("_high"),
        F.max(F.when(F.col("id") == F.col("first"), F.col("component"))).alias("of_first"),
    )
    split = scratch.put(parts.where("_low <> _high").select("bucket", "of_first"))
    return placed.join(split, "bucket").select("bucket", "id", "first", "n", "component", "of_first")


def _unpack(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    sig = np.frombuffer(b"".join(r["sig"] for r in rows), np.uint32).reshape(len(rows), -1)
    short = [np.frombuffer(r["short"], np.uint32) for r in rows]
    return np.array([r["id"] for r in rows]), np.array([r["component"] for r in rows]), sig, short


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_key, component_id and kept of every row of ``docs``."""
    scratch = Scratch(docs.sparkSession, "minhash")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = scratch.put(signed(source))
    real = rows.where("doc_id is not null and n_shingles > 0")
    classes = scratch.put(real.groupBy("set_key").agg(F.min("doc_id").alias("rep")))
    member = scratch.put(real.join(classes, "set_key").select("doc_id", "set_key", "rep", F.when(F.col("doc_id") == F.col("rep"), F.col("sig")).alias("sig")))
    # a representative id may stand for several sets if an id repeats; they are one document
    reps = scratch.put(member.where("sig is not null").select(F.col("rep").alias("id"), "set_key", "sig").dropDuplicates(["id", "set_key"]))
    # an id that repeats joins all classes it is in
    several = member.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("_most")).where("a <> _most")
    again = member.join(several, "doc_id").where("rep <> a").select("a", F.col("rep").alias("b")).distinct()
    buckets = scratch.put(banded(reps).groupBy("bucket").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    inside = scratch.put(banded(reps).join(buckets, "bucket"))
    # the texts of all that may ever be a candidate, shuffled once and kept
    texts = scratch.put(source.join(inside.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi").withColumnRenamed("doc_id", "id"))
    # first every document meets the one leader it shares most buckets with
    votes = inside.where("id <> first").groupBy("id", "first").agg(F.count(F.lit(1)).alias("v"))
    best = votes.groupBy("id").agg(F.max(F.struct("v", (-F.col("first")).alias("l"))).alias("top"))
    pairs = best.select((-F.col("top.l")).alias("a"), F.col("id").alias("b"))
    checked = scratch.put(verified(scratch.put(sequential(pairs, reps)), texts))
    links = scratch.put(checked.where("linked").select("a", "b").union(again))
    found = scratch.put(components(links, scratch))
    # then, where a bucket is not of one component, members of others meet its leader
    mixed = scratch.put(still_split(inside, found, scratch))
    if not mixed.isEmpty():
        stars = mixed.where("component <> of_first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
        fresh = scratch.put(sequential(stars, reps)).join(checked.select("a", "b"), ["a", "b"], "left_anti")
        second = scratch.put(verified(fresh, texts))
        checked = checked.union(second)
        links = links.union(second.where("linked").select("a", "b"))
        if not second.where("linked").isEmpty():
            found = scratch.put(components(links, scratch))
        mixed = scratch.put(still_split(mixed.select("bucket", "id", "first", "n"), found, scratch))
    # and last, members of the components that still share a bucket meet in blocks
    if not mixed.isEmpty():
        sized = scratch.put(mixed.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("own")))
        members = mixed.select("bucket", "id", "component", "n").join(sized, ["bucket", "component"])
        sets = scratch.put(short_sets(texts.join(mixed.select("id").distinct(), "id", "left_semi")))
        blocks = compare_blocks(members.join(reps.select("id", "sig"), "id").join(sets, "id"))
        fresh = scratch.put(blocks).join(checked.select("a", "b"), ["a", "b"], "left_anti")
        more = scratch.put(verified(fresh, texts).where("linked").select("a", "b"))
        if not more.isEmpty():
            found = scratch.put(components(links.union(more), scratch))
    ids = member.select("doc_id", "set_key", "rep").join(found.withColumnRenamed("id", "rep"), "rep", "left")
    of_id = scratch.put(ids.groupBy("doc_id").agg(F.min(F.coalesce("component_id", "rep")).alias("component_id")))
    out = rows.select("doc_id", "n_shingles", "set_key").join(of_id, "doc_id", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", "set_key", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
