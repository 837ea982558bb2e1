"""Vector codes: product quantisation by ball k-means, exact in integers.

Each component becomes floor(``SCALE`` * x), vectors are cut into ``PARTS`` consecutive parts, and
every part position has a codebook of ``ENTRIES`` entries, which starts as the parts of the
smallest vec_ids. A round assigns every part to its nearest entry (squared distance, ties to
the lower index) and replaces each entry by its parts' floored mean; entries nobody chose
stay. After the last round parts are assigned once more.

The assignment is that of ball k-means. The parts that chose an entry last time form its ball, here
within one batch of vectors, so that no pass is needed to learn radii. With the ball's radius r, an entry
whose centre is more than 2 r away cannot be nearer for any member: the others are its neighbours. A
member closer to its centre than half the way to the nearest neighbour lies in the stable
core and keeps its entry without a comparison; a member in the k-th ring, between half the ways to
the k-th and the next neighbour, meets the first k neighbours only. Before the first round all
parts are in the ball of entry 0. Comparisons are of exact integers, and a tie at a ring's border is
compared, so the result is that of a full search.

A round is one job over a scratch table that holds the integers beside the current codes; only
sums for each entry, whose number the parameters fix, reach the driver.

Rows whose vector is null or holds null or non-finite components are left out. Shorter
vectors, and lengths that are no multiple of the parts, count with zeros at their end. Null
vec_ids come after all others and are ordered by their vectors; of an id that repeats, its
smallest vector starts a codebook, and every row is coded. With fewer than ``ENTRIES`` rows the codebooks are
as short; without rows the result is empty. Integers of any size are exact; an error that no
64-bit integer holds is the largest one.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Integers beyond this are kept as text, as their sums would leave 64 bits.
LARGE = 1 << 62
LONG_MAX = (1 << 63) - 1
LIMB = 31
_VEC = "vec_id bigint, label string, v array<bigint>, large array<string>"


def whole(x: float, scale: int = SCALE) -> int:
    """floor(scale * x), exact for every finite double."""
    return int(x) * scale if abs(x) > 1 << 52 else math.floor(x * scale)


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label and the integers of usable rows: ``v``, or ``large`` as text if one is beyond ``LARGE``."""

    def run(batches):
        for batch in batches:
            ids, labels, small, large = [], [], [], []
            for i, label, values in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "label", "embedding"))):
                if any(x is None for x in values):
                    continue
                x = np.asarray(values, float)
                if not np.isfinite(x).all():
                    continue
                fits = not len(x) or np.abs(x).max() < LARGE / scale
                ids.append(i)
                labels.append(label)
                small.append(np.floor(x * scale).astype(np.int64) if fits else None)
                large.append(None if fits else [str(whole(float(y), scale)) for y in x])
            kinds = (pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((ids, labels, small, large), kinds)], names=["vec_id", "label", "v", "large"])

    rows = vectors.where("embedding is not null").select(F.col("vec_id").cast("long"), F.col("label").cast("string").alias("label"), "embedding")
    return rows.mapInArrow(run, _VEC)


def matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """The integers of a batch as rows of ``width``; Python integers where 64 bits may not do."""
    v, large = batch.column("v"), batch.column("large")
    n = batch.num_rows
    flat = v.flatten().to_numpy(zero_copy_only=False)
    if large.null_count == n and len(flat) == n * width:
        # four times the squared distance of two parts has to fit
        bound = math.isqrt(LARGE // (16 * max(width, 1)))
        rows = flat.reshape(n, width)
        return rows if not rows.size or max(-int(rows.min()), int(rows.max())) <= bound else rows.astype(object)
    out = np.zeros((n, width), object)
    for i, (a, b) in enumerate(zip(v.to_pylist(), large.to_pylist())):
        values = a if a is not None else list(map(int, b))
        out[i, : len(values)] = values
    return out


def squares(x: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1) if x.shape[1] else np.zeros(len(x), x.dtype)


def assign(x: np.ndarray, code: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each row of ``x`` and the squared distance; ``code`` holds its last entry."""
    if x.dtype == object or book.dtype == object:
        x, book = x.astype(object), book.astype(object)
    near = squares(x - book[code])
    code = code.copy()
    # rows by ball, fixed before any member moves
    order = np.argsort(code, kind="stable")
    cuts = np.searchsorted(code[order], np.arange(len(book) + 1))
    for i in range(len(book)):
        members = order[cuts[i] : cuts[i + 1]]
        if not len(members):
            continue
        apart = squares(book - book[i])
        twice = 4 * near[members]
        others = [j for j in range(len(book)) if j != i and apart[j] <= twice.max()]
        if not others:
            continue
        others.sort(key=lambda j: (apart[j], j))
        # the ring of a member: how many neighbours are at most twice as far as its centre
        ring = np.searchsorted(np.array([apart[j] for j in others], x.dtype), twice, side="right")
        by_ring = np.argsort(-ring, kind="stable")
        reach = -ring[by_ring]
        for k, j in enumerate(others):
            some = members[by_ring[: np.searchsorted(reach, -k, side="left")]]
            if not len(some):
                break
            d = squares(x[some] - book[j])
            closer = (d < near[some]) | ((d == near[some]) & (j < code[some]))
            hit = some[closer]
            near[hit], code[hit] = d[closer], j
    return code, near


def limbs(value: int) -> list[int]:
    """``value`` in base 2**LIMB; the last digit has its sign."""
    out = []
    while not -(1 << LIMB) <= value < 1 << LIMB:
        out.append(value & ((1 << LIMB) - 1))
        value >>= LIMB
    return [*out, value]


def coded(state: DataFrame, books: list[np.ndarray], width: int) -> DataFrame:
    """The rows of ``state`` with new codes (``code``) and ``error``, the summed distances."""
    parts = len(books)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch, width)
            before = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(-1, parts)
            size = width // parts
            found = [assign(x[:, p * size : (p + 1) * size], before[:, p].astype(np.int64), books[p]) for p in range(parts)]
            code = np.stack([c for c, _ in found], axis=1).astype(np.uint8)
            total = sum(d.astype(object) for _, d in found)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("vec_id", "label", "v", "large")), pa.array([r.tobytes() for r in code], pa.binary()), pa.array([min(int(t), LONG_MAX) for t in total], pa.int64())],
                names=["vec_id", "label", "v", "large", "code", "error"],
            )

    return state.select("vec_id", "label", "v", "large", "code").mapInArrow(run, f"{_VEC}, code binary, error bigint")


def totals(state: DataFrame, entries: int, parts: int, width: int) -> dict[tuple[int, int, int], int]:
    """(part, entry, position) -> sum over the entry's parts; position -1 counts them.

    Every task sums its own rows; the sums are spread over limbs, so that they stay exact.
    """
    size = width // parts

    def run(batches):
        sums = np.zeros((parts, entries, size + 1), object)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch, width)
            code = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(-1, parts)
            for p in range(parts):
                for e in np.unique(code[:, p]):
                    mine = x[code[:, p] == e, p * size : (p + 1) * size]
                    sums[p, e, :size] += mine.sum(axis=0).astype(object)
                    sums[p, e, size] += len(mine)
        rows = [
            (p, e, i if i < size else -1, at, limb)
            for (p, e, i), value in np.ndenumerate(sums)
            if value
            for at, limb in enumerate(limbs(int(value)))
        ]
        columns = list(zip(*rows)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=["part", "entry", "pos", "at", "limb"])

    found = state.select("v", "large", "code").mapInArrow(run, "part bigint, entry bigint, pos bigint, at bigint, limb bigint")
    out: dict[tuple[int, int, int], int] = {}
    for r in found.groupBy("part", "entry", "pos", "at").agg(F.sum("limb").alias("limb")).collect():
        key = (r.part, r.entry, r.pos)
        out[key] = out.get(key, 0) + (r.limb << LIMB * r.at)
    return out


def narrowed(values: list[list[int]], width: int) -> np.ndarray:
    """Entries as 64-bit integers if the distances between them fit, else as Python integers."""
    book = np.zeros((len(values), width), object)
    for i, row in enumerate(values):
        book[i] = row
    bound = math.isqrt(LARGE // (16 * max(PARTS * width, 1)))
    fits = all(-bound <= int(y) <= bound for y in book.ravel())
    return book.astype(np.int64) if fits else book


def moved(books: list[np.ndarray], sums: dict[tuple[int, int, int], int]) -> list[np.ndarray]:
    """Each entry at the floored mean of its parts, or where it was if it has none."""
    out = []
    for p, book in enumerate(books):
        rows = []
        for e, old in enumerate(book):
            n = sums.get((p, e, -1), 0)
            rows.append([sums.get((p, e, i), 0) // n for i in range(len(old))] if n else [int(y) for y in old])
        out.append(narrowed(rows, book.shape[1]))
    return out


def first_vectors(points: DataFrame, count: int) -> list[list[int]]:
    """The integers of the ``count`` smallest ids, then of null ids in the order of their vectors."""
    named = points.where("vec_id is not null")
    ids = [r.vec_id for r in named.select("vec_id").distinct().orderBy("vec_id").limit(count).collect()]
    vector = F.struct("v", "large")
    rows = named.where(F.col("vec_id").isin(ids)).groupBy("vec_id").agg(F.min(vector).alias("x")).orderBy("vec_id").collect() if ids else []
    if len(ids) < count:
        rows += points.where("vec_id is null").select(vector.alias("x")).orderBy("x").limit(count - len(ids)).collect()
    return [list(r.x.v) if r.x.v is not None else list(map(int, r.x.large)) for r in rows]


def fit_codes(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> tuple[DataFrame, list[np.ndarray]]:
    """vec_id, label (as text), code (a byte a part) and error of every usable row, and the final codebooks."""
    if not 0 < entries <= 256:
        raise ValueError("a code is one byte a part")
    scratch = Scratch(vectors.sparkSession, "codes")
    points = scratch.put(integers(vectors, scale))
    longest = points.agg(F.max(F.size(F.coalesce("v", F.transform("large", lambda x: F.lit(0).cast("long")))))).first()[0] or 0
    width = -(-longest // parts) * parts
    size = width // parts
    start = [[*v, *[0] * (width - len(v))] for v in first_vectors(points, entries)]
    books = [narrowed([v[p * size : (p + 1) * size] for v in start], size) for p in range(parts)]
    state = points.withColumn("code", F.unhex(F.lit("00" * parts)))
    for _ in range(rounds):
        fresh = scratch.put(coded(state, books, width))
        scratch.drop(points)
        points = state = fresh
        books = moved(books, totals(state, len(start), parts, width))
    return scratch.put(coded(state, books, width).select("vec_id", "label", "code", "error")), books


def books_digest(books: list[np.ndarray]) -> str:
    text = ",".join(str(int(y)) for book in books for y in book.ravel())
    return hashlib.sha256(text.encode()).hexdigest()


def digest(vectors: DataFrame) -> DataFrame:
    """The contract's columns for every usable row of ``vectors``."""
    rows, books = fit_codes(vectors.select("vec_id", "embedding", "label"))
    # summed as decimals: a label may hold most of all rows
    by_label = rows.groupBy(F.col("label").alias("_label")).agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("_sum"))
    held = F.least("_sum", F.lit(LONG_MAX).cast("decimal(38,0)")).cast("long")
    return rows.join(by_label, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", held.alias("label_error"), F.lit(books_digest(books)).alias("codebooks_sha256")
    )
