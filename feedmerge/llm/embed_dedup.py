"""Near-duplicate vectors: sign hashes of random hyperplanes, then exact cosines.

Vectors of one label (and one length) are hashed in several tables; a table's code is
the signs of ``bits`` random projections. Two vectors whose cosine is at least the
threshold share a table's code with a known probability, and there are as many tables
as keep the chance that they share none below ``MISS``. ``bits`` grows with the logarithm of
the vectors of a label, so that a bucket keeps about ``PEERS`` of them; the
chance of a miss is the same at every size.

Equal vectors of one label form a class and only its smallest id is hashed; classes
count with their sizes. Buckets first meet in sketches: the first ``SKETCH`` signs of a vector, 32
bytes. A member goes on only if a sketch of its bucket differs in no more signs than a
pair at the threshold does but once in 1 / ``SLIP``, and if no table the sketch covers has met
that pair before. Only these members fetch their vectors, so a vector
without a near one is copied into no bucket. A bucket above ``BLOCK`` members is cut into
blocks that meet in pairs, in both steps; inside, all cosines are computed in double precision at once. A
block pair returns how many vectors each member is linked with, counting a
pair only in the first table where its codes agree, and a spanning forest of its
links, never its pairs. Forests give the components.

Vectors that are null, zero, or hold null or non-finite components, and rows with a null label, are
linked with nothing. So are rows with a null vec_id; their component_id is null and
they are kept. Rows that repeat a vec_id count as vectors of their own and
share their component.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, mix
from .components import components

THRESHOLD = 0.93
MISS = 1e-4
PEERS = 128
LEAST_BITS = 6
MOST_BITS = 24
BLOCK = 256
SKETCH = 256
SLIP = 1e-6


def tables_for(bits: int, threshold: float = THRESHOLD, miss: float = MISS) -> int:
    """Tables that keep the chance of sharing no code below ``miss`` at the threshold."""
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return math.ceil(math.log(miss) / math.log1p(-agree))


def most_apart(threshold: float = THRESHOLD, slip: float = SLIP) -> int:
    """The signs of a sketch in which pairs at the threshold differ; more have a chance below ``slip``."""
    p, chance, most = math.acos(threshold) / math.pi, 1.0, -1
    while chance > slip and most < SKETCH:
        most += 1
        chance -= math.comb(SKETCH, most) * p**most * (1 - p) ** (SKETCH - most)
    return most


def projections(dim: int, count: int, seed: int) -> np.ndarray:
    return np.random.default_rng((seed, dim)).standard_normal((dim, count))


def _vector(values) -> np.ndarray | None:
    """The components as doubles scaled by the largest one, or None if they are unusable."""
    if values is None or not len(values) or any(v is None for v in values):
        return None
    v = np.asarray(values, float)
    top = np.abs(v).max()
    return v / top if np.isfinite(top) and top > 0 else None


def kind_of(vectors: DataFrame) -> str:
    """How components are stored: floats as such, other numbers as doubles."""
    return "f4" if vectors.schema["embedding"].dataType.elementType.typeName() == "float" else "f8"


def keyed(vectors: DataFrame) -> DataFrame:
    """vec_id, label, vec (its components as bytes) and key (a hash of label and vector) of usable rows."""
    kind = kind_of(vectors)

    def run(batches):
        for batch in batches:
            found = []
            for i, label, values in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "label", "embedding"))):
                v = _vector(values)
                if v is not None:
                    data = np.asarray(values, float).tobytes()
                    name = str(label).encode("utf-8", "surrogatepass")
                    key = hashlib.blake2b(len(name).to_bytes(8, "little") + name + data, digest_size=16).digest()
                    found.append((i, label, np.asarray(values, kind).tobytes(), key))
            columns = list(zip(*found)) or [[], [], [], []]
            kinds = (pa.int64(), pa.string(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["vec_id", "label", "vec", "key"])

    usable = vectors.where("vec_id is not null and label is not null and embedding is not null")
    return usable.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), "embedding").mapInArrow(
        run, "vec_id bigint, label string, vec binary, key binary"
    )


def hashed(reps: DataFrame, bits: int, tables: int, seed: int, kind: str) -> DataFrame:
    """id, size, own (a hash of label and vector length), vec and signs: one bit for each projection."""

    def run(batches):
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            own, signs = [], []
            for label, data in zip(batch.column("label").to_pylist(), batch.column("vec").to_pylist()):
                v = np.frombuffer(data, kind).astype(float)
                if len(v) not in planes:
                    planes[len(v)] = projections(len(v), max(SKETCH, tables * bits), seed)
                signs.append(np.packbits(v / np.abs(v).max() @ planes[len(v)] > 0).tobytes())
                name = f"{len(v)} {label}".encode("utf-8", "surrogatepass")
                own.append(int.from_bytes(hashlib.blake2b(name, digest_size=8).digest(), "little", signed=True))
            columns = [batch.column("id"), batch.column("size"), pa.array(own, pa.int64()), batch.column("vec"), pa.array(signs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "size", "own", "vec", "signs"])

    return reps.select("id", "size", "label", "vec").mapInArrow(run, "id bigint, size bigint, own bigint, vec binary, signs binary")


def unpacked(signs: list[bytes]) -> np.ndarray:
    return np.unpackbits(np.frombuffer(b"".join(signs), np.uint8).reshape(len(signs), -1), axis=1)


def codes_of(signs: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """A code for each of the first ``tables`` tables from a row of signs."""
    own = signs[:, : tables * bits].reshape(len(signs), tables, bits)
    return own.astype(np.float32) @ (1 << np.arange(bits)).astype(np.float32)


def bucketed(reps: DataFrame, bits: int, tables: int) -> DataFrame:
    """(bucket, turn, id, sketch): a row for each table; label and vector length are part of the bucket."""

    def run(batches):
        turn = np.arange(tables, dtype=np.uint64)
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                signs = batch.column("signs").to_pylist()
                codes = codes_of(unpacked(signs), bits, tables).astype(np.uint64)
                own = batch.column("own").to_numpy(zero_copy_only=False).view(np.uint64)
                with np.errstate(over="ignore"):
                    h = mix(mix(codes + (turn << np.uint64(32))) ^ own[:, None])
                at = np.repeat(np.arange(len(codes)), tables)
                sketch = pa.array([x[: SKETCH // 8] for x in signs], pa.binary())
                columns = [pa.array(h.ravel().view(np.int64)), pa.array(np.tile(turn.astype(np.int32), len(codes))), batch.column("id").take(pa.array(at)), sketch.take(pa.array(at))]
                yield pa.RecordBatch.from_arrays(columns, names=["bucket", "turn", "id", "sketch"])

    return reps.select("id", "own", "signs").mapInArrow(run, "bucket bigint, turn int, id bigint, sketch binary")


def promising(pairs: DataFrame, bits: int, threshold: float) -> DataFrame:
    """(bucket, turn, part, id, n) of the members with a near sketch that no table before has met.

    A task names a member once, however many blocks it meets.
    """
    most, covered = most_apart(threshold), SKETCH // bits

    def run(batches):
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            rows: list[tuple] = []
            for row in batch.to_pylist():
                turn = min(row["turn"], covered)
                sides = []
                for m in (row["ma"], row["mb"]):
                    if m is not None:
                        s = unpacked([r["sketch"] for r in m])
                        sides.append((m, s.astype(np.float32) * 2 - 1, codes_of(s, bits, turn)))
                a, b = sides[0], sides[-1]
                close = a[1] @ b[1].T >= SKETCH - 2 * most
                if row["mb"] is None:
                    close = np.triu(close, 1)
                x, y = np.nonzero(close)
                fresh = ~(a[2][x] == b[2][y]).any(axis=1)
                for (m, *_), at, part in ((a, x, row["pa"]), (b, y, row["pb"])):
                    for i in np.unique(at[fresh]).tolist():
                        if (row["bucket"], m[i]["id"]) not in seen:
                            seen.add((row["bucket"], m[i]["id"]))
                            rows.append((row["bucket"], row["turn"], part, m[i]["id"], row["n"]))
                if len(seen) > 1_000_000:
                    seen.clear()
            columns = list(zip(*rows)) or [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["bucket", "turn", "part", "id", "n"])

    schema = "bucket bigint, turn int, part bigint, id bigint, n bigint"
    return pairs.select("bucket", "turn", "n", "pa", "pb", "ma", "mb").mapInArrow(run, schema)


def blocks_of(members: DataFrame, *columns: str) -> DataFrame:
    """The members of each part of a bucket, at most about ``BLOCK``."""
    held = F.collect_list(F.struct(*columns)).alias("m")
    return members.groupBy("bucket", "part").agg(F.first("turn").alias("turn"), F.first("n").alias("n"), held)


def alone(blocks: DataFrame) -> DataFrame:
    """Every block by itself, in the columns of ``met_pairs``."""
    none = F.lit(None).cast(blocks.schema["m"].dataType).alias("mb")
    return blocks.select("bucket", "turn", "n", F.col("part").alias("pa"), F.col("part").alias("pb"), F.col("m").alias("ma"), none)


def met_pairs(blocks: DataFrame) -> DataFrame:
    """Every two blocks of one bucket."""
    other = blocks.select("bucket", F.col("part").alias("pb"), F.col("m").alias("mb"))
    pairs = blocks.join(other, "bucket").where("part < pb")
    return pairs.select("bucket", "turn", "n", F.col("part").alias("pa"), "pb", F.col("m").alias("ma"), "mb")


def _unpack(rows: list[dict], bits: int, tables: int, kind: str):
    v = np.frombuffer(b"".join(r["vec"] for r in rows), kind).reshape(len(rows), -1).astype(float)
    v /= np.abs(v).max(axis=1)[:, None]
    codes = codes_of(unpacked([r["signs"] for r in rows]), bits, tables)
    return np.array([r["id"] for r in rows]), np.array([r["size"] for r in rows]), v / np.linalg.norm(v, axis=1)[:, None], codes


def forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what all the links (a[i], b[i]) connect."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = root(x), root(y)
        if p != q:
            up[p] = q
            out.append((x, y))
    return out


def met(pairs: DataFrame, threshold: float, bits: int, kind: str) -> DataFrame:
    """(a, b, n): with b null, n vectors are linked with a; else a link of a forest."""

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                turn, mb = batch.column("turn")[row].as_py(), batch.column("mb")[row].as_py()
                same = mb is None
                a = _unpack(batch.column("ma")[row].as_py(), bits, turn, kind)
                b = a if same else _unpack(mb, bits, turn, kind)
                close = a[2] @ b[2].T >= threshold
                if same:
                    close = np.triu(close, 1)
                x, y = np.nonzero(close)
                fresh = ~(a[3][x] == b[3][y]).any(axis=1)
                x, y = x[fresh], y[fresh]
                n = np.bincount(x, b[1][y], len(a[0]))
                m = np.bincount(y, a[1][x], len(b[0]))
                links = forest(a[0][x], b[0][y])
                ids = [*a[0][n > 0].tolist(), *b[0][m > 0].tolist(), *(p for p, _ in links)]
                other = [None] * (int((n > 0).sum()) + int((m > 0).sum())) + [q for _, q in links]
                count = [*n[n > 0].astype(int).tolist(), *m[m > 0].astype(int).tolist(), *(0 for _ in links)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (ids, other, count)], names=["a", "b", "n"])

    return pairs.select("turn", "ma", "mb").mapInArrow(run, "a bigint, b bigint, n bigint")


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, miss: float = MISS, seed: int = 42) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors``."""
    scratch = Scratch(vectors.sparkSession, "embeddings")
    kind = kind_of(vectors)
    rows = scratch.put(keyed(vectors))
    # the key tells labels apart, so all rows of a class have one label
    classes = scratch.put(rows.groupBy("key").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("size"), F.min("label").alias("label")))
    member = scratch.put(rows.select("vec_id", "key").join(classes.select("key", "id"), "key"))
    # how many vectors the label of a vector has, in the mean over vectors
    per_label = classes.groupBy("label").count().agg((F.sum(F.col("count") * F.col("count")) / F.sum("count"))).first()[0]
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(1.0, per_label or 1.0) / PEERS))))
    tables = tables_for(bits, threshold, miss)
    first = rows.withColumnRenamed("vec_id", "id").dropDuplicates(["key", "id"]).join(classes.select("key", "id", "size"), ["key", "id"])
    reps = scratch.put(hashed(first, bits, tables, seed, kind))
    inside = bucketed(reps, bits, tables)
    large = scratch.put(inside.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK))
    part = F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / BLOCK).cast("long"))
    whole = inside.join(large, "bucket", "left_anti").withColumns({"n": F.lit(0).cast("long"), "part": F.lit(0).cast("long")})
    cut = scratch.put(blocks_of(inside.join(large, "bucket").withColumn("part", part), "id", "sketch"))
    near = alone(blocks_of(whole, "id", "sketch").where(F.size("m") > 1)).unionByName(alone(cut))
    wanted = promising(near, bits, threshold).unionByName(promising(met_pairs(cut), bits, threshold)).distinct()
    blocks = scratch.put(blocks_of(wanted.join(reps.select("id", "size", "vec", "signs"), "id"), "id", "size", "vec", "signs"))
    several_parts = blocks.where(F.col("n") > BLOCK)
    found = scratch.put(met(alone(blocks), threshold, bits, kind).unionByName(met(met_pairs(several_parts), threshold, bits, kind)))
    counts = found.where("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("links"))
    # an id that repeats joins all classes it is in
    several = member.groupBy("vec_id").agg(F.min("id").alias("a"), F.max("id").alias("_most")).where("a <> _most")
    again = member.join(several, "vec_id").where("id <> a").select("a", F.col("id").alias("b")).distinct()
    place = components(found.where("b is not null").select("a", "b").union(again), scratch)
    of_class = scratch.put(
        classes.join(counts, "id", "left").join(place, "id", "left").select(
            "key", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component_id", "id").alias("component_id")
        )
    )
    linked = member.select("vec_id", "key").join(of_class, "key").select("vec_id", "n_links", "component_id")
    known = keyed_ids(vectors)
    rest = known.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    every = linked.unionByName(rest)
    return every.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def keyed_ids(vectors: DataFrame) -> DataFrame:
    """vec_id of every row, and whether its vector takes part; the rule of ``keyed`` as expressions."""
    value = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists(value, lambda x: x != 0)
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite & some
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.coalesce(usable, F.lit(False)).alias("usable"))
