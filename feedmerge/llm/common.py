"""What the operators share: durable scratch tables, Arrow slices, word hashes, folds."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmerge.session import scratch_dir

SLICE_BYTES = 1 << 20
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BASE = 0x9E3779B97F4A7C15 | 1


class Scratch:
    """Intermediate tables of one run, as Parquet below the shared folder.

    A table cuts the lineage and outlives any executor. ``drop`` removes tables
    that are no longer needed; what a lazy result still reads goes when the
    driver ends.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = scratch_dir(spark, label)
        atexit.register(self._remove, self.root)

    def put(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            self._remove(table._scratch_path)

    def _remove(self, path: str) -> None:
        context = self.spark.sparkContext
        if context._jsc is None:
            return
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for the rows no model may learn from; an id of null counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, seed: int = 7
) -> DataFrame:
    """(doc_id, text, label) of at most ``per_class`` documents of each label.

    The documents with the smallest hashed ids of the training fold are taken, so
    reruns agree. Rows without an id or label are left out; an id that carries
    both labels is left out too.
    """
    clean = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min(label).alias("label"), F.max(label).alias("_other"))
        .where("label = _other")
        .select("doc_id", F.col("label").cast("int").alias("label"), F.xxhash64("doc_id", F.lit(seed)).alias("_h"))
    )
    picked = [
        clean.where(F.col("label") == v).orderBy("_h", "doc_id").limit(per_class) for v in (0, 1)
    ]
    # at most 2 x per_class rows, so the broadcast is bounded by the parameter
    ids = picked[0].unionByName(picked[1]).drop("_h")
    return docs.select("doc_id", "text").where("text is not null").join(F.broadcast(ids), "doc_id")


def label_share(labels: DataFrame, label: str) -> float | None:
    """The share of label 1 among the labels of the training fold."""
    known = labels.where(F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
    return known.agg(F.avg(F.col(label).cast("double"))).first()[0]


def logistic(x: np.ndarray, y: np.ndarray, prior: float, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton steps, for classes that occur as ``prior`` says."""
    share = y.mean()
    weight = np.where(y == 1, prior / share, (1 - prior) / (1 - share))
    w = np.zeros(x.shape[1])
    penalty = ridge * len(y) * np.eye(len(w)) / 100
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + penalty, x.T @ (weight * (y - p)) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def sliced(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice holds about ``most`` bytes of ``column``, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = (np.cumsum(size.astype(np.int64)) - size) // most
        starts = np.flatnonzero(np.diff(part, prepend=-1))
        for start, end in zip(starts, [*starts[1:], batch.num_rows]):
            yield batch.slice(start, end - start)


def append(batch: pa.RecordBatch, schema: pa.Schema, values: dict) -> pa.RecordBatch:
    """The columns of ``batch``, then those of ``values``, typed as ``schema`` says."""
    n = batch.num_columns
    fresh = [pa.array(values[f.name], f.type) for f in list(schema)[n:]]
    return pa.RecordBatch.from_arrays([batch.column(i).cast(schema.field(i).type) for i in range(n)] + fresh, schema=schema)


def aside(df: DataFrame, *used: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with private names for all columns but ``used``, and what gives a result these columns and names back.

    An operator that adds columns then meets no column of the same name.
    """
    names = df.columns
    private = [c if c in used else f"_aside_{i}" for i, c in enumerate(names)]
    return df.toDF(*private), lambda result: result.select(*private).toDF(*names)


def with_columns(df: DataFrame, columns: str, compute: Callable, text: str = "text") -> DataFrame:
    """``df`` with more columns, which ``compute(slice)`` returns as a dict of arrays.

    ``compute`` is made once in each task by calling the given factory. A column of ``df``
    with the name of a new one gives way to it.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    more = StructType.fromDDL(columns)
    df = df.drop(*more.names)
    out = StructType(list(df.schema) + list(more))
    added = [f.name for f in more]
    arrow = to_arrow_schema(more)

    def run(batches):
        work = compute()
        for batch in sliced(batches, text):
            schema = pa.schema(list(batch.schema) + list(arrow))
            made = work(batch)
            yield append(batch, schema, {c: made[c] for c in added})

    return df.mapInArrow(run, out)


def ascii_lower(text: str) -> str:
    """A-Z as a-z; other letters stay, so positions do too."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def inverse(base: int) -> int:
    """The inverse of an odd number modulo 2**64, by Newton's iteration."""
    x = base
    for _ in range(6):
        x = x * (2 - base * x) % (1 << 64)
    return x


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * MIX1
        x = (x ^ (x >> np.uint64(27))) * MIX2
        return x ^ (x >> np.uint64(31))


class ByteTables:
    """Byte classes of a word rule: which bytes belong to words, and their hash values."""

    def __init__(self, word: np.ndarray):
        self.word = word
        lower = np.arange(256)
        lower[65:91] += 32
        values = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
        self.value = values[lower]

    @classmethod
    def not_space(cls) -> ByteTables:
        """Words are runs of anything but ASCII white space."""
        word = np.ones(256, bool)
        word[[9, 10, 11, 12, 13, 32]] = False
        return cls(word)

    @classmethod
    def alphanumeric(cls) -> ByteTables:
        """Words are runs of ASCII letters, digits and any byte of other characters."""
        word = np.zeros(256, bool)
        word[48:58] = word[65:91] = word[97:123] = word[128:] = True
        return cls(word)


class Words:
    """The words of some texts, as hashes of byte ranges; A-Z count as a-z.

    Bytes outside words are squeezed out and every word ends with one mark, so a
    range of words hashes the same whatever stood between them. ``hashes(n)``
    gives one value for each run of n words that lies inside one text.
    """

    def __init__(self, texts: pa.Array, tables: ByteTables, powers: PowerTable):
        data = texts.cast(pa.large_binary()) if not pa.types.is_large_binary(texts.type) else texts
        data = pc.fill_null(data, b"")
        offsets = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + len(data) + 1]
        raw = np.frombuffer(data.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if data.buffers()[2] else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        # a gap after each text keeps words of two texts apart
        n = len(raw) + len(data)
        marks = offsets[1:] + np.arange(len(data))
        keep = np.ones(n, bool)
        keep[marks] = False
        word = np.zeros(n, bool)
        word[keep] = tables.word[raw]
        self.first = np.flatnonzero(word & ~np.concatenate(([False], word[:-1]))) if n else np.zeros(0, np.int64)
        self.last = np.flatnonzero(word & ~np.concatenate((word[1:], [False]))) if n else np.zeros(0, np.int64)
        self.text_end = marks
        self.starts = np.searchsorted(self.first, np.concatenate(([0], marks[:-1] + 1)) if len(marks) else [])
        self.ends = np.searchsorted(self.first, marks)
        ends_word = np.zeros(n, bool)
        ends_word[self.last + 1] = True
        used = word | ends_word
        value = np.zeros(n, np.uint64)
        value[keep] = tables.value[raw]
        value[~word] = np.uint64(1)
        squeezed = value[used]
        place = np.cumsum(used) - 1
        self.w0 = place[self.first]
        self.w1 = place[self.last] + 2
        up, self.down = powers.get(len(squeezed) + 1)
        with np.errstate(over="ignore"):
            self.prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(squeezed * up[: len(squeezed)], dtype=np.uint64)))

    def hashes(self, n: int, first: np.ndarray | None = None, last: np.ndarray | None = None) -> np.ndarray:
        """Hashes of the words ``first[i]`` to ``last[i]``, by default of every n-word run."""
        if first is None:
            first = np.arange(max(0, len(self.w0) - n + 1))
            last = first + n - 1
        a, b = self.w0[first], self.w1[last]
        with np.errstate(over="ignore"):
            return mix((self.prefix[b] - self.prefix[a]) * self.down[a])


class PowerTable:
    """Powers of the hash base and of its inverse, grown when a longer slice comes."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            with np.errstate(over="ignore"):
                full = lambda b: np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n, b, np.uint64))), dtype=np.uint64)
                self.up, self.down = full(BASE), full(inverse(BASE))
        return self.up, self.down


def distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the distinct values in their order: a place of each, how often it stands there, and the order of all."""
    order = np.argsort(key)
    fresh = np.flatnonzero(np.concatenate((np.ones(min(len(key), 1), bool), key[order[1:]] != key[order[:-1]])))
    return order[fresh], np.diff(fresh, append=len(key)), order


def in_one_task(sample: DataFrame, fit: Callable, schema: str) -> DataFrame:
    """Apply ``fit`` (a pandas frame to a pandas frame) to a sample of bounded size."""

    def run(frames):
        import pandas as pd

        found = list(frames)
        if found and sum(map(len, found)):
            yield fit(pd.concat(found, ignore_index=True))

    return sample.repartition(1).mapInPandas(run, schema)


class WordCache:
    """Values of words, computed once for each distinct word a task meets.

    ``compute`` maps a list of new words to a matrix with a row for each. At
    ``limit`` words the cache starts over, so its memory is bounded.
    """

    def __init__(self, compute: Callable[[list[str]], np.ndarray], limit: int = 400_000):
        self.compute, self.limit = compute, limit
        self.ids: dict[str, int] = {}
        self.matrix: np.ndarray | None = None

    def values(self, words: list[str]) -> np.ndarray:
        """One row of values for each of ``words``."""
        if len(self.ids) > self.limit:
            self.ids, self.matrix = {}, None
        fresh = list(set(words).difference(self.ids))
        if fresh or self.matrix is None:
            start = len(self.ids)
            self.ids.update(zip(fresh, range(start, start + len(fresh))))
            made = self.compute(fresh)
            end = start + len(made)
            if self.matrix is None or end > len(self.matrix):
                grown = np.zeros((max(4096, 2 * end), made.shape[1]))
                if start:
                    grown[:start] = self.matrix[:start]
                self.matrix = grown
            self.matrix[start:end] = made
        at = np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))
        return self.matrix[at]
