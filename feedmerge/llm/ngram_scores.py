"""Language-model scores by n-grams in Elias-Fano tries.

Counts of one to three words are gathered from all training documents. The base score is that of single
tokens with add-``ADD`` smoothing. The model lays absolute discounting over it: of the words seen after a
context h of count c(h), word w has a(w, h) = (c(h, w) - ``DISCOUNT``) / c(h), and what the kept words leave is the
weight b(h) of the shorter context, so p(w | h) = a(w, h) + b(h) p(w | shorter h) sums to one. Three-word
sequences count from ``LEAST`` occurrences on, shorter ones from the first.

Each level is a trie that is cut into shards by its contexts. A shard holds its contexts, the pointers to their children
and the children's word numbers as Elias-Fano sequences: contexts and pointers are monotone, and
word numbers become so by adding the last value of the context before, so that a word is found by a successor search
among its own context's children. Probabilities and weights are 16-bit codes on a logarithmic scale. A
shard's arrays are files that its task maps into memory, asks, and removes.

Texts are read once. A few megabytes of them become one chunk row: numbered words, bucketed by chunk so that
later stages meet it where it lies. Word counts come from one shuffle of the chunks' words. At each level a chunk sends each
shard one packed list of its distinct sequences with their training counts; the shard adds them up, builds its trie
and answers the list in its order. Sequences are thinned before they are sent: a three-word sequence can
only be kept if both of its word pairs occur ``LEAST`` times. A context of more than 1 / ``HOT_SHARE`` of
all tokens is dealt over ``SALTS`` shards by its words; there are at most ``HOT_SHARE`` of these and their weights,
which no shard knows alone, go to all tasks.

A null text is empty: one token, the end. A null doc_id counts as an empty text in the choice of training
documents. Rows with equal ids are documents of their own, and repeated rows count as often as they stand there.
With no training document every token is unknown. A word is never the end. A chunk is at least one whole
text, so memory grows with the longest text. At most 2**32 - 4 distinct words can be numbered.
"""

from __future__ import annotations

import atexit
import math
import tempfile
import uuid
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, distinct, mix, sliced

ADD = 0.1
DISCOUNT = 0.75
#: Occurrences from which sequences of two and three words are kept.
LEAST = {2: 1, 3: 2}
CHUNK = 4 << 20
#: Tokens for each shard of a level.
SHARD = 2_000_000
HOT_SHARE = 4096
HOT_LEAST = 1 << 20
SALTS = 64
GRID = 4096.0
NONE = np.uint16(0xFFFF)

#: What each code stands for.
CODED = np.append(10.0 ** (-np.arange(0xFFFF) / GRID), 0.0)

BEGIN, END, FIRST = 0, 1, 2
UNKNOWN = 0xFFFFFFFF
WORD = np.ones(256, bool)
WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False


# ---------------------------------------------------------------- Elias-Fano


class EliasFano:
    """A sorted sequence: low bits packed, high bits in unary, with ones counted before every word."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.ones = n, low_bits, low, high, ones
        self.buckets = 0

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        high = (values >> np.uint64(bits)).astype(np.int64)
        at = high + np.arange(n)
        # a zero ends every bucket, the last one too
        size = n + (top >> bits) + 2
        flags = np.zeros(-(-size // 64) * 64, np.uint8)
        flags[at] = 1
        words = np.packbits(flags, bitorder="little").view(np.uint64)
        ones = np.concatenate(([0], np.cumsum(flags.reshape(-1, 64).sum(axis=1, dtype=np.int64))))
        low = np.zeros(n * bits // 64 + 2, np.uint64)
        if bits and n:
            part = values & np.uint64((1 << bits) - 1)
            place = np.arange(n, dtype=np.uint64) * np.uint64(bits)
            word, shift = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
            begin = np.flatnonzero(np.diff(word, prepend=-1))
            low[word[begin]] = np.bitwise_or.reduceat(part << shift, begin)
            # at most one value runs over the end of a word
            over = shift + np.uint64(bits) > np.uint64(64)
            low[word[over] + 1] |= part[over] >> (np.uint64(64) - shift[over])
        return cls(n, bits, low, words, ones)

    def arrays(self) -> dict[str, np.ndarray]:
        return {"head": np.array([self.n, self.low_bits]), "low": self.low, "high": self.high, "ones": self.ones}

    @classmethod
    def of(cls, arrays: dict[str, np.ndarray]) -> EliasFano:
        return cls(int(arrays["head"][0]), int(arrays["head"][1]), arrays["low"], arrays["high"], arrays["ones"])

    def _select(self, k: np.ndarray, one: bool) -> np.ndarray:
        """The place of the k-th one, or zero, of the high bits."""
        before = self.ones if one else 64 * np.arange(len(self.ones)) - self.ones
        out = np.zeros(len(k), np.int64)
        for i in range(0, len(k), 1 << 16):
            some = k[i : i + (1 << 16)]
            word = np.searchsorted(before, some, side="right") - 1
            first, last = int(word.min()), int(word.max())
            if last - first < len(some):
                # dense questions: read the stretch of words once
                bits = np.unpackbits(self.high[first : last + 1].view(np.uint8), bitorder="little")
                out[i : i + len(some)] = 64 * first + np.flatnonzero(bits if one else 1 - bits)[some - before[first]]
                continue
            bits = np.unpackbits(self.high[word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            seen = np.cumsum(bits if one else 1 - bits, axis=1, dtype=np.uint8)
            out[i : i + len(some)] = 64 * word + (seen > (some - before[word]).astype(np.uint8)[:, None]).argmax(axis=1)
        return out

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        place = i.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
        value = self.low[word] >> shift
        over = shift + np.uint64(self.low_bits) > np.uint64(64)
        value[over] |= self.low[word[over] + 1] << (np.uint64(64) - shift[over])
        return value & np.uint64((1 << self.low_bits) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        high = self._select(i, True) - i
        return (high.astype(np.uint64) << np.uint64(self.low_bits)) | self._low(i)

    def find(self, x: np.ndarray, start: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """The index of each ``x``, between ``start`` and ``end`` if given, or -1: the successor, if it is equal."""
        out = np.full(len(x), -1, np.int64)
        if not self.n or not len(x):
            return out
        zeros = 64 * len(self.high) - int(self.ones[-1])
        high = x >> np.uint64(self.low_bits)
        inside = np.flatnonzero(high < np.uint64(zeros - 1))
        h, want = high[inside].astype(np.int64), x[inside] & np.uint64((1 << self.low_bits) - 1)
        hi = np.minimum(self._select(h, False) - h, self.n)
        lo = np.where(h > 0, self._select(np.maximum(h - 1, 0), False) - (h - 1), 0)
        if start is not None:
            lo, hi = np.maximum(lo, start[inside]), np.minimum(hi, end[inside])
        last = hi.copy()
        alive = np.flatnonzero(lo < hi)
        while len(alive):
            middle = (lo[alive] + hi[alive]) >> 1
            less = self._low(middle) < want[alive]
            lo[alive] = np.where(less, middle + 1, lo[alive])
            hi[alive] = np.where(less, hi[alive], middle)
            alive = alive[lo[alive] < hi[alive]]
        there = np.flatnonzero(lo < last)
        there = there[self._low(lo[there]) == want[there]]
        out[inside[there]] = lo[there]
        return out


def to_code(p: np.ndarray) -> np.ndarray:
    """Probabilities on a logarithmic grid of 16 bits; zero has a code of its own."""
    with np.errstate(divide="ignore"):
        step = np.rint(-np.log10(p) * GRID)
    return np.where(p > 0, np.minimum(step, 0xFFFE), NONE).astype(np.uint16)


def of_code(code: np.ndarray) -> np.ndarray:
    return CODED[code]


class Trie:
    """Contexts, pointers and children of one shard of a level, with coded probabilities."""

    SEQUENCES = ("contexts", "pointers", "children")

    def __init__(self, contexts: EliasFano, pointers: EliasFano, children: EliasFano, a: np.ndarray, b: np.ndarray):
        self.contexts, self.pointers, self.children, self.a, self.b = contexts, pointers, children, a, b

    @classmethod
    def build(cls, context: np.ndarray, word: np.ndarray, a: np.ndarray, b: np.ndarray) -> Trie:
        """Of (context, word) in sorted order; ``b`` has a value for each distinct context."""
        distinct, starts = np.unique(context, return_index=True)
        ends = np.concatenate((starts[1:], [len(word)])) if len(starts) else starts
        last = word[ends - 1] if len(ends) else np.zeros(0, np.uint64)
        base = np.concatenate((np.zeros(1, np.uint64), np.cumsum(last, dtype=np.uint64)))[:-1] if len(last) else last
        children = word + np.repeat(base, ends - starts) if len(word) else word
        return cls(
            EliasFano.build(distinct.astype(np.uint64)),
            EliasFano.build(np.concatenate((starts, [len(word)])).astype(np.uint64)),
            EliasFano.build(children.astype(np.uint64)),
            to_code(a),
            to_code(b),
        )

    def save(self, folder: Path) -> None:
        for name in self.SEQUENCES:
            for part, values in getattr(self, name).arrays().items():
                np.save(folder / f"{name}.{part}.npy", values)
        np.save(folder / "a.npy", self.a)
        np.save(folder / "b.npy", self.b)

    @classmethod
    def load(cls, folder: Path) -> Trie:
        """The saved trie, mapped into memory."""
        read = lambda name: np.load(folder / f"{name}.npy", mmap_mode="r")
        parts = [EliasFano.of({p: read(f"{name}.{p}") for p in ("head", "low", "high", "ones")}) for name in cls.SEQUENCES]
        return cls(*parts, read("a"), read("b"))

    def ask(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of a and b for sorted (context, word); an unknown context leaves all to the shorter one."""
        fresh = np.concatenate((np.ones(min(len(context), 1), bool), context[1:] != context[:-1]))
        own, of = context[fresh], np.cumsum(fresh) - 1
        at = self.contexts.find(own)
        known = np.flatnonzero(at >= 0)
        start, end, base = (np.zeros(len(own), t) for t in (np.int64, np.int64, np.uint64))
        start[known] = self.pointers.get(at[known]).astype(np.int64)
        end[known] = self.pointers.get(at[known] + 1).astype(np.int64)
        later = known[start[known] > 0]
        base[later] = self.children.get(start[later] - 1)
        found = self.children.find(word + base[of], start[of], end[of])
        a = np.full(len(word), NONE, np.uint16)
        a[found >= 0] = self.a[found[found >= 0]]
        b = np.zeros(len(own), np.uint16)
        b[known] = self.b[at[known]]
        return a, b[of]


# ------------------------------------------------------------------- packing


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, bytes of like weight together, compressed."""
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(planes))


def unpack(data: bytes, n: int, *types) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    out, at = [], 0
    for kind in types:
        size = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(raw[at : at + n * size].reshape(size, n).T).view(kind).reshape(n))
        at += n * size
    return out


def gaps(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=np.zeros(1, x.dtype))


# -------------------------------------------------------------------- chunks

_CHUNK = "chunk bigint, n int, docs int, doc_id array<bigint>, held array<boolean>, size array<bigint>, tokens binary"


def chunked(docs: DataFrame, most: int) -> DataFrame:
    """A row for each few megabytes of text: its documents, their words by local number, the words and their training counts."""

    def run(batches):
        task, n = TaskContext.get().partitionId(), 0
        for batch in sliced(batches, most=most):
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            held = np.array(batch.column("held").to_pylist(), bool)
            joined = b"\n".join([*texts, b""]).lower()
            raw = np.frombuffer(joined, np.uint8)
            word = WORD[raw]
            edge = np.diff(np.concatenate(([0], word.view(np.int8), [0])))
            first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            offsets = np.concatenate(([0], np.cumsum(last - first))).astype(np.int64)
            coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(raw[word].tobytes())]).dictionary_encode()
            ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.uint32)
            ends = np.searchsorted(first, np.cumsum([len(t) + 1 for t in texts]))
            size = np.diff(ends, prepend=0)
            seen = np.bincount(ids[~np.repeat(held, size)], minlength=len(coded.dictionary))
            words = coded.dictionary.cast(pa.large_string()).cast(pa.string())
            row = {
                "chunk": [(task << 32) + n],
                "n": [len(ids)],
                "docs": [len(texts)],
                "doc_id": [batch.column("doc_id").to_pylist()],
                "held": [held.tolist()],
                "size": [size],
                "tokens": [pack(ids)],
                "words": pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words),
                "seen": [seen.astype(np.int64)],
            }
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v, k) for v, k in zip(row.values(), kinds)], names=list(row))
            n += 1

    return docs.mapInArrow(run, f"{_CHUNK}, words array<string>, seen array<bigint>")


class Chunk:
    """The tokens of a chunk row as global numbers, an end after each document, and their counts."""

    def __init__(self, row: dict, ends: int):
        ids, counts = unpack(row["names"], row["vocabulary"], np.uint32, np.int64)
        (local,) = unpack(row["tokens"], row["n"], np.uint32)
        size = np.array(row["size"], np.int64)
        stop = np.cumsum(size + 1)
        total = int(stop[-1]) if len(stop) else 0
        is_end = np.zeros(total, bool)
        is_end[stop - 1] = True
        self.token = np.full(total, END, np.uint64)
        self.token[~is_end] = ids[local]
        self.count = np.full(total, ends, np.int64)
        self.count[~is_end] = counts[local]
        self.starts = stop - size - 1
        self.sizes = size + 1
        self.train = np.repeat(~np.array(row["held"], bool), self.sizes)
        self.ends = ends
        # the tokens one and two places before, with begin marks before each text
        self.before1 = np.concatenate(([BEGIN], self.token[:-1])).astype(np.uint64)
        self.before1[self.starts] = BEGIN
        self.before2 = np.concatenate(([BEGIN], self.before1[:-1])).astype(np.uint64)
        self.before2[self.starts] = BEGIN

    def shifted(self, values: np.ndarray, first) -> np.ndarray:
        """Each token's value of the token before it in its text."""
        out = np.concatenate((values[:1], values[:-1]))
        out[self.starts] = first
        return out

    def level2(self):
        """context, word and count of the context at each asked place, and the places."""
        context_count = self.shifted(self.count, self.ends)
        at = np.flatnonzero((self.before1 != UNKNOWN) & (context_count > 0))
        context, word = self.before1[at], self.token[at]
        return at, context, word, context_count[at], (context << np.uint64(32)) | word

    def level3(self, pair: np.ndarray, pair_count: np.ndarray):
        """The same for pairs as contexts; of the pair that ends at a token, ``pair`` is the number and ``pair_count`` how often it occurs."""
        least = LEAST[3]
        context_count = self.shifted(pair_count, self.ends)
        at = np.flatnonzero((self.before1 != UNKNOWN) & (self.before2 != UNKNOWN) & (context_count >= least))
        word = np.where(pair_count[at] >= least, self.token[at], np.uint64(UNKNOWN))
        # two begin marks are the first context, all others are numbered in their order
        number = self.shifted(pair + 1, 0)[at].astype(np.uint64)
        return at, (self.before2[at] << np.uint64(32)) | self.before1[at], word, context_count[at], (number << np.uint64(32)) | word


class Asked:
    """The distinct sequences of a chunk in the order in which they are sent: by shard, context and word."""

    def __init__(self, level, train: np.ndarray, shards: int, hot: int):
        # keys are in the order of context first and word then
        self.at, context, word, context_count, key = level
        one, times, order = distinct(key)
        self.of = np.empty(len(key), np.int64)
        self.of[order] = np.repeat(np.arange(len(one)), times)
        self.context, self.word, self.context_count = context[one], word[one], context_count[one]
        self.seen = np.bincount(self.of, train[self.at], len(one)).astype(np.int64) if len(one) else np.zeros(0, np.int64)
        salt = np.where(self.context_count >= hot, self.word % np.uint64(SALTS) + np.uint64(1), np.uint64(0))
        with np.errstate(over="ignore"):
            self.shard = (mix(mix(self.context) ^ salt) % np.uint64(shards)).astype(np.uint16 if shards <= 1 << 16 else np.int64)
        self.order = np.argsort(self.shard, kind="stable")
        found, cut = np.unique(self.shard[self.order], return_index=True)
        self.parts = dict(zip(found.tolist(), np.split(self.order, cut[1:]))) if len(found) else {}

    def lists(self, level: int, chunk: int):
        for shard, mine in self.parts.items():
            yield level, shard, chunk, len(mine), pack(gaps(self.context[mine]), self.word[mine].astype(np.uint32), self.seen[mine], self.context_count[mine])

    def answered(self, answers: list[dict], length: int, hot: dict[int, float], threshold: int):
        """a, b, count and number of the sequence that ends at each token; where none was asked, 0, 1, 0 and -1."""
        a, b, c = np.zeros(len(self.context)), np.ones(len(self.context)), np.zeros(len(self.context), np.int64)
        for r in answers:
            mine = self.parts[r["shard"]]
            ca, cb, count = unpack(r["data"], r["n"], np.uint16, np.uint16, np.int64)
            a[mine], b[mine], c[mine] = of_code(ca), of_code(cb), count
        for i in np.flatnonzero(self.context_count >= threshold):
            b[i] = hot.get(int(self.context[i]), 1.0)
        out = np.zeros(length), np.ones(length), np.zeros(length, np.int64), np.full(length, -1)
        for values, full in zip((a, b, c, np.arange(len(c))), out):
            full[self.at] = values[self.of]
        return out


_LISTS = "level int, shard int, chunk bigint, n int, data binary"
_ANSWERS = "level int, shard int, chunk bigint, n int, data binary, context bigint, mass double"


def list_batch(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) or [[]] * 5
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary())
    return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["level", "shard", "chunk", "n", "data"])


def answers_of(lists: DataFrame, level: int, hot: int) -> DataFrame:
    """Each shard's trie, built from all lists sent to it, and its answer to each of them.

    Of contexts that are dealt over shards, a row tells what the shard keeps.
    """
    least = LEAST[level]

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        parts = [unpack(r["data"], r["n"], np.uint64, np.uint32, np.int64, np.int64) for r in rows]
        context = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
        word = np.concatenate([p[1] for p in parts]).astype(np.uint64)
        # the lists are sorted, so a stable sort only merges them
        number = np.unique(context, return_inverse=True)[1].astype(np.uint64) if level > 2 else context
        order = np.argsort((number << np.uint64(32)) | word, kind="stable")
        context, word = context[order], word[order]
        fresh = np.concatenate(([True], (context[1:] != context[:-1]) | (word[1:] != word[:-1])))
        first = np.flatnonzero(fresh)
        place = np.cumsum(fresh) - 1
        seen = np.add.reduceat(np.concatenate([p[2] for p in parts])[order], first)
        context, word = context[first], word[first]
        of_context = np.concatenate([p[3] for p in parts])[order][first]
        kept = (seen >= least) & (word != UNKNOWN)
        share = (seen - DISCOUNT) / of_context
        starts = np.flatnonzero(np.concatenate(([True], context[kept][1:] != context[kept][:-1]))) if kept.any() else np.zeros(0, np.int64)
        mass = np.add.reduceat(share[kept], starts) if len(starts) else np.zeros(0)
        trie = Trie.build(context[kept], word[kept], share[kept], np.maximum(1 - mass, 0))
        with tempfile.TemporaryDirectory() as folder:
            trie.save(Path(folder))
            a, b = Trie.load(Path(folder)).ask(context, word)
        back = np.empty(len(order), np.int64)
        back[order] = place
        out, at = [], 0
        for r in rows:
            mine = back[at : at + r["n"]]
            at += r["n"]
            out.append((level, r["shard"], r["chunk"], r["n"], pack(a[mine], b[mine], seen[mine]), None, None))
        dealt = of_context[kept][starts] >= hot
        out += [(level, rows[0]["shard"], -1, 0, None, c, m) for c, m in zip(context[kept][starts][dealt].astype(np.int64).tolist(), mass[dealt].tolist())]
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.float64())
        return pa.table([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)], names=["level", "shard", "chunk", "n", "data", "context", "mass"])

    return lists.groupBy("shard").applyInArrow(run, _ANSWERS)


def hot_weights(answers: DataFrame, level: int) -> dict[int, float]:
    """b of the contexts that are dealt over shards: at most ``HOT_SHARE`` of them."""
    rows = answers.where("chunk = -1").where(F.col("level") == level).groupBy("context").agg(F.sum("mass").alias("mass")).collect()
    return {r.context & (1 << 64) - 1: max(0.0, 1 - r.mass) for r in rows}


class Buckets:
    """Tables that are bucketed by chunk, so that what comes to a chunk meets it where it lies."""

    def __init__(self, scratch: Scratch):
        self.scratch, self.spark = scratch, scratch.spark
        self.count = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        atexit.register(self.remove)
        self.names: list[str] = []

    def put(self, df: DataFrame) -> DataFrame:
        name = f"ngram_{uuid.uuid4().hex}"
        self.names.append(name)
        df.write.bucketBy(self.count, "chunk").option("path", f"{self.scratch.root}/{name}").saveAsTable(name)
        out = self.spark.table(name)
        out._scratch_path, out._table = f"{self.scratch.root}/{name}", name
        return out

    def drop(self, df: DataFrame) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {df._table}")
        self.scratch.drop(df)

    def beside(self, df: DataFrame):
        return df.repartition(self.count, "chunk").groupBy("chunk")

    def remove(self) -> None:
        if self.spark.sparkContext._jsc is not None:
            for name in self.names:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def score_documents(docs: DataFrame, shard: int = SHARD, chunk: int = CHUNK, hot_least: int = HOT_LEAST) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs``."""
    scratch = Scratch(docs.sparkSession, "ngrams")
    buckets = Buckets(scratch)
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == 0
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held"), F.coalesce("text", F.lit("")).alias("text"))
    chunks = buckets.put(chunked(texts, chunk))
    # every word of every chunk, its number and its count in all training documents
    used = chunks.agg(F.sum(F.size("words")), F.sum("n"), F.sum(F.size(F.filter("held", lambda x: ~x)))).first()
    rows, tokens, ends = (int(x or 0) for x in used)
    parts = max(buckets.count, -(-rows // 2_000_000))
    word = chunks.select("chunk", F.posexplode(F.arrays_zip("words", "seen")).alias("pos", "x")).select("chunk", "pos", F.col("x.words").alias("word"), F.col("x.seen").alias("seen"))
    word = word.withColumn("part", F.pmod(F.xxhash64("word"), F.lit(parts)))
    # both windows use one sort
    in_part, same = Window.partitionBy("part").orderBy("word"), Window.partitionBy("part", "word")
    named = word.select(
        "chunk",
        "pos",
        "part",
        "seen",
        F.dense_rank().over(in_part).alias("rank"),
        F.sum("seen").over(same).alias("count"),
        (~F.lag("word").over(in_part).eqNullSafe(F.col("word"))).alias("head"),
    )
    number = F.col("part") + F.lit(parts) * (F.col("rank") - 1) + FIRST
    named = scratch.put(named.select("chunk", "pos", "seen", "count", "head", F.when(F.col("count") > 0, number).otherwise(F.lit(UNKNOWN)).alias("id")))
    counted = named.agg(F.sum("seen"), F.count_if(F.col("head") & (F.col("count") > 0)), F.max(F.when(F.col("count") > 0, F.col("id")))).first()
    train, vocabulary = int(counted[0] or 0) + ends, int(counted[1] or 0) + (ends > 0)
    if int(counted[2] or 0) >= UNKNOWN - 1:
        raise ValueError("too many distinct words to number")
    unit = math.log10(train + ADD * (vocabulary + 1))

    def name(key, left: pa.Table, right: pa.Table) -> pa.Table:
        at = right.column("pos").to_numpy()
        ids, counts = np.zeros(len(at), np.uint32), np.zeros(len(at), np.int64)
        ids[at], counts[at] = right.column("id").to_numpy().astype(np.uint32), right.column("count").to_numpy()
        return left.append_column("vocabulary", pa.array([len(at)] * len(left), pa.int32())).append_column("names", pa.array([pack(ids, counts)] * len(left), pa.binary()))

    plain = chunks.drop("words", "seen")
    both = plain.groupBy("chunk").cogroup(buckets.beside(named.select("chunk", "pos", "id", "count")))
    coded = buckets.put(both.applyInArrow(name, f"{_CHUNK}, vocabulary int, names binary"))
    buckets.drop(chunks)
    scratch.drop(named)
    shards = max(1, -(-tokens // shard))
    hot = max(hot_least, train // HOT_SHARE)

    def pairs(batches):
        for batch in batches:
            for row in batch.to_pylist():
                c = Chunk(row, ends)
                yield from list_batch(list(Asked(c.level2(), c.train, shards, hot).lists(2, row["chunk"]))).to_batches()

    two = scratch.put(answers_of(coded.mapInArrow(pairs, _LISTS), 2, hot))
    hot2 = hot_weights(two, 2)

    def triples(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            c = Chunk(row, ends)
            _, _, count, pair = Asked(c.level2(), c.train, shards, hot).answered(right.to_pylist(), len(c.token), hot2, hot)
            out += Asked(c.level3(pair, count), c.train, shards, hot).lists(3, row["chunk"])
        return list_batch(out)

    to_chunk = lambda answers: buckets.beside(answers.where("chunk >= 0").select("level", "shard", "chunk", "n", "data"))
    lists = coded.groupBy("chunk").cogroup(to_chunk(two)).applyInArrow(triples, _LISTS)
    three = scratch.put(answers_of(lists, 3, hot))
    hot3 = hot_weights(three, 3)

    def score(key, left: pa.Table, right: pa.Table) -> pa.Table:
        answers = right.to_pylist()
        tables = []
        for row in left.to_pylist():
            c = Chunk(row, ends)
            length = len(c.token)
            a2, b2, count, pair = Asked(c.level2(), c.train, shards, hot).answered([r for r in answers if r["level"] == 2], length, hot2, hot)
            a3, b3, _, _ = Asked(c.level3(pair, count), c.train, shards, hot).answered([r for r in answers if r["level"] == 3], length, hot3, hot)
            base = np.log10(c.count + ADD) - unit
            p = a3 + b3 * (a2 + b2 * (c.count + ADD) / (train + ADD * (vocabulary + 1)))
            tables.append(
                pa.table(
                    {
                        "doc_id": pa.array(row["doc_id"], pa.int64()),
                        "held_out": pa.array(row["held"], pa.bool_()),
                        "n_tokens": pa.array(c.sizes, pa.int64()),
                        "n_known": pa.array(np.add.reduceat(c.count > 0, c.starts, dtype=np.int64), pa.int64()),
                        "base_score": pa.array(np.add.reduceat(base, c.starts), pa.float64()),
                        "score": pa.array(np.add.reduceat(np.log10(p), c.starts), pa.float64()),
                    }
                )
            )
        return pa.concat_tables(tables)

    found = coded.groupBy("chunk").cogroup(to_chunk(two.unionByName(three))).applyInArrow(
        score, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    )
    return found.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(train).cast("long").alias("train_tokens"), "base_score", "score")
