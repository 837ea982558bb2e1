"""Phrase collocations by best-first branch and bound over growing prefixes.

Phrases of 2 to ``LONGEST`` words inside a piece of text are candidates if they occur ``LEAST``
times. A cut into a first part that occurs l times and a rest that occurs r times gives
floor(``FACTOR`` * a / (l + r)); the lowest-scoring cut counts. A candidate is dropped if a longer one
that holds it occurs at least ``COVER`` percent as often, and each language's first ``TOP`` stay.

No phrase grown from a prefix of count a, whose first word occurs l times, can score more than
floor(``FACTOR`` * a / (l + a)): it occurs at most a times and its rest at least as often as itself. So
prefixes are a frontier ordered by that bound. A round takes, for each language, the frontier down to a
threshold, grows it by one word at a time, and counts what it needs to decide: the
phrases grown from it, the neighbours on the left of candidates at or above the threshold, and the rests of
four-word phrases that may reach it. If at least ``TOP`` candidates survive at or above the
threshold, every better phrase and every tie is known and the language is settled; the others go on with
a lower threshold, taken from the next ranks of their two-word phrases and in the end 0.

Only the next longer candidates can drop one: a phrase of more words that holds it holds one of these, which
occurs at least as often.

A counting pass reads the texts, numbers the words of a few megabytes exactly, and sends one row for each
distinct phrase it wants. Which phrases a pass wants is told by bit sets of hashed
phrases of at most ``2 ** FILTER_BITS`` bits, the only thing sent to all tasks; a false hit is one more exact count
and changes no result. Counts are summed by Spark, so frequent words are combined before any shuffle.

A null text is empty and a null language is ``und``. Texts without words add nothing. Repeated rows count
as often as they stand there; ids are not read. Texts beyond a few megabytes are cut at piece
marks, which no phrase crosses. Without candidates the result is empty.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, distinct, mix, sliced

LEAST = 30
LONGEST = 4
FACTOR = 2_000_000
COVER = 80
TOP = 2000
#: The first threshold is the score of this many times ``TOP`` two-word phrases.
GUESS = 2
CHUNK = 4 << 20
FILTER_BITS = 25
SALTS = 64

MARK = re.compile(rb"[.,;:!?\x0A-\x0D]")
SPACE, BREAK = 1, 2
CLASS = np.zeros(256, np.uint8)
CLASS[[0x20, 0x09]] = SPACE
CLASS[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = BREAK


def hash_bytes(values: list[bytes]) -> np.ndarray:
    return pd.util.hash_array(np.array([*values, b""], object)[:-1], categorize=False)


def extended(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase one word longer."""
    with np.errstate(over="ignore"):
        return mix(h * np.uint64(0x9E3779B97F4A7C15) + word)


class Chunk:
    """The words of some texts as numbers, with their pieces and languages."""

    def __init__(self, langs: list[str], texts: list[bytes]):
        # a line end keeps texts apart
        joined = b"\n".join([*texts, b""]).lower()
        raw = np.frombuffer(joined, np.uint8)
        kind = CLASS[raw]
        word = kind == 0
        edge = np.diff(np.concatenate(([0], word.view(np.int8), [0])))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        offsets = np.concatenate(([0], np.cumsum(last - first))).astype(np.int64)
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(raw[word].tobytes())])
        coded = words.dictionary_encode()
        self.words = coded.dictionary
        self.ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.piece = np.cumsum(kind == BREAK)[first] if len(first) else np.zeros(0, np.int64)
        self.langs = sorted(set(langs))
        number = {x: i for i, x in enumerate(self.langs)}
        ends = np.cumsum([len(t) + 1 for t in texts])
        of_text = np.array([number[x] for x in langs], np.int64)
        self.lang = of_text[np.searchsorted(ends, first, side="right")] if len(first) else np.zeros(0, np.int64)
        self.word_hash = hash_bytes(self.words.to_pylist())
        self.lang_hash = hash_bytes([x.encode("utf-8", "surrogatepass") for x in self.langs])

    def starts(self, n: int) -> np.ndarray:
        """Where a phrase of ``n`` words begins that lies inside one piece."""
        size = len(self.ids) - n + 1
        return np.flatnonzero(self.piece[:size] == self.piece[n - 1 :]) if size > 0 else np.zeros(0, np.int64)

    def hashes(self, at: np.ndarray, n: int) -> np.ndarray:
        h = self.lang_hash[self.lang[at]]
        for i in range(n):
            h = extended(h, self.word_hash[self.ids[at + i]])
        return h

    def counted(self, at: np.ndarray, n: int) -> pa.RecordBatch:
        """lang, phrase and how often it begins at one of ``at``."""
        code, size, most = self.lang[at], max(len(self.langs), 1), max(len(self.words), 1)
        for i in range(n):
            if size * most >= 1 << 62:
                code = np.unique(code, return_inverse=True)[1]
                size = len(at)
            code, size = code * most + self.ids[at + i], size * most
        one, times, _ = distinct(code)
        spot = at[one]
        words = [self.words.take(pa.array(self.ids[spot + i])) for i in range(n)]
        phrase = pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.large_binary())) if n > 1 else words[0]
        lang = pa.array(self.langs, pa.string()).take(pa.array(self.lang[spot]))
        return pa.RecordBatch.from_arrays([lang, phrase.cast(pa.large_string()).cast(pa.string()), pa.array(times.astype(np.int64))], names=["lang", "phrase", "a"])


def chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[Chunk]:
    """Texts of about ``most`` bytes at a time; longer ones are cut at a mark."""
    for batch in sliced(batches, most=most):
        langs = batch.column("lang").to_pylist()
        texts = batch.column("text").cast(pa.large_binary()).to_pylist()
        if len(texts) > 1 or len(texts[0]) <= most:
            yield Chunk(langs, texts)
            continue
        text, start = texts[0], 0
        while start < len(text):
            found = MARK.search(text, start + most)
            end = found.end() if found else len(text)
            yield Chunk(langs, [text[start:end]])
            start = end


class Test(NamedTuple):
    """Whether the ``size`` words at ``offset`` of a phrase hit a bit set."""

    offset: int
    size: int
    bits: np.ndarray

    def hits(self, chunk: Chunk, at: np.ndarray) -> np.ndarray:
        if self.size == 1 and len(chunk.langs) <= 8:
            # single words: asked once for each word and language
            known = np.stack([member(self.bits, extended(h, chunk.word_hash)) for h in chunk.lang_hash])
            return known[chunk.lang[at], chunk.ids[at + self.offset]]
        return member(self.bits, chunk.hashes(at + self.offset, self.size))


def member(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    place = h >> np.uint64(64 - (len(bits) * 8).bit_length() + 1)
    return (bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def count_phrases(docs: DataFrame, n: int, every: list[Test] = [], some: list[Test] = [], least: int = LEAST, most: int = CHUNK) -> DataFrame:  # noqa: B006
    """lang, phrase, a: the phrases of ``n`` words that occur ``least`` times and pass all of ``every`` and one of ``some``.

    For single words, the phrase '' counts all words of its language.
    """

    def run(batches):
        for chunk in chunks(batches, most):
            at = chunk.starts(n)
            for test in every:
                at = at[test.hits(chunk, at)]
            if some:
                hit = np.zeros(len(at), bool)
                for test in some:
                    hit |= test.hits(chunk, at)
                at = at[hit]
            if len(at):
                yield chunk.counted(at, n)
                if n == 1:
                    total = np.bincount(chunk.lang, minlength=len(chunk.langs))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(chunk.langs, pa.string()), pa.array([""] * len(total)), pa.array(total.astype(np.int64))], names=["lang", "phrase", "a"]
                    )

    found = docs.mapInArrow(run, "lang string, phrase string, a bigint")
    return found.groupBy("lang", "phrase").agg(F.sum("a").alias("a")).where((F.col("a") >= least) | (F.col("phrase") == ""))


def bit_set(phrases: DataFrame, filter_bits: int = FILTER_BITS) -> np.ndarray:
    """Bits at the hashes of (lang, phrase), about sixteen for each, at most ``2 ** filter_bits``.

    Tasks send distinct places; a block of bits is made in one task, so what the driver
    gathers is the bit set itself.
    """
    rows = phrases.count()
    bits = max(15, min(filter_bits, (16 * rows).bit_length()))
    block = 1 << 15

    def place(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = [p.encode("utf-8", "surrogatepass").split(b" ") for p in batch.column("phrase").to_pylist()]
            h = hash_bytes([x.encode("utf-8", "surrogatepass") for x in batch.column("lang").to_pylist()])
            for i in range(max(map(len, parts))):
                mine = np.array([len(p) > i for p in parts])
                h[mine] = extended(h[mine], hash_bytes([p[i] for p in parts if len(p) > i]))
            at = np.unique(h >> np.uint64(64 - bits)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at // block), pa.array(at % block)], names=["block", "at"])

    def pack(pdf):
        mine = np.zeros(block // 8, np.uint8)
        at = pdf["at"].to_numpy()
        np.bitwise_or.at(mine, at >> 3, (1 << (at & 7)).astype(np.uint8))
        return pd.DataFrame({"block": [int(pdf["block"].iloc[0])], "bytes": [mine.tobytes()]})

    out = np.zeros((1 << bits) // 8, np.uint8)
    if rows:
        places = phrases.select("lang", "phrase").mapInArrow(place, "block bigint, at bigint").distinct()
        for r in places.groupBy("block").applyInPandas(pack, "block bigint, bytes binary").collect():
            out[r.block * block // 8 : (r.block + 1) * block // 8] = np.frombuffer(r.bytes, np.uint8)
    return out


def score_of(a: Column, both: Column) -> Column:
    """floor(FACTOR * a / both), exact beyond 64 bits."""
    return F.call_function("div", F.lit(FACTOR).cast("decimal(18,0)") * a.cast("decimal(20,0)"), both.cast("decimal(20,0)"))


def cuts(phrases: DataFrame, known: DataFrame) -> DataFrame:
    """lang, phrase, a, k, l, r: a row for each cut, with null for parts that are not in ``known``."""
    words = F.split("phrase", " ")
    cut = phrases.select("lang", "phrase", "a", words.alias("_w"), F.explode(F.sequence(F.lit(1), F.size(words) - 1)).alias("k"))
    part = cut.select(
        "lang",
        "phrase",
        "a",
        "k",
        F.concat_ws(" ", F.slice("_w", 1, F.col("k"))).alias("_first"),
        F.concat_ws(" ", F.slice("_w", F.col("k") + 1, F.lit(LONGEST))).alias("_rest"),
    )
    for name, count in (("_first", "l"), ("_rest", "r")):
        part = part.join(known.select("lang", F.col("phrase").alias(name), F.col("a").alias(count)), ["lang", name], "left")
    return part


def scored(phrases: DataFrame, known: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, score of the lowest cut, ``_top`` (the bound of what grows from the phrase) and ``whole``.

    ``whole`` is false if a part's count is not known; the score is then that of the other cuts, which
    is an upper bound.
    """
    cut = cuts(phrases, known)
    score = F.when(F.col("l").isNotNull() & F.col("r").isNotNull(), score_of(F.col("a"), F.col("l") + F.col("r")))
    cut = cut.withColumn("_score", score)
    found = cut.groupBy("lang", "phrase", "a").agg(
        F.min(F.when(F.col("_score").isNotNull(), F.struct("_score", "k", "l", "r"))).alias("_low"),
        F.max(F.when(F.col("k") == 1, F.col("l"))).alias("_l1"),
        F.bool_and(F.col("_score").isNotNull()).alias("whole"),
    )
    return found.select(
        "lang", "phrase", "a", F.col("_low.l").alias("l"), F.col("_low.r").alias("r"), F.col("_low._score").alias("score"), score_of(F.col("a"), F.col("_l1") + F.col("a")).alias("_top"), "whole"
    )


def first_of(rows: DataFrame, count: Column | int, order: list[Column]) -> DataFrame:
    """``rank`` and the first ``count`` rows of each language; ranked in parts first, so no task holds a language whole."""
    part = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    some = rows.withColumn("_part", part).withColumn("_rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order)))
    few = some.where(F.col("_rank") <= count).drop("_part", "_rank")
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= count)


def best_first() -> list[Column]:
    return [F.desc("score"), F.desc("a"), F.asc("phrase")]


def thresholds(pairs: DataFrame, langs: DataFrame, rank: int) -> DataFrame:
    """lang and ``t``, the score of its two-word phrase of that rank, or 0; below the last ``t`` if there is one."""
    at = first_of(pairs, rank, best_first()).where(F.col("rank") == rank).select("lang", F.col("score").alias("_t"))
    found = langs.join(at, "lang", "left").withColumn("_t", F.coalesce("_t", F.lit(0).cast("long")))
    if "t" in langs.columns:
        return found.select("lang", F.least("_t", F.col("t") - 1).alias("t"))
    return found.select("lang", F.col("_t").alias("t"))


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST, cover: int = COVER, guess: int = GUESS, filter_bits: int = FILTER_BITS, chunk: int = CHUNK) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's first ``top`` phrases."""
    scratch = Scratch(docs.sparkSession, "collocations")
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    count = lambda n, every=(), some=(): scratch.put(count_phrases(texts, n, list(every), list(some), least, chunk))
    bits = lambda phrases: bit_set(phrases, filter_bits)
    singles = count(1)
    totals = singles.where("phrase = ''").select("lang", F.col("a").alias("n"))
    words = singles.where("phrase <> ''")
    frequent = bits(words)
    pairs = scratch.put(scored(count(2, [Test(0, 1, frequent), Test(1, 1, frequent)]), words))
    joined = bits(pairs)
    todo = scratch.put(thresholds(pairs, totals.select("lang"), guess * top))
    columns = ["lang", "phrase", "a", "l", "r", "score"]
    done, rank = None, guess * top
    while True:
        open_pairs = scratch.put(pairs.join(todo, "lang"))
        grown = [Test(0, 2, bits(open_pairs.where("_top >= t"))), Test(1, 2, bits(open_pairs.where("score >= t")))]
        inside = [Test(i, 2, joined) for i in range(LONGEST - 1)]
        triples = count(3, inside[:2], grown)
        known = words.unionByName(pairs.select("lang", "phrase", "a"))
        threes = scratch.put(scored(triples, known).join(todo, "lang"))
        grown = [Test(0, 3, bits(threes.where("_top >= t"))), Test(1, 3, bits(threes.where("score >= t")))]
        fours = count(4, inside, grown)
        known = known.unionByName(triples)
        best = scratch.put(scored(fours, known).join(todo, "lang").where("score >= t"))
        # rests nobody asked for yet, of phrases whose other cuts reach the threshold; a prefix that
        # was not counted has a bound below it
        rest = F.substring_index("phrase", " ", -3)
        first = F.substring_index("phrase", " ", 3)
        open_fours = best.where("not whole").withColumn("_f", first)
        open_fours = open_fours.join(triples.select("lang", F.col("phrase").alias("_f")), ["lang", "_f"], "left_semi")
        asked = open_fours.select("lang", rest.alias("phrase")).distinct()
        asked = scratch.put(asked.join(triples, ["lang", "phrase"], "left_anti"))
        if not asked.isEmpty():
            more = count(3, inside[:2], [Test(0, 3, bits(asked))])
            known = known.unionByName(more.join(triples, ["lang", "phrase"], "left_anti"))
            again = scored(open_fours.select("lang", "phrase", "a"), known).join(todo, "lang")
            best = scratch.put(best.where("whole").unionByName(again.where("score >= t")))
        reached = open_pairs.unionByName(threes).unionByName(best).where("whole and score >= t").select(*columns)
        # the next longer phrases, by what is left when their first or last word goes
        longer = triples.unionByName(fours)
        inner = F.array(F.regexp_replace("phrase", " [^ ]*$", ""), F.regexp_replace("phrase", "^[^ ]* ", ""))
        cover_of = longer.select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("_a")).groupBy("lang", "phrase").agg(F.max("_a").alias("_a"))
        left = reached.join(cover_of, ["lang", "phrase"], "left").where(F.col("_a").isNull() | (F.col("_a").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * cover))
        found = scratch.put(first_of(left.drop("_a"), top, best_first()))
        enough = found.groupBy("lang").agg(F.max("rank").alias("_have"))
        state = scratch.put(todo.join(enough, "lang", "left").withColumn("_settled", (F.col("t") <= 0) | (F.coalesce("_have", F.lit(0)) >= top)))
        settled = found.join(state.where("_settled").select("lang"), "lang", "left_semi")
        done = settled if done is None else done.unionByName(settled)
        unsettled = state.where("not _settled").select("lang", "t")
        if unsettled.isEmpty():
            break
        rank *= 4
        todo = scratch.put(thresholds(pairs, unsettled, rank))
    return done.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
