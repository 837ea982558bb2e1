"""Language by unigram pieces, summed over all segmentations of every word.

A public vocabulary of byte pieces is fixed. Each language has a probability for
every piece, fitted by expectation maximisation over all segmentations of its
words. A word's probability under a language is the sum over its segmentations,
found by the forward algorithm, and a text is scored by the product over all its
words. The prediction is the language with the highest posterior.

Words are runs of letters, lower case, each with a leading space. All pieces of the
vocabulary take part and no word is cut when it is scored: long words, as scripts without
spaces have them, are summed in a window that rolls over them. A text that is
null or has no letter is ``und`` with score 0. Ties go to the first language in
code point order. With no language to learn from everything is ``und``.

Every language of the training fold is learned, each by itself from about ``per_language`` of
its documents, and of them the ``FIT_WORDS`` most frequent word forms, in parts of at most
``FIT_BYTES`` bytes. Scoring reads every whole text;
it knows ``SLICE`` languages at a time, and with more of them the texts are read once for each slice.
Repeated rows count in the sample as often as they stand there.
"""

from __future__ import annotations

import base64
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmerge.session import broadcast_within

from .common import Scratch, WordCache, held_out, with_columns

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
PER_LANGUAGE = 400
#: Languages that one pass over the texts scores, so that what a task holds is bounded.
SLICE = 64
#: With more languages the sample is drawn by a shuffle join in place of a broadcast.
MOST_LANGUAGES = 100_000
#: Largest vocabulary file, as its pieces go to every task.
MOST_BYTES = 16 << 20
#: The fit reads longer words in parts of this size; scores never cut a word.
FIT_BYTES = 64
#: Longer words are summed in a rolling window that is rescaled as it goes.
LONG = 64
#: Bytes of a long word whose pieces are looked up at once.
BLOCK = 1 << 15
#: Cells of the lattice held at once.
CELLS = 1 << 22
ROUNDS = 3
SMOOTH = 0.1
#: Factor for each byte that keeps products of piece probabilities in range.
LIFT = 32.0

WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Lower-case runs of letters; numerals that are no digits, as fractions are, are no letters."""
    found = WORD.findall(text.lower())
    if text.isascii() or all(map(str.isalpha, found)):
        return found
    return [w for run in found for w in "".join(c if c.isalpha() else " " for c in run).split()]


#: Most frequent word forms of a language's sample that the fit reads.
FIT_WORDS = 60_000

STEP = np.uint64(0x100000001B3)


def read_vocabulary(path: str = VOCABULARY) -> list[bytes]:
    """All pieces of a rank file, and every single byte.

    The file is read on the driver, where the path is; its size is checked, as
    the pieces travel with the tasks.
    """
    with open(path, "rb") as file:
        data = file.read(MOST_BYTES + 1)
    if len(data) > MOST_BYTES:
        raise ValueError(f"the vocabulary {path} is larger than {MOST_BYTES} bytes")
    lines = data.splitlines()
    pieces = {base64.b64decode(line.split()[0]) for line in lines if line.strip()}
    singles = {bytes([b]) for b in range(256)}
    return sorted({p for p in pieces if p} | singles)


def encoded(word: str) -> bytes:
    return b" " + word.encode("utf-8", "surrogatepass")


class Segmenter:
    """Finds the pieces that begin at each byte of many words at once."""

    def __init__(self, pieces: list[bytes]):
        self.pieces = pieces
        self.lengths = np.array([0] + [len(p) for p in pieces])
        self.longest = int(self.lengths.max())
        self.by_length = []
        for n in range(1, self.longest + 1):
            ids = np.flatnonzero(self.lengths == n).astype(np.int32)
            rows = np.frombuffer(b"".join(pieces[i - 1] for i in ids), np.uint8).reshape(-1, n)
            key = self._hash(rows)[:, 0] if len(ids) else np.zeros(0, np.uint64)
            order = np.argsort(key)
            self.by_length.append((key[order], ids[order]))

    @staticmethod
    def _extend(h: np.ndarray, byte: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (h ^ (byte.astype(np.uint64) + np.uint64(1))) * STEP + np.uint64(0x9E3779B9)

    def _hash(self, rows: np.ndarray) -> np.ndarray:
        h = np.zeros((len(rows), 1), np.uint64)
        for j in range(rows.shape[1]):
            h = self._extend(h, rows[:, j : j + 1])
        return h

    def lattice(self, rows: np.ndarray) -> np.ndarray:
        """ids[w, i, n-1]: the piece of n bytes at byte i of word w, 0 if there is none."""
        n, width = rows.shape
        most = min(self.longest, width)
        found = np.zeros((n, width, most), np.int32)
        h = np.zeros((n, width), np.uint64)
        for size in range(1, most + 1):
            last = width - size + 1
            h = self._extend(h[:, :last], rows[:, size - 1 :])
            keys, ids = self.by_length[size - 1]
            if not len(keys):
                continue
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            found[:, :last, size - 1] = np.where(keys[at] == h, ids[at], 0)
        return found

    def groups(self, words: list[bytes]):
        """Words of one length at a time: their positions and their bytes, a row a word."""
        length = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(length, kind="stable")
        cuts = np.flatnonzero(np.diff(length[order])) + 1
        for part in np.split(order, cuts):
            if not len(part):
                continue
            width = int(length[part[0]])
            most = max(1, CELLS // (min(width, BLOCK) * min(width, self.longest)))
            for i in range(0, len(part), most):
                some = part[i : i + most]
                data = np.frombuffer(b"".join(words[j] for j in some), np.uint8)
                yield some, data.reshape(len(some), width)

    def log_sums(self, rows: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Log of the summed probability of all segmentations of each word, as ``table`` is lifted."""
        if rows.shape[1] <= LONG:
            with np.errstate(divide="ignore"):
                return np.log(forward(self.lattice(rows), table)[:, -1])
        return self._rolled(rows, table)

    def _rolled(self, rows: np.ndarray, table: np.ndarray) -> np.ndarray:
        """``log_sums`` of words of any length: sums are kept for as many bytes as a piece has."""
        n, width = rows.shape
        slots = self.longest + 1
        ring = np.zeros((slots, n, table.shape[1]))
        ring[0] = 1
        logs = np.zeros((n, table.shape[1]))
        for start in range(0, width, BLOCK):
            ids = self.lattice(rows[:, start : start + BLOCK + self.longest - 1])[:, :BLOCK]
            sizes = [np.flatnonzero(k) + 1 for k in ids.any(axis=0)]
            for j, some in enumerate(sizes):
                i = start + j
                here = ring[i % slots]
                for size in some:
                    # row 0 of the table is 0: words without such a piece add nothing
                    ring[(i + size) % slots] += here * table[ids[:, j, size - 1]]
                here[:] = 0
                if i % LONG == LONG - 1:
                    top = ring.max(axis=0)
                    ring /= top
                    logs += np.log(top)
        return logs + np.log(ring[width % slots])


def forward(ids: np.ndarray, table: np.ndarray) -> np.ndarray:
    """alpha[w, i]: summed probability of all segmentations of the first i bytes."""
    n, width, _ = ids.shape
    alpha = np.zeros((n, width + 1, table.shape[1]))
    alpha[:, 0] = 1
    for i in range(1, width + 1):
        for size in range(1, min(ids.shape[2], i) + 1):
            piece = ids[:, i - size, size - 1]
            hit = np.flatnonzero(piece)
            if 2 * len(hit) > n:
                alpha[:, i] += alpha[:, i - size] * table[piece]
            elif len(hit):
                alpha[hit, i] += alpha[hit, i - size] * table[piece[hit]]
    return alpha


def backward(ids: np.ndarray, table: np.ndarray) -> np.ndarray:
    n, width, _ = ids.shape
    beta = np.zeros((n, width + 1, table.shape[1]))
    beta[:, width] = 1
    for i in range(width - 1, -1, -1):
        for size in range(1, min(ids.shape[2], width - i) + 1):
            piece = ids[:, i, size - 1]
            hit = np.flatnonzero(piece)
            if len(hit):
                beta[hit, i] += table[piece[hit]] * beta[hit, i + size]
    return beta


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    pieces: list[bytes]
    #: log probability of each piece (row 0: no piece) under each language
    logp: np.ndarray


def lifted(model_p: np.ndarray, seg: Segmenter) -> np.ndarray:
    return model_p * (LIFT ** seg.lengths)[:, None]


def fit_local(counts: dict[str, np.ndarray], seg: Segmenter, n_languages: int) -> np.ndarray:
    """Piece probabilities by expectation maximisation. counts: word -> its count by language."""
    total: dict[bytes, np.ndarray] = {}
    for word, seen in counts.items():
        data = encoded(word)
        for i in range(0, len(data), FIT_BYTES):
            part = data[i : i + FIT_BYTES]
            total[part] = total[part] + seen if part in total else seen
    words = sorted(total, key=lambda w: (-total[w].sum(), w))[:FIT_WORDS]
    weight = np.array([total[w] for w in words]).reshape(len(words), n_languages)
    n = len(seg.lengths)
    # begin with what the pieces' lengths allow, then let the text decide
    p = np.repeat((0.02 ** (1 / np.maximum(seg.lengths, 1)))[:, None], n_languages, axis=1)
    p[0] = 0
    p /= p.sum(axis=0)
    for _ in range(ROUNDS):
        expected = np.zeros((n, n_languages))
        table = lifted(p, seg)
        for some, rows in seg.groups(words):
            ids = seg.lattice(rows)
            alpha, beta = forward(ids, table), backward(ids, table)
            scale = weight[some] / alpha[:, -1]
            for size in range(1, ids.shape[2] + 1):
                for i in range(ids.shape[1] - size + 1):
                    piece = ids[:, i, size - 1]
                    hit = np.flatnonzero(piece)
                    if len(hit):
                        share = alpha[hit, i] * table[piece[hit]] * beta[hit, i + size] * scale[hit]
                        for k in range(n_languages):
                            expected[:, k] += np.bincount(piece[hit], share[:, k], n)
        p = expected + SMOOTH
        p[0] = 0
        p /= p.sum(axis=0)
    return p


def fit_languages(
    docs: DataFrame, vocabulary: str = VOCABULARY, per_language: int = PER_LANGUAGE, seed: int = 7, most: int = SLICE
) -> Iterator[LanguageModel]:
    """Models of at most ``most`` languages each, in code point order, that cover the languages of the training fold.

    Each language is fitted in a task of its own; held-out rows are never read.
    """
    train = docs.where("text is not null and lang is not null").where(~held_out(F.col("doc_id"))).select("doc_id", "lang", "text")
    # rows without an id are told apart by their texts
    position = F.pmod(F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("text")), F.lit(seed)), F.lit(1 << 20)) / F.lit(1 << 20)
    placed = train.select("lang", "text", position.alias("_at"))
    # a language whose few ids all lie high is read from its lowest on
    seen = placed.groupBy("lang").agg(F.greatest(F.lit(per_language) / F.count(F.lit(1)), F.min("_at") + F.lit(1e-9)).alias("_share"))
    # a row for each language, sent to all tasks while they are few, so that only the sample is grouped
    sample = placed.join(broadcast_within(seen, MOST_LANGUAGES), "lang").where("_at < _share").select("lang", "text")
    pieces = read_vocabulary(vocabulary)

    def run(pdf):
        import pandas as pd

        words = Counter()
        for text in pdf["text"]:
            words.update(words_of(text))
        p = fit_local({w: np.array([n], float) for w, n in words.items()}, Segmenter(pieces), 1)
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "p": [p[:, 0].astype(np.float64).tobytes()]})

    scratch = Scratch(docs.sparkSession, "langid")
    fitted = scratch.put(sample.groupBy("lang").applyInPandas(run, "lang string, p binary"))
    languages = sorted(r.lang for r in fitted.select("lang").collect())
    for k in range(0, len(languages), most):
        some = languages[k : k + most]
        columns = {r.lang: np.frombuffer(r.p) for r in fitted.where(F.col("lang").between(some[0], some[-1])).collect()}
        with np.errstate(divide="ignore"):
            yield LanguageModel(some, pieces, np.log(np.stack([columns[x] for x in some], axis=1)))
    scratch.drop(fitted)


def word_scores(seg: Segmenter, logp: np.ndarray):
    """A function from words to log probabilities under each language."""
    table = lifted(np.exp(logp), seg)

    def compute(words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), table.shape[1]))
        for some, rows in seg.groups([encoded(w) for w in words]):
            out[some] = seg.log_sums(rows, table) - rows.shape[1] * np.log(LIFT)
        return out

    return compute


def scored(docs: DataFrame, model: LanguageModel, text: str) -> DataFrame:
    """Adds the best language ``_lang`` of the model, its log probability ``_top``, and ``_sum``, that of all as multiples of the best."""

    def make():
        cache = WordCache(word_scores(Segmenter(model.pieces), model.logp))

        def work(batch):
            words = [words_of(t) if t else [] for t in batch.column(text).to_pylist()]
            size = np.fromiter(map(len, words), np.int64, len(words))
            values = cache.values([w for some in words for w in some])
            total = np.concatenate((np.zeros((1, values.shape[1])), np.cumsum(values, axis=0)))
            end = np.cumsum(size)
            logs = total[end] - total[end - size]
            best = logs.argmax(axis=1)
            top = logs.max(axis=1)
            return {
                "_lang": [model.languages[b] if n else None for b, n in zip(best, size)],
                "_top": top,
                "_sum": np.exp(logs - top[:, None]).sum(axis=1),
            }

        return work

    return with_columns(docs, "_lang string, _top double, _sum double", make, text)


def identify(docs: DataFrame, models: Iterator[LanguageModel] | None = None, text: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of ``docs``."""
    scratch = Scratch(docs.sparkSession, "langid")
    names = ["_lang", "_top", "_sum"]
    out, put = None, None
    for model in fit_languages(docs) if models is None else models:
        if out is None:
            out = scored(docs.select("doc_id", text), model, text)
            continue
        # the texts go along, as ids need not tell rows apart
        before = scratch.put(out)
        if put is not None:
            scratch.drop(put)
        put = before
        old = before.select("doc_id", text, *(F.col(c).alias(f"{c}_0") for c in names))
        better = F.col("_top") > F.col("_top_0")
        far = F.exp(-F.abs(F.col("_top") - F.col("_top_0")))
        out = scored(old, model, text).select(
            "doc_id",
            text,
            F.when(better, F.col("_lang")).otherwise(F.col("_lang_0")).alias("_lang"),
            F.greatest("_top", "_top_0").alias("_top"),
            F.when(better, F.col("_sum") + F.col("_sum_0") * far).otherwise(F.col("_sum_0") + F.col("_sum") * far).alias("_sum"),
        )
    if out is None:
        out = docs.select("doc_id", *(F.lit(None).cast(t).alias(c) for c, t in zip(names, ("string", "double", "double"))))
    score = F.when(F.col("_lang").isNull(), F.lit(0.0)).otherwise(1 / F.col("_sum"))
    return out.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.coalesce("_lang", F.lit("und")).alias("lang_pred"), score.alias("score")
    )
