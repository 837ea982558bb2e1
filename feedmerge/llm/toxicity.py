"""Toxic spans by a linear-chain conditional random field over tokens.

Tokens are runs of letters and digits, lower case. Documents carry labels, tokens
do not, so token labels are derived first: a word or word beginning that toxic
training documents hold far more often than clean ones is an indicator, and the
indicators' tokens in toxic documents are the labelled tokens. On windows of those
documents a two-state field is fitted by maximum likelihood; a token's features are
its hashed form, beginnings, ending and neighbours. Forward-backward gives each token
of a text its marginal probability of lying in a toxic span.

A document's evidence is the sum of its marginals of at least ``FLOOR``, alone and
for its length, its two highest marginals and its number of tokens. A logistic
calibration, fitted on sample documents the field has not seen, turns them into the
score. Offending offsets are the spans of consecutive tokens with a marginal of at
least one half, in code points.

The fit reads at most ``per_class`` labelled documents of each class, and windows of them; scoring
reads every whole text. Null and empty texts, and texts without a token, score 0.
Without labels of both classes every score is 0. Rows with equal ids are scored one
by one.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordCache, held_out, in_one_task, label_share, labelled_sample, logistic, with_columns

PER_CLASS = 2000
THRESHOLD = 0.3
FLOOR = 0.02
WINDOW = 48
WINDOWS = 3
MASK = (1 << 18) - 1
ROUNDS = 30
BLOCK = 64

TOKEN = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class ToxicityModel:
    #: one weight for each hashed feature
    weights: np.ndarray
    #: start[y] and move[y, y'], log scale
    start: np.ndarray
    move: np.ndarray
    #: calibration of the document score
    document: np.ndarray


def lowered(text: str) -> str:
    """Lower case at the same positions; the few letters with longer lower forms stay."""
    lower = text.lower()
    if len(lower) != len(text):
        lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    return lower


def own_features(word: str) -> list[int]:
    """Hashed features of a token by itself."""
    b = word.encode("utf-8", "surrogatepass")
    return [
        crc32(b"w " + b) & MASK,
        crc32(b"4 " + b[:4]) & MASK,
        crc32(b"5 " + b[:5]) & MASK,
        crc32(b"6 " + b[:6]) & MASK,
        crc32(b"8 " + b[:8]) & MASK,
        crc32(b"bias") & MASK,
    ]


def neighbour_features(word: str) -> list[int]:
    """Hashed features that a token lends to the token after it and before it."""
    b = word.encode("utf-8", "surrogatepass")
    return [crc32(b"p " + b) & MASK, crc32(b"n " + b) & MASK]


def indicators_of(word: str) -> tuple[str, ...]:
    """The forms by which a word may announce toxicity: itself and its beginnings."""
    return ("=" + word, *(word[:n] for n in (4, 5, 6) if len(word) > n))


def distinct(tokens: list[list[str]]) -> list[int]:
    """Positions of texts that share few of their rarest word triples with earlier ones.

    Copies of one text would otherwise make all of its words look telling.
    """
    seen: set[int] = set()
    kept = []
    for i, words in enumerate(tokens):
        triples = {crc32(" ".join(words[j : j + 3]).encode("utf-8", "surrogatepass")) for j in range(max(1, len(words) - 2))}
        low = sorted(triples)[:8]
        if sum(h in seen for h in low) * 2 < len(low):
            kept.append(i)
        seen.update(low)
    return kept


def indicators(tokens: list[list[str]], y: np.ndarray, least: float = 3.0, evidence: float = 9.2) -> set[str]:
    """Forms that toxic documents hold e**least times as often as clean ones.

    A form must also be too frequent among them for chance: the Chernoff bound on
    its share of toxic documents has to lie below e**-evidence.
    """
    seen = (Counter(), Counter())
    for words, label in zip(tokens, y):
        seen[label].update({f for w in set(words) for f in indicators_of(w)})
    toxic, clean = max(1, int(y.sum())), max(1, int((y == 0).sum()))
    base = toxic / (toxic + clean)
    found = set()
    for f, n in seen[1].items():
        c = seen[0][f]
        ratio = math.log((n + 0.5) / toxic) - math.log((c + 0.5) / clean)
        if ratio > least:
            chance = n * math.log(n / (n + c) / base)
            if c:
                chance += c * math.log(c / (n + c) / (1 - base))
            if chance > evidence:
                found.add(f)
    return found


def windows(tokens: list[list[str]], y: np.ndarray, known: set[str], rng: np.random.Generator):
    """Windows of tokens with token labels: around indicators, and at random in clean texts."""
    for words, label in zip(tokens, y):
        if not words:
            continue
        if label:
            marks = [i for i, w in enumerate(words) if any(f in known for f in indicators_of(w))]
            hit = set(marks)
            centres = [marks[i] for i in rng.permutation(len(marks))[:WINDOWS]]
        else:
            hit, centres = set(), [rng.integers(0, len(words))]
        for c in centres:
            a = max(0, int(c) - WINDOW // 2)
            b = min(len(words), a + WINDOW)
            yield words[a:b], [int(i in hit) for i in range(a, b)]


def chain(scores: np.ndarray, first: np.ndarray, start: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Marginal probability of state 1 for many texts laid end to end.

    ``scores`` is the log weight of state 1 against state 0, ``first`` marks the
    first token of a text. A text's first step has the same row for both states, so
    nothing flows between texts. The steps are cut into blocks: their 2 x 2 products
    are scanned one after another, and inside blocks all go forward at once.
    """
    n = len(scores)
    if not n:
        return np.zeros(0)
    pad = -n % BLOCK
    s = np.exp(np.clip(np.concatenate((scores, np.zeros(pad))), -30, 30)).reshape(-1, BLOCK)
    f = np.concatenate((first, np.ones(pad, bool))).reshape(-1, BLOCK)
    a, m = np.exp(start), np.exp(move)
    step = np.empty((*s.shape, 2, 2))
    for i in (0, 1):
        for j in (0, 1):
            step[..., i, j] = np.where(f, a[j], m[i, j]) * (s if j else 1.0)
    step /= step.max(axis=(2, 3), keepdims=True)
    blocks = step[:, 0].copy()
    for k in range(1, BLOCK):
        blocks = np.matmul(blocks, step[:, k]) if len(blocks) < 64 else _product(blocks, step[:, k])
        blocks /= blocks.max(axis=(1, 2), keepdims=True)
    rows = blocks.tolist()
    before, x, y = [], 0.5, 0.5
    for (p, q), (r, t) in rows:
        before.append((x, y))
        x, y = x * p + y * r, x * q + y * t
        total = x + y
        x, y = x / total, y / total
    after, x, y = [], 0.5, 0.5
    for (p, q), (r, t) in reversed(rows):
        after.append((x, y))
        x, y = p * x + q * y, r * x + t * y
        total = x + y
        x, y = x / total, y / total
    alpha, beta = np.array(before), np.array(after[::-1])
    forward = np.empty((*s.shape, 2))
    for k in range(BLOCK):
        alpha = np.stack((alpha[:, 0] * step[:, k, 0, 0] + alpha[:, 1] * step[:, k, 1, 0], alpha[:, 0] * step[:, k, 0, 1] + alpha[:, 1] * step[:, k, 1, 1]), axis=1)
        alpha /= alpha.sum(axis=1, keepdims=True)
        forward[:, k] = alpha
    out = np.empty(s.shape)
    for k in range(BLOCK - 1, -1, -1):
        both = forward[:, k] * beta
        out[:, k] = both[:, 1] / both.sum(axis=1)
        beta = np.stack((beta[:, 0] * step[:, k, 0, 0] + beta[:, 1] * step[:, k, 0, 1], beta[:, 0] * step[:, k, 1, 0] + beta[:, 1] * step[:, k, 1, 1]), axis=1)
        beta /= beta.sum(axis=1, keepdims=True)
    return out.reshape(-1)[:n]


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.empty_like(a)
    for i in (0, 1):
        for j in (0, 1):
            out[:, i, j] = a[:, i, 0] * b[:, 0, j] + a[:, i, 1] * b[:, 1, j]
    return out


def fit_local(texts: list[str], y: np.ndarray, prior: float, seed: int = 7) -> ToxicityModel | None:
    """The field on two thirds of the sample, the calibration on the rest."""
    tokens = [TOKEN.findall(lowered(t)) for t in texts]
    kept = distinct(tokens)
    tokens, y = [tokens[i] for i in kept], y[kept]
    rest = np.arange(len(y)) % 3 == 2
    if len(set(y[rest])) < 2 or len(set(y[~rest])) < 2:
        rest[:] = True
    if len(set(y)) < 2:
        return None
    part = lambda mask: [tokens[i] for i in np.flatnonzero(mask)]
    some = rest if rest.all() else ~rest
    weights, start, move = fit_field(part(some), y[some], seed)
    tagger = Tagger(ToxicityModel(weights, start, move, np.zeros(0)))
    p, begin, end = tagger.marginals(part(rest))
    return ToxicityModel(weights, start, move, logistic(evidence_of(p, begin, end), y[rest], prior))


def evidence_of(p: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Calibration features of each text from the marginals of its tokens."""
    found = np.where(p >= FLOOR, p, 0.0)
    total = np.concatenate(([0.0], np.cumsum(found)))
    mass, size = total[end] - total[begin], end - begin
    top = np.zeros((len(size), 2))
    for i in np.flatnonzero(mass > 0):
        high = found[begin[i] : end[i]]
        top[i, : min(2, len(high))] = np.sort(high)[::-1][:2]
    return np.column_stack([np.ones(len(size)), np.log1p(mass), np.minimum(mass, 2), mass / (size + 20) * 50, top, np.log1p(size) / 5])


def fit_field(tokens: list[list[str]], y: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Indicators, labelled windows, then gradient ascent on the field's likelihood."""
    known = indicators(tokens, y)
    made = list(windows(tokens, y, known, np.random.default_rng(seed)))
    count, width = len(made), WINDOW
    index = np.full((count, width, 8), MASK + 1, np.int32)  # the last weight stays 0
    gold, real = np.zeros((count, width), np.int64), np.zeros((count, width), bool)
    forms: dict[str, tuple[list[int], list[int]]] = {}
    for r, (words, labels) in enumerate(made):
        for w in words:
            if w not in forms:
                forms[w] = own_features(w), neighbour_features(w)
        k = len(words)
        index[r, :k, :6] = [forms[w][0] for w in words]
        if k > 1:
            index[r, 1:k, 6] = [forms[w][1][0] for w in words[:-1]]
            index[r, : k - 1, 7] = [forms[w][1][1] for w in words[1:]]
        gold[r, :k], real[r, :k] = labels, True
    weights = np.zeros(MASK + 2)
    start, move = np.array([0.0, -1.0]), np.array([[0.0, -1.0], [0.0, -1.0]])
    squares = [np.full_like(x, 1e-2) for x in (weights, start, move)]
    g_start, g_move = np.zeros(2), np.zeros((2, 2))
    np.add.at(g_start, gold[:, 0], 1)
    inner = real[:, 1:]
    np.add.at(g_move, (gold[:, :-1][inner], gold[:, 1:][inner]), 1)
    for _ in range(ROUNDS):
        score = weights[index].sum(axis=2)
        marginal, pair, first = _expectations(score, real, start, move)
        error = np.where(real, gold - marginal, 0)
        gradient = np.zeros(MASK + 2)
        for k in range(8):
            gradient += np.bincount(index[..., k].ravel(), error.ravel(), MASK + 2)
        gradient[-1] = 0
        for x, g, q, rate, ridge in (
            (weights, gradient, squares[0], 0.5, 0.05),
            (start, g_start - first, squares[1], 0.2, 0.05),
            (move, g_move - pair, squares[2], 0.2, 0.05),
        ):
            g = g - ridge * x
            q += g * g
            x += rate * g / np.sqrt(q)
    return weights.astype(np.float32), start, move


def _expectations(score: np.ndarray, real: np.ndarray, start: np.ndarray, move: np.ndarray):
    """Marginals of state 1, expected moves and expected starts over padded windows."""
    n, width = score.shape
    emit = np.stack((np.ones_like(score), np.exp(np.clip(score, -30, 30))), axis=2)
    m = np.exp(move)
    alpha, beta = np.empty((n, width, 2)), np.ones((n, width, 2))
    alpha[:, 0] = np.exp(start) * emit[:, 0]
    alpha[:, 0] /= alpha[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, width):
        step = (alpha[:, t - 1] @ m) * emit[:, t]
        step /= step.sum(axis=1, keepdims=True)
        alpha[:, t] = np.where(real[:, t : t + 1], step, alpha[:, t - 1])
    pair = np.zeros((2, 2))
    for t in range(width - 1, 0, -1):
        ahead = emit[:, t] * beta[:, t]
        both = alpha[:, t - 1, :, None] * m * ahead[:, None, :]
        both /= both.sum(axis=(1, 2), keepdims=True)
        pair += both[real[:, t]].sum(axis=0)
        back = ahead @ m.T
        back /= back.sum(axis=1, keepdims=True)
        beta[:, t - 1] = np.where(real[:, t : t + 1], back, 1.0)
    both = alpha * beta
    marginal = both[..., 1] / both.sum(axis=2)
    return marginal, pair, np.array([n - marginal[:, 0].sum(), marginal[:, 0].sum()])


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS) -> ToxicityModel | None:
    """Fit in one task over the bounded sample; only the weights reach the driver."""
    sample = labelled_sample(docs, labels, label, per_class)
    prior = label_share(labels, label)
    if prior is None:
        return None

    def run(pdf):
        import pandas as pd

        pdf = pdf.sort_values(["doc_id", "text"])
        model = fit_local(list(pdf["text"]), pdf["label"].to_numpy(), prior)
        rows = [] if model is None else [(model.weights.tobytes(), *([float(x) for x in v.ravel()] for v in (model.start, model.move, model.document)))]
        return pd.DataFrame(rows, columns=["weights", "start", "move", "document"])

    row = in_one_task(sample, run, "weights binary, start array<double>, move array<double>, document array<double>").first()
    if row is None:
        return None
    return ToxicityModel(np.frombuffer(row.weights, np.float32), np.array(row.start), np.array(row.move).reshape(2, 2), np.array(row.document))


class Tagger:
    """Marginals of the tokens of many texts under a fitted field."""

    def __init__(self, model: ToxicityModel):
        self.model = model
        self.weights = model.weights.astype(float)
        self.cache = WordCache(self._of_words)

    def _of_words(self, words: list[str]) -> np.ndarray:
        """Own weight, weight lent to the token after, weight lent to the token before."""
        out = np.zeros((len(words), 3))
        if words:
            out[:, 0] = self.weights[np.array([own_features(w) for w in words])].sum(axis=1)
            out[:, 1:] = self.weights[np.array([neighbour_features(w) for w in words])]
        return out

    def marginals(self, tokens: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One value for each token, and where each text's tokens begin and end."""
        size = np.fromiter(map(len, tokens), np.int64, len(tokens))
        values = self.cache.values([w for some in tokens for w in some])
        end = np.cumsum(size)
        begin = end - size
        first = np.zeros(len(values), bool)
        first[begin[size > 0]] = True
        score = values[:, 0].copy()
        if len(score):
            score[1:] += np.where(first[1:], 0, values[:-1, 1])
            score[:-1] += np.where(first[1:], 0, values[1:, 2])
        return chain(score, first, self.model.start, self.model.move), begin, end


def score_toxicity(docs: DataFrame, model: ToxicityModel | None, text: str = "text") -> DataFrame:
    """``docs`` with ``toxicity`` (0 to 1) and ``toxic_spans``, an array of (start, end, score)."""

    def make():
        tagger = None if model is None else Tagger(model)

        def work(batch):
            texts = batch.column(text).to_pylist()
            if model is None:
                return {"toxicity": [0.0] * len(texts), "toxic_spans": [[] for _ in texts]}
            p, begin, end = tagger.marginals([TOKEN.findall(lowered(t)) if t else [] for t in texts])
            value = 1 / (1 + np.exp(-np.clip(evidence_of(p, begin, end) @ model.document, -30, 30)))
            value[begin == end] = 0
            return {"toxicity": value, "toxic_spans": [spans(t, p[a:b]) for t, a, b in zip(texts, begin, end)]}

        return work

    return with_columns(docs, "toxicity double, toxic_spans array<struct<start:bigint,end:bigint,score:double>>", make, text)


def spans(text: str | None, p: np.ndarray) -> list[dict]:
    """Runs of tokens with a marginal of at least one half, as code point offsets."""
    if not len(p) or p.max() < 0.5:
        return []
    lower = lowered(text)
    out: list[dict] = []
    before = -2
    for i, m in enumerate(TOKEN.finditer(lower)):
        if p[i] >= 0.5:
            if before == i - 1:
                out[-1]["end"] = m.end()
                out[-1]["score"] = max(out[-1]["score"], float(p[i]))
            else:
                out.append({"start": m.start(), "end": m.end(), "score": float(p[i])})
            before = i
    return out


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The contract's columns for every row of ``docs``, and the number of toxic spans."""
    model = fit_toxicity(docs, labels)
    return score_toxicity(docs.select("doc_id", "text"), model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= threshold).cast("int").alias("predicted"),
        F.size("toxic_spans").cast("long").alias("n_spans"),
    )
