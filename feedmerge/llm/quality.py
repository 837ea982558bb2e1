"""Quality by compression: which of two zstandard dictionaries shortens a text more.

One dictionary is built from labelled good text and one from labelled bad text. A
text is cut into blocks of ``BLOCK`` bytes, every block is compressed with both,
and the sizes are summed over the whole text. The difference of the two sizes,
divided by their sum, is the evidence; a logistic calibration, which also sees how
far the text shrinks and how long it is, turns it into the probability of label 1.

The fit reads at most ``per_class`` labelled documents of each class and at most
``FIT_BYTES`` of their text for a dictionary; scoring reads every whole text. Half of the
sample builds the dictionaries, the other half fits the calibration, so the
calibration sees sizes as unseen text gives them.

Null and empty texts have the features of an empty text and get its calibrated
score. Without labels of both classes every score is 0.5. Rows with equal ids are
scored one by one; other columns pass through ``score_quality``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, in_one_task, label_share, labelled_sample, logistic, with_columns

PER_CLASS = 2500
FIT_BYTES = 6 << 20
DICT_BYTES = 64 << 10
BLOCK = 512
LEVEL = 3
THRESHOLD = 0.7


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    kind = zstandard.ZstdCompressionDict(content)
    kind.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=kind, write_content_size=False, write_checksum=False, write_dict_id=False)


def sizes(text: str | None, good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> tuple[int, int, int]:
    """Bytes of the text, and of its blocks under each dictionary."""
    data = (text or "").encode("utf-8", "surrogatepass")
    a = b = 0
    for i in range(0, len(data), BLOCK):
        block = data[i : i + BLOCK]
        a += len(good.compress(block))
        b += len(bad.compress(block))
    return len(data), a, b


def features(measured: np.ndarray) -> np.ndarray:
    """Evidence, shrinkage and length of rows (bytes, size with good, size with bad)."""
    raw, a, b = measured.T.astype(float)
    evidence = (b - a) / np.maximum(a + b, 1)
    blocks = np.ceil(raw / BLOCK)
    shrunk = np.minimum(a, b) / np.maximum(raw, 1)
    long = np.log1p(raw) / 8
    signed = np.sign(evidence) * np.sqrt(np.abs(evidence))
    return np.column_stack([np.ones(len(raw)), evidence * 10, signed * 3, evidence * 10 * long, shrunk, shrunk**2, long, long**2, blocks == 0])


def _dictionary(texts: list[str]) -> bytes:
    pieces, total = [], 0
    for text in texts:
        data = text.encode("utf-8", "surrogatepass")
        for i in range(0, len(data), BLOCK):
            if total < FIT_BYTES:
                pieces.append(data[i : i + BLOCK])
                total += len(pieces[-1])
    try:
        return zstandard.train_dictionary(DICT_BYTES, pieces, k=256, d=8, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: use it as it is
        return b"".join(pieces)[-DICT_BYTES:] or b" " * 8


def fit_local(texts: list[str], y: np.ndarray, prior: float) -> QualityModel | None:
    """Fit on a bounded sample; ``prior`` is the share of label 1 among all labels."""
    order = np.arange(len(y))
    build, rest = order[order % 2 == 0], order[order % 2 == 1]
    if len(set(y[build])) < 2 or len(set(y[rest])) < 2:
        build = rest = order
    if len(set(y)) < 2:
        return None
    good = _dictionary([texts[i] for i in build if y[i] == 1])
    bad = _dictionary([texts[i] for i in build if y[i] == 0])
    pair = _compressor(good), _compressor(bad)
    measured = np.array([sizes(texts[i], *pair) for i in rest])
    return QualityModel(good, bad, tuple(logistic(features(measured), y[rest], prior)))


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> QualityModel | None:
    """Fit in one task over the bounded sample; only the small model reaches the driver."""
    sample = labelled_sample(docs, labels, label, per_class)
    prior = label_share(labels, label)
    if prior is None:
        return None

    def run(pdf):
        import pandas as pd

        pdf = pdf.sort_values(["doc_id", "text"])
        model = fit_local(list(pdf["text"]), pdf["label"].to_numpy(), prior)
        rows = [] if model is None else [(model.good, model.bad, [float(w) for w in model.weights])]
        return pd.DataFrame(rows, columns=["good", "bad", "weights"])

    one = in_one_task(sample, run, "good binary, bad binary, weights array<double>")
    row = one.first()
    return None if row is None else QualityModel(bytes(row.good), bytes(row.bad), tuple(row.weights))


def score_quality(docs: DataFrame, model: QualityModel | None, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1), ``bytes``, ``bytes_good`` and ``bytes_bad``."""

    def make():
        pair = None if model is None else (_compressor(model.good), _compressor(model.bad))
        weights = None if model is None else np.array(model.weights)

        def work(batch):
            texts = batch.column(text).to_pylist()
            if model is None:
                return {"score": [0.5] * len(texts), **{c: [None] * len(texts) for c in ("bytes", "bytes_good", "bytes_bad")}}
            measured = np.array([sizes(t, *pair) for t in texts])
            value = 1 / (1 + np.exp(-np.clip(features(measured) @ weights, -30, 30)))
            return {"score": value, "bytes": measured[:, 0], "bytes_good": measured[:, 1], "bytes_bad": measured[:, 2]}

        return work

    return with_columns(docs, "score double, bytes bigint, bytes_good bigint, bytes_bad bigint", make, text)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The contract's columns for every row of ``docs``."""
    model = fit_quality(docs, labels)
    return score_quality(docs.select("doc_id", "text"), model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "bytes",
        "bytes_good",
        "bytes_bad",
    )
