"""Quality classifier: logistic regression on hashed word n-grams, fitted by follow-the-regularised-leader.

A text is a run of words (ASCII letters lower-cased) and of sign runs between them. Its features are the
hashed single tokens and pairs of neighbours, a pair of equal tokens being one feature of its own; a feature's
value is its share of all n-grams. A score is a sparse dot product and a logistic.

Null and empty texts have no n-grams and score by the bias alone. Ties, repeated rows and extra columns change
nothing: each row is scored by its text. An empty table gives no rows; without labels every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stumpline.llm import bytescan
from stumpline.llm.common import bounded_batches, labelled_sample, per_batch, remainder

BITS = 20
#: Labelled rows used for fitting, at most.
FIT_ROWS = 8_000
ACCEPT = 0.3
_SCALE = 32.0
_CHUNK = 1 << 22


@dataclass(frozen=True)
class Model:
    bias: float
    weights: np.ndarray


def ngrams(texts: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every n-gram of the texts."""
    data, offsets = bytescan.utf8(texts)
    data = bytescan.lower(data)
    starts, ends, row = bytescan.spans(data, offsets, bytescan.WORD_OR_SIGN)
    one = bytescan.hashes(data, starts, ends)
    same_row = row[1:] == row[:-1]
    a, b = one[:-1][same_row], one[1:][same_row]
    two = np.where(a == b, np.uint64(1), bytescan.mixed(a, b))
    mask = np.uint64((1 << bits) - 1)
    return (np.concatenate([one, two]) & mask).astype(np.int32), np.concatenate([row, row[1:][same_row]])


def _features(batch: pa.RecordBatch) -> pa.RecordBatch:
    bucket, row = ngrams(batch.column("_text"))
    order = np.argsort(row, kind="stable")
    cut = np.searchsorted(row[order], np.arange(batch.num_rows + 1))
    ids, shares = [], []
    for i in range(batch.num_rows):
        found, n = np.unique(bucket[order[cut[i] : cut[i + 1]]], return_counts=True)
        ids.append(found.tobytes())
        shares.append((n * (_SCALE / max(1, n.sum()))).astype(np.float32).tobytes())
    return pa.record_batch([batch.column("_order"), batch.column("_label"), pa.array(ids, pa.binary()), pa.array(shares, pa.binary())], names=["_order", "_label", "ids", "shares"])


def fit_leader(
    rows: list[tuple[np.ndarray, np.ndarray, int]], bits: int = BITS, epochs: int = 3, alpha: float = 0.5, beta: float = 1.0, l1: float = 1e-3, l2: float = 1e-3
) -> Model:
    """Follow-the-regularised-leader over (buckets, values, label) rows, per-coordinate steps; the last slot is the bias."""
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def weights(at: np.ndarray) -> np.ndarray:
        zi = z[at]
        return -np.sign(zi) * np.maximum(np.abs(zi) - l1, 0) / ((beta + np.sqrt(n[at])) / alpha + l2)

    for _ in range(epochs):
        for ids, values, label in rows:
            at, x = np.append(ids, 1 << bits), np.append(values, 1.0)
            w = weights(at)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - label) * x
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    w = weights(np.arange(len(z)))
    return Model(float(w[-1]), w[:-1].astype(np.float32))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", fit_rows: int = FIT_ROWS) -> Model:
    """Fit on at most about ``fit_rows`` labelled rows outside the held-out fold, in one task; the model has a fixed size."""
    bounded_batches(docs.sparkSession)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for b in batches:
            for ids, shares, y in zip(b.column("ids").to_pylist(), b.column("shares").to_pylist(), b.column("_label").to_pylist(), strict=True):
                rows.append((np.frombuffer(ids, np.int32), np.frombuffer(shares, np.float32), y))
        model = fit_leader(rows)
        at = np.flatnonzero(model.weights)
        yield pa.record_batch([pa.array([model.bias]), pa.array([at.astype(np.int32).tobytes()]), pa.array([model.weights[at].tobytes()])], names=["bias", "ids", "weights"])

    sample = labelled_sample(docs, labels, label, fit_rows)
    rows = sample.select("_order", "_label", "_text").mapInArrow(per_batch(_features), "_order long, _label int, ids binary, shares binary")
    got = rows.repartition(1).sortWithinPartitions("_order", "_label", "ids").mapInArrow(fit, "bias double, ids binary, weights binary").first()
    weights = np.zeros(1 << BITS, np.float32)
    if got is None:
        return Model(0.0, weights)
    weights[np.frombuffer(got.ids, np.int32)] = np.frombuffer(got.weights, np.float32)
    return Model(got.bias, weights)


def score_array(texts: pa.Array, model: Model) -> np.ndarray:
    bucket, row = ngrams(texts)
    total = np.bincount(row, weights=model.weights[bucket], minlength=len(texts))
    n = np.bincount(row, minlength=len(texts))
    return 1 / (1 + np.exp(-np.clip(model.bias + _SCALE * total / np.maximum(1, n), -30, 30)))


def with_score(docs: DataFrame, model: Model, column: str) -> DataFrame:
    """``docs`` with one more column, the score of ``text``; only the text goes through Python."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def quality(texts: pa.Array) -> pa.Array:
        return pa.array(score_array(texts, shared.value))

    return docs.withColumn(column, quality("text"))


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row."""
    found = with_score(docs.select("doc_id", "text"), train(docs, labels), "score")
    return found.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", F.when(F.col("score") >= ACCEPT, 1).otherwise(0).alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score ``ACCEPT`` or more, trained on the labelled ones among them."""
    name = "__stumpline_quality"
    return with_score(docs, train(docs, labels), name).filter(F.col(name) >= ACCEPT).drop(name)
