"""Language identification: a convolutional network on bytes, trained in numpy and applied to fixed-length windows.

A text is cut into windows of ``WINDOW`` bytes (ASCII letters lower-cased, the last one padded). Bytes have
embeddings; filters of several widths slide over a window, each keeps its largest rectified response, and a softmax
over these gives the window's languages. A text's languages are the mean of its windows', each weighted by its bytes.
All windows of a text count. For scoring, embeddings and filters are folded into tables of byte pairs, so that a
response is two table rows.

The net learns from at most about ``FIT_ROWS`` rows with a text and a language outside the held-out fold, from up to
``FIT_WINDOWS`` windows of each, spaced evenly over the whole text; a text of an id that is repeated counts once.
Classes are the languages of these rows, however many. Null texts and texts without a letter are ``und`` with score
0, and so is everything where nothing can be learned. Ties go to the first language in order. Repeated rows and extra
columns change nothing; an empty table gives no rows. Very long texts are scored block by block.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stumpline.llm import bytescan
from stumpline.llm.common import bounded_batches, per_batch, remainder

WINDOW = 256
DIM = 8
WIDTHS = (2, 3, 4)
FILTERS = 16
#: Labelled rows used for fitting, and windows of each, at most.
FIT_ROWS = 6_000
FIT_WINDOWS = 4
STEPS = 900
UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2
_BLOCK = 64
_PAD = max(WIDTHS) - 1


@dataclass
class Net:
    langs: list[str]
    byte: np.ndarray  # (256, DIM); row 0 is zero, for places beyond a text
    conv: list[np.ndarray]  # for each width (width, DIM, FILTERS)
    shift: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    def folded(self) -> tuple[np.ndarray, np.ndarray]:
        """Responses to the first and to the second pair of bytes of a place: two tables (65536, all filters)."""
        alone = np.zeros((4, 256, len(WIDTHS) * FILTERS), np.float32)
        for k, w in enumerate(self.conv):
            for j in range(len(w)):
                alone[j][:, k * FILTERS : (k + 1) * FILTERS] = self.byte @ w[j]
        pair = lambda a, b: (a[:, None] + b[None]).reshape(1 << 16, -1)
        return pair(alone[0], alone[1]) + self.shift, pair(alone[2], alone[3])


def windows(texts: pa.Array, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, and start, length and row of every window; an empty text has none."""
    data, offsets = bytescan.utf8(texts)
    count = -(-np.diff(offsets) // size)
    row = np.repeat(np.arange(len(count)), count)
    start = offsets[row] + size * (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count))
    return bytescan.lower(data), start, np.minimum(size, offsets[row + 1] - start), row


def cut(data: np.ndarray, start: np.ndarray, length: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """Windows as a matrix of bytes with zeros after their end and ``_PAD`` more."""
    at = np.arange(size + _PAD)
    inside = at < length[:, None]
    return np.where(inside, data[np.where(inside, start[:, None] + at, 0)], 0).astype(np.uint8)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _largest(net: Net, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest rectified response of each filter in each window, and its place; ``x`` holds embeddings."""
    places = x.shape[1] - _PAD
    tops, where = [], []
    for k, w in enumerate(net.conv):
        z = sum(x[:, j : j + places] @ w[j] for j in range(len(w)))
        at = z.argmax(1)
        tops.append(np.take_along_axis(z, at[:, None], 1)[:, 0] + net.shift[k * FILTERS : (k + 1) * FILTERS])
        where.append(at)
    return np.maximum(np.concatenate(tops, 1), 0), np.concatenate(where, 1)


def fit_net(seen: np.ndarray, label: np.ndarray, langs: list[str], steps: int = STEPS, batch: int = 64, rate: float = 0.01) -> Net:
    """Train on a matrix of windows by Adam; gradients flow through the place of each largest response."""
    rng = np.random.default_rng(11)
    noise = lambda scale, *shape: rng.normal(0, scale, shape).astype(np.float32)
    total = len(WIDTHS) * FILTERS
    net = Net(langs, noise(0.5, 256, DIM), [noise(0.3, w, DIM, FILTERS) for w in WIDTHS], np.zeros(total, np.float32), noise(0.1, total, len(langs)), np.zeros(len(langs), np.float32))
    net.byte[0] = 0
    params = [net.byte, *net.conv, net.shift, net.out, net.bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    order = np.zeros(0, int)
    for step in range(1, steps + 1):
        if len(order) < batch:
            order = np.concatenate([order, rng.permutation(len(seen))])
        some, order = order[:batch], order[batch:]
        win, y = seen[some], label[some]
        x = net.byte[win]
        top, where = _largest(net, x)
        err = _softmax(top @ net.out + net.bias)
        err[np.arange(len(y)), y] -= 1
        err /= len(y)
        g_top = (err @ net.out.T) * (top > 0)
        grads = [np.zeros_like(p) for p in params]
        grads[-1], grads[-2], grads[-3] = err.sum(0), top.T @ err, g_top.sum(0)
        b = np.arange(len(y))[:, None]
        for k, w in enumerate(net.conv):
            g, at = g_top[:, k * FILTERS : (k + 1) * FILTERS], where[:, k * FILTERS : (k + 1) * FILTERS]
            for j in range(len(w)):
                grads[1 + k][j] = np.einsum("bf,bfd->df", g, x[b, at + j])
                np.add.at(grads[0], win[b, at + j], g[:, :, None] * w[j].T)
        grads[0][0] = 0
        pace = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for p, m, v, g in zip(params, first, second, grads, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)
    return net


def _fit_rows(docs: DataFrame, rows: int) -> DataFrame:
    """``_order``, ``lang`` and ``text`` of about ``rows`` ids that may be learned from, one row for each."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder("doc_id", FOLDS) != HELD_OUT))
    order = F.xxhash64("doc_id", F.lit("language")).alias("_order")
    known = known.select(order, F.col("lang").cast("string").alias("lang"), "text")
    there = known.select("_order").count()
    if there > rows:
        known = known.filter(F.pmod("_order", F.lit(1_000_000)) < max(1, int(1e6 * rows / there)))
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "lang", "text")).alias("r")
    return known.groupBy("_order").agg(one).select("_order", "r.lang", "r.text")


def train(docs: DataFrame, fit_rows: int = FIT_ROWS) -> Net | None:
    """Fit in one task, on a bounded sample; None without rows to learn from."""
    bounded_batches(docs.sparkSession)

    def spread(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, start, length, row = windows(batch.column("text"))
        cells = []
        for i in range(batch.num_rows):
            lo, hi = np.searchsorted(row, [i, i + 1])
            few = lo + (np.arange(min(hi - lo, FIT_WINDOWS)) * (hi - lo)) // max(1, min(hi - lo, FIT_WINDOWS))
            cells.append(cut(data, start[few], length[few]).tobytes())
        return pa.record_batch([batch.column("_order"), batch.column("lang"), pa.array(cells, pa.binary())], names=["_order", "lang", "seen"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, langs = [], []
        for batch in batches:
            for lang, cell in zip(batch.column("lang").to_pylist(), batch.column("seen").to_pylist(), strict=True):
                mine = np.frombuffer(cell, np.uint8).reshape(-1, WINDOW + _PAD)
                seen.append(mine)
                langs += [lang] * len(mine)
        if langs:
            names, label = np.unique(np.array(langs, object), return_inverse=True)
            yield pa.record_batch([pa.array([pickle.dumps(fit_net(np.concatenate(seen), label, names.tolist()))])], names=["net"])

    cells = _fit_rows(docs, fit_rows).select("_order", "lang", "text").mapInArrow(per_batch(spread), "_order long, lang string, seen binary")
    got = cells.repartition(1).sortWithinPartitions("_order", "lang", "seen").mapInArrow(fit, "net binary").first()
    return None if got is None else pickle.loads(got.net)


def shares(texts: pa.Array, net: Net, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Probability of each language for each text; zeros for an empty one."""
    data, start, length, row = windows(texts)
    out = np.zeros((len(texts), len(net.langs)))
    for i in range(0, len(row), _BLOCK):
        some = slice(i, i + _BLOCK)
        win = cut(data, start[some], length[some])
        pair = win[:, :-1].astype(np.int32) << 8 | win[:, 1:]
        z = np.take(tables[0], pair[:, :WINDOW], axis=0)
        z += np.take(tables[1], pair[:, 2:], axis=0)
        top = np.maximum(z.max(1), 0)
        np.add.at(out, row[some], _softmax(top @ net.out + net.bias) * length[some][:, None])
    size = np.bincount(row, weights=length, minlength=len(texts))
    return out / np.maximum(1, size)[:, None]


def predict(docs: DataFrame, net: Net | None, lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with two more columns, the language of ``text`` and its score."""
    if net is None:
        return docs.withColumns({lang: F.lit(UNKNOWN), score: F.lit(0.0)})
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)
    tables: list[tuple[np.ndarray, np.ndarray]] = []

    @F.arrow_udf("struct<lang string, score double>")
    def language(texts: pa.Array) -> pa.Array:
        if not tables:
            tables.append(shared.value.folded())
        p = shares(texts, shared.value, tables[0])
        best = p.argmax(1)
        names = pa.array([shared.value.langs[i] for i in best], pa.string())
        return pa.StructArray.from_arrays([names, pa.array(np.minimum(p[np.arange(len(best)), best], 1.0))], names=["lang", "score"])

    found = "__stumpline_language"
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    marked = docs.withColumn(found, language("text"))
    return marked.withColumns(
        {lang: F.when(lettered, F.col(f"{found}.lang")).otherwise(UNKNOWN), score: F.when(lettered, F.col(f"{found}.score")).otherwise(0.0)}
    ).drop(found)


def scores(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every row."""
    found = predict(docs.select("doc_id", "text"), train(docs))
    return found.select("doc_id", (remainder("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")
