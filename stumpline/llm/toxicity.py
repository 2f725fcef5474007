"""Toxicity: a convolutional text classifier in numpy on hashed word embeddings.

A word's embedding is the sum of two table rows, one for the hash of the word and one for the hash of its first
bytes. Filters of several widths slide over the words; each keeps its largest rectified response in the text,
and a logistic layer scores these. The tables start from smoothed log-odds in one dimension and small noise in
the rest, counted over all labelled rows outside the held-out fold. These rows are dealt to shards by hash, a task
trains all parameters by Adagrad on each shard from that start, and the shards' parameters are averaged by their rows;
an embedding is averaged over the shards that moved it. Thresholds per language are calibrated on all fitted rows
and reported beside the score; languages are no input of the score.

Null and empty texts have no words and score by the bias alone. A language that was not seen in fitting takes
the threshold of all rows. Ties, repeated rows and extra columns change nothing; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stumpline.functions.scan import Lag, Running, Total, hot_groups, scan
from stumpline.llm import bytescan
from stumpline.llm.common import bounded_batches, labelled_sample, per_batch, remainder, written

BITS = 17
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
PREFIX_BYTES = 4
#: Labelled rows of a shard, and words of them, on average; as many shards as all rows need.
FIT_ROWS = 8_000
FIT_WORDS = 6_000_000
_PAD = max(WIDTHS) - 1
_BLOCK = 1 << 16


@dataclass
class Net:
    word: np.ndarray  # (2**BITS + 1, DIM); the last row is zero, for places beyond a text
    prefix: np.ndarray
    conv: list[np.ndarray]  # for each width (width, DIM, FILTERS)
    shift: list[np.ndarray]
    out: np.ndarray
    bias: float


def word_ids(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word bucket and prefix bucket of every word, and the number of words of each text."""
    data, offsets = bytescan.utf8(texts)
    data = bytescan.lower(data)
    starts, ends, row = bytescan.spans(data, offsets, bytescan.WORD)
    mask = np.uint64((1 << BITS) - 1)
    whole = bytescan.hashes(data, starts, ends) & mask
    first = bytescan.hashes(data, starts, np.minimum(ends, starts + PREFIX_BYTES)) & mask
    return whole.astype(np.int32), first.astype(np.int32), np.bincount(row, minlength=len(texts))


def _padded(ids: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids with ``_PAD`` zero words after each text, and where each text starts."""
    starts = np.cumsum(count + _PAD) - count - _PAD
    out = np.full(int((count + _PAD).sum()), 1 << BITS, np.int32)
    out[np.arange(len(ids)) + np.repeat(np.arange(len(count)) * _PAD, count)] = ids
    return out, starts


def _responses(net: Net, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Embeddings and rectified responses of every place."""
    x = net.word[a] + net.prefix[b]
    parts = []
    for w, shift in zip(net.conv, net.shift, strict=True):
        z = x @ w[0]
        for j in range(1, len(w)):
            z[:-j] += x[j:] @ w[j]
        parts.append(z + shift)
    z = np.maximum(np.concatenate(parts, axis=1), 0)
    z[a == 1 << BITS] = 0
    return x, z


def features(net: Net, a: np.ndarray, b: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Largest response of each filter in each text; long runs of texts go block by block."""
    out = np.zeros((len(count), len(WIDTHS) * FILTERS), np.float32)
    a, starts = _padded(a, count)
    b, _ = _padded(b, count)
    step = _BLOCK
    for i in range(0, len(a), step):
        x, z = _responses(net, a[i : i + step + _PAD], b[i : i + step + _PAD])
        z = z[:step]
        first = int(np.searchsorted(starts, i, "right")) - 1
        last = int(np.searchsorted(starts, i + len(z), "left"))
        at = np.maximum(starts[first:last] - i, 0)
        out[first:last] = np.maximum(out[first:last], np.maximum.reduceat(z, at, axis=0))
    return out


def bucket_counts(ids: np.ndarray, count: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many texts hold each bucket, and how many of these have label 1."""
    row = np.repeat(np.arange(len(count)), count)
    pairs = np.unique(row.astype(np.int64) << BITS | ids)
    bucket, y = pairs & ((1 << BITS) - 1), label[pairs >> BITS]
    return np.bincount(bucket, minlength=1 << BITS), np.bincount(bucket, weights=y, minlength=1 << BITS)


def log_odds(n: np.ndarray, p: np.ndarray, rows: int, hits: float, prior: float = 10.0) -> np.ndarray:
    """Shrunken log-odds of label 1 for the texts that hold each bucket, of ``rows`` texts with ``hits`` of label 1."""
    base = (hits + 1) / (rows + 2)
    share = (p + prior * base) / (n + prior)
    return np.log(share / (1 - share)) - np.log(base / (1 - base))


def fit_net(
    a: np.ndarray, b: np.ndarray, count: np.ndarray, label: np.ndarray, steps: int = 750, batch: int = 64, rate: float = 0.05,
    odds: tuple[np.ndarray, np.ndarray] | None = None,
) -> Net:
    """Train on texts given as word ids; ``a`` and ``b`` are of all texts, one after another.

    ``odds`` are the log-odds of words and prefixes to start from; by default they are counted in these texts.
    """
    rng = np.random.default_rng(7)
    rows = 1 << BITS
    noise = lambda *shape: rng.normal(0, 0.05, shape).astype(np.float32)
    net = Net(noise(rows + 1, DIM), noise(rows + 1, DIM), [noise(w, DIM, FILTERS) for w in WIDTHS], [np.zeros(FILTERS, np.float32) for _ in WIDTHS], np.full(len(WIDTHS) * FILTERS, 0.1, np.float32), -2.0)
    if odds is None:
        odds = tuple(log_odds(*bucket_counts(ids, count, label), len(label), label.sum()) for ids in (a, b))
    net.word[:-1, 0], net.prefix[:-1, 0] = 0.5 * odds[0], 0.5 * odds[1]
    net.word[-1] = net.prefix[-1] = 0
    for w, width in zip(net.conv, WIDTHS, strict=True):
        w[:, 0, :] += 1.0 / width
    starts = np.cumsum(count) - count
    params = [net.word, net.prefix, *net.conv, *net.shift, net.out]
    seen = [np.full(p.shape, 1e-2, np.float32) for p in params]
    seen_bias = 1e-2
    order = np.zeros(0, int)
    for _ in range(steps):
        if len(order) == 0:
            order = rng.permutation(len(count))
        docs, order = order[:batch], order[batch:]
        if len(docs):
            n = count[docs]
            take = np.repeat(starts[docs] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            pa_, first = _padded(a[take], n)
            pb, _ = _padded(b[take], n)
            x, z = _responses(net, pa_, pb)
            top = np.maximum.reduceat(z, first, axis=0)
            err = 1 / (1 + np.exp(-np.clip(top @ net.out + net.bias, -30, 30))) - label[docs]
            owner = np.repeat(np.arange(len(docs)), n + _PAD)
            # The place of each maximum: the first that reaches it.
            hit_row, hit_col = np.nonzero((z == top[owner]) & (z > 0))
            key = owner[hit_row] * z.shape[1] + hit_col
            key, at = np.unique(key, return_index=True)
            place, doc, col = hit_row[at], key // z.shape[1], key % z.shape[1]
            g_top = (err[doc] * net.out[col] / len(docs)).astype(np.float32)
            grads = [np.zeros_like(p) for p in params[2:]]
            touched: list[np.ndarray] = []
            g_x: list[np.ndarray] = []
            for k, w in enumerate(net.conv):
                mine = (col >= k * FILTERS) & (col < (k + 1) * FILTERS)
                p, c, g = place[mine], col[mine] - k * FILTERS, g_top[mine]
                np.add.at(grads[len(WIDTHS) + k], c, g)
                for j in range(len(w)):
                    np.add.at(grads[k][j].T, c, g[:, None] * x[p + j])
                    touched.append(p + j)
                    g_x.append(g[:, None] * w[j].T[c])
            grads[-1] += (err[:, None] * top).mean(0)
            for p, s, g in zip(params[2:], seen[2:], grads, strict=True):
                s += g * g
                p -= rate * g / np.sqrt(s)
            seen_bias += err.mean() ** 2
            net.bias -= rate * float(err.mean()) / float(np.sqrt(seen_bias))
            if touched and len(place):
                spot, g_all = np.concatenate(touched), np.concatenate(g_x)
                for t, ids in ((0, pa_), (1, pb)):
                    which, back = np.unique(ids[spot], return_inverse=True)
                    g = np.zeros((len(which), DIM), np.float32)
                    np.add.at(g, back, g_all)
                    g[which == rows] = 0
                    seen[t][which] += g * g
                    params[t][which] -= rate * g / np.sqrt(seen[t][which])
    return net


def _probability(net: Net, top: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(top @ net.out + net.bias, -30, 30).astype(np.float64)))


def best_threshold(score: np.ndarray, label: np.ndarray) -> float:
    """The smallest score that gives the best F1; 0.5 when there is only one class."""
    if not 0 < label.sum() < len(label):
        return 0.5
    order = np.argsort(-score, kind="stable")
    hits = np.cumsum(label[order])
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + label.sum())
    f1[:-1][score[order][:-1] == score[order][1:]] = -1  # equal scores stay together
    best = int(np.argmax(f1))
    below = score[order][best + 1] if best + 1 < len(order) else 0.0
    return float((score[order][best] + below) / 2)


def best_thresholds(scored: DataFrame, group: str) -> DataFrame:
    """``group``, ``threshold``: ``best_threshold`` of each group of a table with ``score`` and ``_label``."""
    c = F.col
    per = written(scored.groupBy(group, "score").agg(F.count(F.lit(1)).alias("n"), F.sum("_label").cast("long").alias("p")), "scores")
    hot = hot_groups(per, [group])
    up = scan(per, [group], ["score"], hot, below=Lag(c("score")), rows=Total(c("n")), hits=Total(c("p")))
    down = scan(up, [group], [F.desc("score")], hot, n_above=Running(c("n")), p_above=Running(c("p")))
    f1 = c("p_above") * 2.0 / (c("n_above") + c("hits"))
    middle = (c("score") + F.coalesce("below", F.lit(0.0))) / 2
    best = down.groupBy(group).agg(F.max_by(middle, F.struct(f1, "score")).alias("best"), F.max("rows").alias("rows"), F.max("hits").alias("hits"))
    return best.select(group, F.when((c("hits") > 0) & (c("hits") < c("rows")), c("best")).otherwise(0.5).alias("threshold"))


def fit_ids(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All labelled rows outside the held-out fold as a written table: ``_order``, ``_label``, ``tongue``, ``a``, ``b`` (word ids)."""
    bounded_batches(docs.sparkSession)

    def ids(batch: pa.RecordBatch) -> pa.RecordBatch:
        a, b, count = word_ids(batch.column("_text"))
        cut = np.append(0, np.cumsum(count))
        cells = lambda x: pa.array([x[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:], strict=True)], pa.binary())
        return pa.record_batch([batch.column("_order"), batch.column("_label"), batch.column("tongue"), cells(a), cells(b)], names=["_order", "_label", "tongue", "a", "b"])

    rows = labelled_sample(docs, labels, "toxic", None, extra=("lang",)).select("_order", "_label", F.coalesce("lang", F.lit("")).alias("tongue"), "_text")
    return written(rows.mapInArrow(per_batch(ids), "_order long, _label int, tongue string, a binary, b binary"), "toxic")


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a binary column, and how many each row has."""
    cells = [np.frombuffer(x, np.int32) for x in column.to_pylist()]
    return np.concatenate([np.zeros(0, np.int32), *cells]), np.array([len(x) for x in cells], int)


def _all_odds(fitted: DataFrame, rows: int, hits: float) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of all words and prefixes over all rows; a task adds up its buckets before they are shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 2, 1 << BITS))
        for batch in batches:
            y = batch.column("_label").to_numpy(zero_copy_only=False).astype(float)
            for t, name in enumerate(("a", "b")):
                total[t] += bucket_counts(*_unpacked(batch.column(name)), y)
        for t in range(2):
            at = np.flatnonzero(total[t, 0])
            for i in range(0, len(at), _BLOCK):
                some = at[i : i + _BLOCK]
                yield pa.record_batch([pa.array(np.full(len(some), t)), pa.array(some), pa.array(total[t, 0, some]), pa.array(total[t, 1, some])], names=["t", "bucket", "n", "p"])

    parts = fitted.select("_label", "a", "b").mapInArrow(count, "t long, bucket long, n double, p double")
    got = parts.groupBy("t", "bucket").agg(F.sum("n").alias("n"), F.sum("p").alias("p")).toArrow()
    t, bucket, n, p = (got.column(c).to_numpy() for c in ("t", "bucket", "n", "p"))
    table = np.zeros((2, 2, 1 << BITS))
    table[t, 0, bucket], table[t, 1, bucket] = n, p
    return log_odds(*table[0], rows, hits), log_odds(*table[1], rows, hits)


def _dense(net: Net) -> np.ndarray:
    """All parameters besides the embeddings, in rows of ``DIM``."""
    flat = np.concatenate([*(p.ravel() for p in (*net.conv, *net.shift, net.out)), [net.bias]]).astype(float)
    return np.append(flat, np.zeros(-len(flat) % DIM)).reshape(-1, DIM)


def _set_dense(net: Net, rows: np.ndarray) -> None:
    flat, i = rows.ravel(), 0
    for p in (*net.conv, *net.shift, net.out):
        p[...] = flat[i : i + p.size].reshape(p.shape)
        i += p.size
    net.bias = float(flat[i])


def train(docs: DataFrame, labels: DataFrame, shard_rows: int | None = None, shard_words: int | None = None) -> Net:
    """Fit on all labelled rows outside the held-out fold."""
    return train_shards(fit_ids(docs, labels), shard_rows, shard_words)


def train_shards(fitted: DataFrame, shard_rows: int | None = None, shard_words: int | None = None) -> Net:
    """Fit on all rows of ``fit_ids``: a task for each shard of about ``shard_rows`` rows and ``shard_words`` words, then averaged.

    The driver sees the parameters, whose number is fixed, and no rows.
    """
    spark = fitted.sparkSession
    none = np.zeros(0, np.int32)
    size = fitted.agg(F.count(F.lit(1)).alias("rows"), F.sum("_label").alias("hits"), F.sum(F.length("a")).alias("bytes")).first()
    if not size.rows:
        return fit_net(none, none, np.zeros(0, int), np.zeros(0), steps=0)
    shards = max(1, -(-size.rows // (shard_rows or FIT_ROWS)), -(-size.bytes // 4 // (shard_words or FIT_WORDS)))
    shared = spark.sparkContext.broadcast(_all_odds(fitted, size.rows, float(size.hits)))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(*_unpacked(batch.column("a")), _unpacked(batch.column("b"))[0], batch.column("_label").to_numpy(zero_copy_only=False)) for batch in batches]
        if not parts:
            return
        a, count, b, label = (np.concatenate(x) for x in zip(*parts, strict=True))
        label = label.astype(float)
        start = fit_net(none, none, np.zeros(0, int), np.zeros(0), steps=0, odds=shared.value)
        net = fit_net(a, b, count, label, odds=shared.value)
        for t, (now, was) in enumerate(((net.word, start.word), (net.prefix, start.prefix), (_dense(net), None))):
            at = np.arange(len(now)) if was is None else np.flatnonzero((now != was).any(axis=1))
            for i in range(0, len(at), _BLOCK):
                some = at[i : i + _BLOCK]
                weighed = now[some].astype(float) * len(label)
                yield pa.record_batch(
                    [pa.array(np.full(len(some), t)), pa.array(some), pa.array(np.full(len(some), float(len(label)))), *(pa.array(weighed[:, j]) for j in range(DIM))],
                    names=["t", "at", "w", *(f"v{j}" for j in range(DIM))],
                )

    values = [f"v{j}" for j in range(DIM)]
    dealt = fitted.withColumn("_shard", F.pmod("_order", F.lit(shards)).cast("int")).repartitionById(shards, "_shard").sortWithinPartitions("_order", "_label", "a")
    moved = dealt.select("_label", "a", "b").mapInArrow(fit, f"t long, at long, w double, {', '.join(f'{v} double' for v in values)}")
    got = moved.groupBy("t", "at").agg(F.sum("w").alias("w"), *[F.sum(v).alias(v) for v in values]).toArrow()
    t, at, w = (got.column(c).to_numpy() for c in ("t", "at", "w"))
    mean = np.stack([got.column(v).to_numpy() for v in values], axis=1) / w[:, None]
    net = fit_net(none, none, np.zeros(0, int), np.zeros(0), steps=0, odds=shared.value)
    net.word[at[t == 0]], net.prefix[at[t == 1]] = mean[t == 0], mean[t == 1]
    dense = np.zeros_like(_dense(net))
    dense[at[t == 2]] = mean[t == 2]
    _set_dense(net, dense)
    return net


def score_array(texts: pa.Array, net: Net) -> np.ndarray:
    a, b, count = word_ids(texts)
    return _probability(net, features(net, a, b, count))


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted``, then the language's ``threshold`` and ``flagged`` by it."""
    spark = docs.sparkSession
    bounded_batches(spark)
    fitted = fit_ids(docs, labels)
    shared = spark.sparkContext.broadcast(train_shards(fitted))

    @F.arrow_udf("double")
    def toxicity(texts: pa.Array) -> pa.Array:
        return pa.array(score_array(texts, shared.value))

    @F.arrow_udf("double")
    def again(a: pa.Array, b: pa.Array) -> pa.Array:
        ids, count = _unpacked(a)
        return pa.array(_probability(shared.value, features(shared.value, ids, _unpacked(b)[0], count)))

    seen = written(fitted.select("tongue", "_label", again("a", "b").alias("score")), "fitted")
    # One row for each language of the fitted rows.
    limits = written(best_thresholds(seen, "tongue"), "limits")
    general = best_thresholds(seen.withColumn("all", F.lit(1)), "all").first()
    found = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("tongue"), toxicity("text").alias("score"))
    found = found.join(limits, "tongue", "left").withColumn("threshold", F.coalesce("threshold", F.lit(general.threshold if general else 0.5)))
    return found.select(
        "doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
        "threshold", F.when(F.col("score") >= F.col("threshold"), 1).otherwise(0).alias("flagged"),
    )
