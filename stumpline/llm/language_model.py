"""Language-model scores: smoothed unigram base and a log-bilinear model with two words of context.

All training documents are counted (words by partial sums; classes of word triples into a table of fixed size).
The model's outputs are the most frequent words, the end of a text, and bands of all other words by their first
bytes. A context word's embedding goes through the matrix of its position; the sum meets every output's
embedding and bias. Parameters are fitted in numpy by noise-contrastive estimation on the folded counts, with
the noise's expectation in place of draws, so that every training token counts. Batched matrix products give
the normalised log-probabilities of all contexts. A word of a band has its smoothed share of the band, and each
band keeps the share of one unseen word, so the probabilities of all words sum to one.

Counts of frequent words (``COMMON``, a bounded number) are broadcast; the rest are joined, once per document
and word. Words are told apart by 64-bit hashes.

Null and empty texts are the end token alone. A null id is hashed as empty text. Repeated rows are scored each
on their own; no training documents leave the base formula with zero counts and equal classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stumpline.llm import bytescan
from stumpline.llm.common import bounded_batches, remainder, written

FOLDS = 10
#: Words with counts that are broadcast, at most.
COMMON = 500_000
FREQUENT = 95
BANDS = 32
END = FREQUENT
OUTPUTS = FREQUENT + 1 + BANDS
START = OUTPUTS
STATES = OUTPUTS + 1
DIM = 16
SMOOTH = 0.1
_END_WORD = np.int64(0x0E0D0E0D0E0D0E0D)
_HELD = 2_000_000


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row and band of each word."""
    data, offsets = bytescan.utf8(texts)
    data = bytescan.lower(data)
    starts, ends, row = bytescan.spans(data, offsets, bytescan.NOT_SPACE)
    band = bytescan.hashes(data, starts, np.minimum(ends, starts + 2)) % np.uint64(BANDS)
    return bytescan.hashes(data, starts, ends).view(np.int64), row, band.astype(np.int32)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def merged(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        word, n, band = (np.concatenate(x) for x in zip(*parts, strict=True))
        key, first, back = np.unique(word, return_index=True, return_inverse=True)
        return key, np.bincount(back, weights=n, minlength=len(key)).astype(np.int64), band[first]

    def batch_of(part: tuple) -> pa.RecordBatch:
        return pa.record_batch([pa.array(x) for x in part], names=["word", "n", "band"])

    parts: list[tuple] = []
    for batch in batches:
        word, _, band = _words(batch.column("text"))
        word = np.append(word, np.full(batch.num_rows, _END_WORD))
        band = np.append(band, np.full(batch.num_rows, -1, np.int32))
        parts.append(merged([(word, np.ones(len(word)), band)]))
        if sum(len(p[0]) for p in parts) > _HELD:
            parts = [merged(parts)]
            if len(parts[0][0]) > _HELD // 2:
                yield batch_of(parts.pop())
    if parts:
        yield batch_of(merged(parts))


@dataclass
class Common:
    """Counts and classes of the frequent words, found by hash."""

    word: np.ndarray
    count: np.ndarray
    frequent: np.ndarray  # class, or -1

    def __post_init__(self) -> None:
        self.shift = np.uint64(64 - max(1, (len(self.word) - 1).bit_length()))
        slot = self.word.view(np.uint64) >> self.shift
        self.first = np.searchsorted(slot, np.arange((1 << (64 - int(self.shift))) + 1, dtype=np.uint64))
        self.longest = int(np.diff(self.first).max(initial=0))

    def find(self, words: np.ndarray) -> np.ndarray:
        """Place of each word, -1 if it is not here. Words are sorted as unsigned numbers."""
        out = np.full(len(words), -1, np.int64)
        if not len(self.word):
            return out
        slot = (words.view(np.uint64) >> self.shift).astype(np.int64)
        at, stop = self.first[slot], self.first[slot + 1]
        todo = np.flatnonzero(at < stop)
        for _ in range(self.longest):
            here = at[todo]
            same = self.word[here] == words[todo]
            out[todo[same]] = here[same]
            at[todo] += 1
            todo = todo[~same]
            todo = todo[at[todo] < stop[todo]]
        return out


def _common(counts: DataFrame) -> Common:
    """The most frequent words as far as ``COMMON`` allows, by a histogram of their counts; always the end and the top ones."""
    level = F.when(F.col("n") < 1000, F.col("n")).otherwise((1000 + F.floor(F.log(F.col("n") / 1000.0) * 50)).cast("long"))
    leveled = counts.withColumn("level", level)
    room, floor = COMMON, None
    for r in leveled.groupBy("level").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("level")).collect():
        room -= r.n
        if room < 0:
            break
        floor = r.level
    none = np.zeros(0, np.int64)
    top = counts.filter(F.col("word") != int(_END_WORD)).orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    wanted = F.col("word").isin([int(_END_WORD), *(r.word for r in top)])
    if floor is not None:
        wanted |= F.col("level") >= floor
    rows = leveled.filter(wanted).select("word", "n").toArrow()
    if not rows.num_rows:
        return Common(none, none, none)
    word, n = (rows.column(c).to_numpy() for c in ("word", "n"))
    order = np.argsort(word.view(np.uint64))
    word, n = word[order], n[order]
    frequent = np.full(len(word), -1, np.int64)
    best = np.lexsort((word, -n))
    best = best[word[best] != _END_WORD][:FREQUENT]
    frequent[best] = np.arange(len(best))
    frequent[word == _END_WORD] = END
    return Common(word, n, frequent)


def _contexts(cls: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context and output of every token, the end of each text included, and the text it is in."""
    n = np.bincount(row, minlength=rows)
    last = np.cumsum(n + 1) - 1
    out = np.empty(len(cls) + rows, np.int64)
    out[last] = END
    out[np.arange(len(cls)) + row] = cls
    text = np.repeat(np.arange(rows), n + 1)
    one, two = np.full(len(out), START), np.full(len(out), START)
    one[1:], two[2:] = out[:-1], out[:-2]
    first = last - n
    one[first] = START
    two[first] = START
    two[np.minimum(first + 1, last)] = START
    return two * STATES + one, out, text


def fit_bilinear(counts: np.ndarray, steps: int = 150, noise: int = 25, rate: float = 0.05) -> np.ndarray:
    """Normalised log10 probabilities (contexts x outputs) after noise-contrastive estimation on ``counts``."""
    total = counts.sum()
    share = (counts.sum(0) + SMOOTH) / (total + SMOOTH * OUTPUTS)
    rng = np.random.default_rng(3)
    small = lambda *s: rng.normal(0, 0.1, s)
    context, matrix = small(STATES, DIM), [np.eye(DIM), np.eye(DIM)]
    output, bias = small(OUTPUTS, DIM), np.log(share)
    params = [context, *matrix, output, bias]
    mean, square = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    used = np.flatnonzero(counts.sum(1))
    seen = counts[used] / max(1.0, total)
    weight = noise * seen.sum(1, keepdims=True) * share
    offset = np.log(noise * share)
    old, new = used // STATES, used % STATES
    for t in range(1, steps + 1 if len(used) else 1):
        a, b = context[old], context[new]
        r = a @ matrix[0] + b @ matrix[1]
        real = 1 / (1 + np.exp(-(r @ output.T + bias - offset)))
        g = seen * (1 - real) - weight * real
        g_r = g @ output
        g_context = np.zeros_like(context)
        np.add.at(g_context, old, g_r @ matrix[0].T)
        np.add.at(g_context, new, g_r @ matrix[1].T)
        grads = [g_context, a.T @ g_r, b.T @ g_r, g.T @ r, g.sum(0)]
        step = rate * min(1.0, 2 * (steps - t + 1) / steps)
        for p, m, s, d in zip(params, mean, square, grads, strict=True):
            m += 0.1 * (d - m)
            s += 0.01 * (d * d - s)
            p += step * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-9)
    old, new = np.divmod(np.arange(STATES * STATES), STATES)
    logit = (context @ matrix[0])[old] @ output.T + (context @ matrix[1])[new] @ output.T + bias
    logit -= logit.max(1, keepdims=True)
    return ((logit - np.log(np.exp(logit).sum(1, keepdims=True))) / np.log(10)).astype(np.float32)


@dataclass(frozen=True)
class Model:
    common: Common
    table: np.ndarray
    band_total: np.ndarray  # log10 of each band's smoothed total
    tokens: int
    types: int


def train(docs: DataFrame) -> tuple[Model, DataFrame]:
    """The model and the table of all word counts (``word``, ``n``), from the documents outside the held-out fold."""
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = docs.filter(remainder("doc_id", FOLDS) != 0).select("text")
    raw = texts.mapInArrow(_count_words, "word long, n long, band int")
    counts = written(raw.groupBy("word").agg(F.sum("n").alias("n"), F.min("band").alias("band")), "words")
    size = counts.agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("types")).first()
    common = _common(counts)
    shared = spark.sparkContext.broadcast(common)

    def triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(STATES * STATES * OUTPUTS, np.int64)
        for batch in batches:
            word, row, band = _words(batch.column("text"))
            state, out, _ = _contexts(_classes(shared.value, shared.value.find(word), band), row, batch.num_rows)
            total += np.bincount(state * OUTPUTS + out, minlength=len(total))
        cell = np.flatnonzero(total)
        yield pa.record_batch([pa.array(cell), pa.array(total[cell])], names=["cell", "n"])

    cells = texts.mapInArrow(triples, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    folded = np.zeros(STATES * STATES * OUTPUTS)
    folded[cells.column("cell").to_numpy()] = cells.column("n").to_numpy()
    folded = folded.reshape(-1, OUTPUTS)
    # Types of each band without the words that are outputs of their own.
    types = np.zeros(BANDS)
    own = [int(w) for w in common.word[common.frequent >= 0]]
    for r in counts.filter((F.col("band") >= 0) & ~F.col("word").isin(own or [0])).groupBy("band").count().collect():
        types[r.band] = r["count"]
    band_total = np.log10(folded.sum(0)[END + 1 :] + SMOOTH * (types + 1))
    return Model(common, fit_bilinear(folded), band_total, size.tokens or 0, size.types), counts.select("word", "n")


def _classes(common: Common, at: np.ndarray, band: np.ndarray) -> np.ndarray:
    own = np.where(at >= 0, common.frequent[at] if len(common.frequent) else -1, -1)
    return np.where(own >= 0, own, END + 1 + band)


def scores(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every row."""
    spark = docs.sparkSession
    model, counts = train(docs)
    shared = spark.sparkContext.broadcast(model)
    floor = float(np.log10(model.tokens + SMOOTH * (model.types + 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        row_id = TaskContext.get().partitionId() << 36
        for batch in batches:
            rows = batch.num_rows
            word, row, band = _words(batch.column("text"))
            at = m.common.find(word)
            found = at >= 0
            cls = _classes(m.common, at, band)
            state, out, text = _contexts(cls, row, rows)
            end = m.common.find(np.array([_END_WORD]))[0]
            end_count = m.common.count[end] if end >= 0 else 0
            logs = np.log10(np.where(found, m.common.count[at] if len(m.common.count) else 0, 0) + SMOOTH)
            per_row = lambda w, r=row: np.bincount(r, weights=w, minlength=rows)
            base = per_row(np.where(found, logs, 0)) + np.log10(end_count + SMOOTH)
            neural = per_row(m.table[state, out].astype(np.float64), text)
            in_band = cls > END
            neural += per_row(np.where(in_band, np.where(found, logs, 0) - m.band_total[np.maximum(cls - END - 1, 0)], 0))
            # Words to be looked up in the full table, once per text.
            rare, n = np.unique(np.rec.fromarrays([row[~found], word[~found]]), return_counts=True)
            cut = np.searchsorted(rare.f0, np.arange(rows + 1)).astype(np.int32)
            lists = lambda x: pa.ListArray.from_arrays(pa.array(cut), pa.array(x))
            n_tokens = np.bincount(row, minlength=rows) + 1
            known = np.bincount(row, weights=found, minlength=rows).astype(np.int64) + int(end_count > 0)
            yield pa.record_batch(
                [pa.array(np.arange(rows) + row_id), batch.column("doc_id"), pa.array(n_tokens), pa.array(known), pa.array(base), pa.array(neural), lists(rare.f1), lists(n)],
                names=["row", "doc_id", "n_tokens", "known", "base", "neural", "rare", "times"],
            )
            row_id += rows

    local = written(
        docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
            run, "row long, doc_id long, n_tokens long, known long, base double, neural double, rare array<long>, times array<long>"
        ),
        "scores",
    )
    rare = local.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("row", F.col("r.rare").alias("word"), F.col("r.times").alias("times"))
    looked = rare.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + SMOOTH)).alias("logs"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more"),
    )
    logs = F.coalesce("logs", F.lit(0.0))
    return local.drop("rare", "times").join(looked, "row", "left").select(
        "doc_id",
        (remainder("doc_id", FOLDS) == 0).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("n_tokens") * F.lit(floor)).alias("base_score"),
        (F.col("neural") + logs).alias("score"),
    )
