"""Toxicity and quality classifiers against plain loops."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stumpline.llm import quality, toxicity


@pytest.mark.parametrize("block", [5, 1 << 16])
def test_convolution_matches_a_plain_forward_pass(block, monkeypatch):
    monkeypatch.setattr(toxicity, "_BLOCK", block)
    rng = np.random.default_rng(2)
    none = np.zeros(0, np.int32)
    net = toxicity.fit_net(none, none, np.zeros(0, int), np.zeros(0), steps=0)
    net.out = rng.normal(size=net.out.shape).astype(np.float32)
    net.shift = [rng.normal(size=toxicity.FILTERS).astype(np.float32) for _ in toxicity.WIDTHS]
    texts = [None, "", "one", "two words", "An ALL-caps text, and some more of it", "w " * 40 + "end"]
    got = toxicity.score_array(pa.array(texts), net)
    for i, text in enumerate(texts):
        a, b, count = toxicity.word_ids(pa.array([text], pa.string()))
        x = [net.word[p] + net.prefix[q] for p, q in zip(a, b, strict=True)] + [np.zeros(toxicity.DIM)] * 2
        total = net.bias
        for k, w in enumerate(net.conv):
            for f in range(toxicity.FILTERS):
                best = 0.0
                for at in range(count[0]):
                    z = float(net.shift[k][f]) + sum(float(x[at + j] @ w[j][:, f]) for j in range(len(w)))
                    best = max(best, z)
                total += best * float(net.out[k * toxicity.FILTERS + f])
        assert got[i] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-5)


def test_leader_matches_plain_updates():
    rng = random.Random(1)
    rows = [(np.array(sorted(rng.sample(range(16), 4)), np.int32), np.array([rng.random() for _ in range(4)], np.float32), rng.randint(0, 1)) for _ in range(60)]
    model = quality.fit_leader(rows, bits=4, epochs=2, alpha=0.4, beta=1.0, l1=0.01, l2=0.1)
    z, n = dict.fromkeys(range(17), 0.0), dict.fromkeys(range(17), 0.0)

    def weight(i):
        return 0.0 if abs(z[i]) <= 0.01 else -(z[i] - math.copysign(0.01, z[i])) / ((1.0 + math.sqrt(n[i])) / 0.4 + 0.1)

    for _ in range(2):
        for ids, values, label in rows:
            x = [*zip(ids.tolist(), values.tolist(), strict=True), (16, 1.0)]
            p = 1 / (1 + math.exp(-sum(weight(i) * v for i, v in x)))
            w = {i: weight(i) for i, _ in x}
            for i, v in x:
                g = (p - label) * v
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / 0.4 * w[i]
                n[i] += g * g
    assert model.bias == pytest.approx(weight(16)) and model.weights == pytest.approx([weight(i) for i in range(16)], abs=1e-6)


def test_quality_score_is_a_sparse_dot_product():
    rng = np.random.default_rng(4)
    model = quality.Model(0.3, rng.normal(size=1 << quality.BITS).astype(np.float32))
    texts = ["Some words, some WORDS!", None, "", "a a a a", "x " * 500]
    got = quality.score_array(pa.array(texts), model)
    for i, text in enumerate(texts):
        bucket, _ = quality.ngrams(pa.array([text], pa.string()))
        mean = sum(float(model.weights[b]) for b in bucket) / max(1, len(bucket))
        assert got[i] == pytest.approx(1 / (1 + math.exp(-np.clip(0.3 + 32.0 * mean, -30, 30))), abs=1e-5)


def test_thresholds_by_language(spark):
    rows = [(i, ("bad words" if i % 2 else "good words") + (" xx" if i % 4 < 2 else " yy"), ["en", "fr", None][i % 3]) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({"tongue": F.lit(1), "threshold": F.lit("x")})
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, toxic int")
    more = docs.unionByName(docs.limit(1).withColumns({"doc_id": F.lit(999), "lang": F.lit("unseen")}))
    got = toxicity.scores(more, labels).collect()
    assert len(got) == 301 and len({r.threshold for r in got}) <= 4
    assert all(r.flagged == int(r.score >= r.threshold) for r in got)


def test_toxicity_learns_from_every_labelled_row(spark, monkeypatch):
    """A word that few texts hold counts wherever they lie, and shards of one row set give one net."""
    rows = [(i, f"odd{i % 40} words" if i % 2 else f"even{i % 40} words", None) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    fitted = toxicity.fit_ids(docs, labels)
    used = docs.join(labels, "doc_id").filter("crc32(cast(cast(doc_id as string) as binary)) % 5 != 0")
    assert fitted.count() == used.count()
    one, many = toxicity.train(docs, labels), toxicity.train(docs, labels, 50, 150)
    texts = pa.array([r[1] for r in rows[:40]])
    for net in (one, many):
        score = toxicity.score_array(texts, net)
        assert (score[1::2] > 0.5).all() and (score[::2] < 0.5).all()
    odds = toxicity.log_odds(*toxicity.bucket_counts(np.array([3, 3, 5], np.int32), np.array([2, 1]), np.array([1.0, 0.0])), 2, 1.0)
    assert odds[3] > 0 > odds[5] and odds[0] == 0


def test_thresholds_in_spark_match_the_plain_ones(spark, hot):
    rng = random.Random(3)
    rows = [("ab"[i % 2], round(rng.random(), 2), rng.randint(0, 1)) for i in range(300)] + [("c", 0.4, 1), ("c", 0.6, 1)]
    table = spark.createDataFrame(rows, "tongue string, score double, _label int")
    for limit in (1_000_000, 20):
        hot(limit)
        got = {r.tongue: r.threshold for r in toxicity.best_thresholds(table, "tongue").collect()}
        for t in "abc":
            mine = [r for r in rows if r[0] == t]
            assert got[t] == toxicity.best_threshold(np.array([r[1] for r in mine]), np.array([r[2] for r in mine], float))
