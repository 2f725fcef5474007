"""Language identification against a plain forward pass, numeric gradients' effect, and held-out accuracy."""

import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stumpline.llm import langid


@pytest.fixture(scope="module")
def net():
    rng = random.Random(4)
    sounds = {"aa": "abcdef", "bb": "defghi", "cc": "éßgha"}
    rows = [(k, " ".join("".join(rng.choices(s, k=5)) for _ in range(90))) for k, s in sounds.items() for _ in range(40)]
    data, start, length, row = langid.windows(pa.array([t for _, t in rows]))
    names = sorted(sounds)
    label = np.array([names.index(rows[r][0]) for r in row])
    return langid.fit_net(langid.cut(data, start, length), label, names, steps=150)


def test_folded_tables_match_a_plain_forward_pass(net):
    texts = ["abc DEF abc", "é", "", None, "ghi " * 700, "x" * 256, "y" * 257, "\x00a"]
    got = langid.shares(pa.array(texts), net, net.folded())
    for i, t in enumerate(texts):
        raw = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").encode()
        total = np.zeros(len(net.langs))
        for at in range(0, len(raw), langid.WINDOW):
            win = raw[at : at + langid.WINDOW]
            top = []
            for k, w in enumerate(net.conv):
                for f in range(langid.FILTERS):
                    best = 0.0
                    for p in range(langid.WINDOW):
                        z = float(net.shift[k * langid.FILTERS + f])
                        for j in range(len(w)):
                            if p + j < len(win):
                                z += float(net.byte[win[p + j]] @ w[j][:, f])
                        best = max(best, z)
                    top.append(best)
            logits = np.array(top) @ net.out + net.bias
            e = [math.exp(v - max(logits)) for v in logits]
            total += np.array(e) / sum(e) * len(win)
        assert np.allclose(got[i], total / max(1, len(raw)), atol=1e-4)


def test_gradients_lower_the_loss_on_other_windows(net):
    rng = random.Random(8)
    held = [("aa", "abcdef"), ("bb", "defghi"), ("cc", "éßgha")] * 20
    texts = [" ".join("".join(rng.choices(s, k=5)) for _ in range(30)) for _, s in held]
    p = langid.shares(pa.array(texts), net, net.folded())
    assert np.mean([net.langs[i] == k for i, (k, _) in zip(p.argmax(1), held, strict=True)]) > 0.95


def test_held_out_accuracy_and_that_held_out_languages_are_not_read(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.join(langid.scores(docs).select("doc_id", "held_out", "lang_pred", "score"), "doc_id").collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert {r.doc_id for r in held} == {r.doc_id for r in rows if r.held_out}
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    other = docs.withColumn("lang", F.when(langid.remainder("doc_id", 4) == 2, F.lit("xx")).otherwise(F.col("lang")))
    assert "xx" not in langid.train(other, fit_rows=300).langs


def test_odd_rows_have_defined_languages(spark):
    rows = [(None, "hello there", "en"), (1, None, "en"), (2, "", "fr"), (3, "12 .. 9", "fr"), (4, "bonjour", None), (4, "bonjour", None), (5, "hello " * 30_000, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({"score": F.lit("clash"), "_order": F.lit(1)})
    got = langid.scores(docs).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, *_ in rows)
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in got if r.doc_id in (1, 2, 3))
    assert {r.lang_pred for r in got if r.doc_id not in (1, 2, 3)} <= {"en", "fr"}
    assert len({(r.lang_pred, r.score) for r in got if r.doc_id == 4}) == 1
    assert langid.scores(docs.limit(0)).count() == 0
    nothing = langid.scores(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {(r.lang_pred, r.score) for r in nothing.collect()} == {("und", 0.0)}
