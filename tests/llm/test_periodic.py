"""Periodic runs against a search of every period and against planted ends of tiles."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stumpline.llm import periodic


def plain_runs(w, times=4, least=6):
    out, n = [], len(w)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q) and not any(q % d == 0 and w[i : j + q - d] == w[i + d : j + q] for d in range(1, q)):
                out.append((i, j + q - i, q))
            i = j + 1
    return sorted((s, n_, q) for s, n_, q in out)


def tile_runs(w):
    """Runs from solved tiles, stitched as the window does it."""
    codes = {}
    ids = np.array([codes.setdefault(x, i) for i, x in enumerate(w)], np.int32)
    by_period = {}
    for _, octave, own, first, stop in periodic.tiles(ids, np.array([len(ids)])):
        for q, a, b in periodic.solve(ids[first:stop], octave, own - first):
            by_period.setdefault(q, []).append((a + first, b + first))
    out = []
    for q, mine in by_period.items():
        ends = []
        for a, b in sorted(mine):
            if ends and a <= ends[-1][1] - q:
                ends[-1][1] = max(b, ends[-1][1])
            else:
                ends.append([a, b])
        out += [(a, b - a, q) for a, b in ends if b - a >= max(6, 4 * q)]
    return sorted(out)


def odd_words(rng):
    kind = rng.random()
    if kind < 0.3:
        return rng.choices("ab", k=rng.randint(0, 120))
    if kind < 0.6:
        unit = rng.choices("abc", k=rng.randint(1, 40))
        w = rng.choices("abcd", k=rng.randint(0, 30)) + (unit * rng.randint(2, 12))[: rng.randint(1, 400)] + rng.choices("abcd", k=rng.randint(0, 30))
        return w + unit * 5 if rng.random() < 0.5 else w
    a, b = ["a"], ["a", "b"]
    if kind < 0.8:
        for _ in range(rng.randint(3, 9)):
            a, b = b, b + a
        return b
    return ["x"] * rng.randint(0, 300) + ["y"] * rng.randint(0, 9) + ["x", "y"] * rng.randint(0, 50)


@pytest.mark.parametrize("span", [2, 256])
def test_tiles_give_every_run_of_odd_words(span, monkeypatch):
    monkeypatch.setattr(periodic, "SPAN", span)
    rng = random.Random(span)
    for _ in range(400):
        w = odd_words(rng)
        assert tile_runs(w) == plain_runs(w), w


def test_z_values():
    rng = random.Random(3)
    for _ in range(100):
        s = rng.choices([0, 1], k=rng.randint(1, 40))
        want = [next((k for k in range(len(s) - i) if s[i + k] != s[k]), len(s) - i) for i in range(len(s))]
        assert periodic.z_values(s, len(s)) == want and periodic.z_values(s, 5) == want[:5]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def expected(doc_id, text, plant=True):
    w = words_of(text)
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if plant and h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    runs = plain_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return len(runs), *top, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(12)
    texts = [None, "", " \n\t", "one", "é é é é é é é x", "a\x0bb\x0ca\rb a b a b", "x" * 5000, *(" \n".join(odd_words(rng)) for _ in range(120)), "la di da " * 700]
    rows = [(i, t) for i, t in enumerate(texts)]
    return [*rows, (None, "x " * 9), (None, None), (8, "other text " * 6), *[(130, "be " * 40)] * 30, *rows[:20]]


@pytest.mark.parametrize("long", [50, 200_000])
def test_digests_match_a_search_of_every_period(spark, rows, long, monkeypatch):
    monkeypatch.setattr(periodic, "LONG", long)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"key": F.lit("k"), "period": F.lit(1), "text_hash": F.lit(0)})
    got = [(r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in periodic.digests(docs).collect()]
    assert sorted(got, key=str) == sorted([(i, *expected(i, t)) for i, t in rows], key=str)
    assert periodic.digests(docs.limit(0)).count() == 0


def test_runs_and_collapsed_texts(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit(5)).dropDuplicates(["doc_id", "text"])
    got = sorted(((r.doc_id, r.start, r.length, r.period) for r in periodic.find_runs(docs).collect()), key=str)
    pairs = {(r.doc_id, r.text) for r in docs.collect()}
    assert got == sorted(((i, *r) for i, t in pairs for r in plain_runs(words_of(t))), key=str)
    out = periodic.collapse(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    made = {(r.doc_id, r.text) for r in out.collect()}
    want = set()
    for i, t in pairs:
        gone = {k for s, n, q in plain_runs(words_of(t)) for k in range(s + q, s + n)}
        want.add((i, " ".join(x for k, x in enumerate(words_of(t)) if k not in gone) if gone else t))
    assert made == want and (127, "la di da") in made
    with pytest.raises(ValueError):
        periodic.find_runs(docs, times=2)
