"""Periodic runs of words: maximal stretches that repeat their first words at least four times.

A document's words are numbered by first occurrence and exploded into overlapping tiles, for each octave ``P`` of
periods ``P..2P-1`` its own: boundaries lie ``2P`` words apart, and a boundary's window is ``2P`` words before it and
``6P`` after it. Tiles of small octaves hold several boundaries. A run of period ``q`` has ``4q`` words or more, so a
boundary ``c`` lies in it whose next ``q`` words are the ``q`` after these. Two Z-functions at the boundary, of the
words after it and of the words before it backwards, give how far period ``q`` reaches to either side, for all ``q``
of the octave. Tiles are solved alone; their fragments are shuffled by document and period, where those that overlap
by a period or more are stitched. Windows overlap so far that a run's fragments always do and reach its ends, and two
runs of one period never do. A fragment whose period is a multiple of a smaller one is left out at the boundary.

Tiles are made only where the first words at a boundary agree, and only for documents and octaves in which as many agree
as the first boundary of a run has, so texts without repetition cost one look per octave.
Tiles of a document of more than ``LONG`` words are dealt over all tasks. The words of documents with such tiles, and
their tiles, are written to the shared folder once. One document's words and runs meet in one task in the end; the
runs of a text are fewer than its words.

Null and empty texts have no words and no runs. Rows are told apart by id and text, so repeated rows have equal results
and a null id (which hashes as empty text) is an id of its own. Runs that tie in length are settled by start, then
period. Extra columns change nothing, and an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stumpline.llm.common import bounded_batches, per_batch, written

#: A run holds its period so often; the windows are proven for four times or more.
TIMES = 4
#: A run's words, at least.
LEAST = 6
#: Words of a tile between its margins, at least.
SPAN = 256
#: Words that have to agree before a tile is made.
SCREEN = 8
#: Documents of more words have their tiles dealt over all tasks.
LONG = 200_000
_CELLS = 1 << 20
_TILES = 512
_NO_ID = -(1 << 63)
_TILED = "key long, text_hash long, octave long, n long, own long, first long, plain string, data binary"
_FRAGMENTS = "key long, text_hash long, period long, start long, stop long"

Plant = Callable[[int | None, int], tuple[int, int] | None]


def planted_tail(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """Start and period of the repetition that one document in ten gets."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def _repeated(words: Sequence, tail: tuple[int, int] | None) -> Sequence:
    if tail is None:
        return words
    a, p = tail
    unit = words[a : a + p]
    return words[:a] + (unit * (-(-(len(words) - a) // p)))[: len(words) - a]


def _weak(q: np.ndarray, octave: int) -> np.ndarray:
    """Words that agree with those one period on where a boundary tells a period."""
    return q


def _strong(q: np.ndarray, octave: int) -> np.ndarray:
    """Words that agree so at the first boundary of every run, which lies less than two octaves after its start."""
    return np.maximum(LEAST, TIMES * q) - 2 * octave + 1 - q


def agreeing(ids: np.ndarray, at: np.ndarray, end: np.ndarray, octave: int, words: Callable[[np.ndarray, int], np.ndarray]) -> np.ndarray:
    """Which boundaries ``at`` (of texts that end at ``end``) may have so many agreeing ``words`` for some period of the octave."""
    out = np.zeros(len(at), bool)
    rows = max(1, _CELLS // octave)
    for i in range(0, len(at), rows):
        c, stop = at[i : i + rows], end[i : i + rows]
        for low in range(octave, 2 * octave, _CELLS):
            q = np.arange(low, min(2 * octave, low + _CELLS))
            far = np.minimum(c[:, None] + q, len(ids) - 1)
            row, col = np.nonzero((ids[far] == ids[c][:, None]) & (c[:, None] + q + words(q, octave) <= stop[:, None]))
            x, q = c[row], q[col]
            for step in range(1, SCREEN):
                same = (step >= words(q, octave)) | (ids[np.minimum(x + step, len(ids) - 1)] == ids[np.minimum(x + q + step, len(ids) - 1)])
                row, x, q = row[same], x[same], q[same]
            out[i + np.unique(row)] = True
    return out


def tiles(ids: np.ndarray, count: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, octave, own start, first word, stop) of every tile worth solving; texts lie one after another in ``ids``.

    A text has tiles of an octave only if one of its boundaries may be the first of a run.
    """
    begin = np.cumsum(count) - count
    octave = 1
    while TIMES * octave <= (count.max() if len(count) else 0):
        text = np.flatnonzero(count >= TIMES * octave)
        many = count[text] // (2 * octave)
        owner = np.repeat(text, many)
        place = 2 * octave * (np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many))
        at, end = begin[owner] + place, (begin + count)[owner]
        able = np.isin(owner, owner[agreeing(ids, at, end, octave, _strong)])
        owner, place = owner[able], place[able]
        live = agreeing(ids, at[able], end[able], octave, _weak)
        span = max(2 * octave, SPAN)
        found = np.unique(np.stack([owner[live], place[live] // span], axis=1), axis=0)
        for d, t in found.tolist():
            yield d, octave, t * span, max(0, t * span - 2 * octave), min(int(count[d]), (t + 1) * span + 4 * octave)
        octave *= 2


def z_values(s: Sequence[int], limit: int) -> list[int]:
    """For each of the first ``limit`` places, how far the sequence from there agrees with its beginning."""
    n, left, right = len(s), 0, 0
    z = [0] * min(limit, n)
    if z:
        z[0] = n
    for i in range(1, len(z)):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[i + k] == s[k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return z


def _primes(q: int) -> list[int]:
    out, d = [], 2
    while d * d <= q:
        if q % d == 0:
            out.append(d)
            while q % d == 0:
                q //= d
        d += 1
    return [*out, q] if q > 1 else out


def solve(ids: np.ndarray, octave: int, own: int) -> list[tuple[int, int, int]]:
    """(period, start, stop) of the fragments in a tile whose own part starts at ``own``, stitched within the tile."""
    span = max(2 * octave, SPAN)
    at = np.arange(own, min(own + span, len(ids) - 2 * octave + 1), 2 * octave)
    at = at[agreeing(ids, at, np.full(len(at), len(ids)), octave, _weak)]
    words = ids.tolist()
    found: dict[int, list[list[int]]] = {}
    for c in at.tolist():
        ahead = z_values(words[c : c + 6 * octave], 2 * octave)
        able = [q for q in range(octave, len(ahead)) if ahead[q] >= q and not any(ahead[q // f] >= 2 * q - q // f for f in _primes(q))]
        if not able:
            continue
        first = max(0, c - 2 * octave)
        before = words[first:c][::-1]
        back = z_values([*before, -1, *words[first : c + 2 * octave][::-1]], len(before) + 2 + octave)
        for q in able:
            start, stop = c - back[len(before) + 1 + 2 * octave - q], c + q + ahead[q]
            mine = found.setdefault(q, [])
            if mine and start <= mine[-1][1] - q:
                mine[-1] = [min(start, mine[-1][0]), max(stop, mine[-1][1])]
            else:
                mine.append([start, stop])
    return [(q, a, b) for q, mine in found.items() for a, b in mine]


def _exploder(plant: Plant | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One row for each document (octave 0; its words only if it has tiles) and one for each tile."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, count, joined = [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                words = (text or b"").split()
                words = _repeated(words, plant(doc_id, len(words)) if plant else None)
                ids.append(np.fromiter(map({}.setdefault, words, range(len(words))), np.int32, len(words)))
                count.append(len(words))
                joined.append(b" ".join(words))
            every = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            rows, tiled = [], set()
            for d, octave, own, first, stop in tiles(every, np.array(count, np.int64)):
                tiled.add(d)
                rows.append((d, octave, own, first, None, ids[d][first:stop].tobytes()))
                if len(rows) >= _TILES:
                    yield _rows(batch, count, rows)
                    rows = []
            rows += [(d, 0, 0, 0, hashlib.sha256(joined[d]).hexdigest(), joined[d] if d in tiled else None) for d in range(len(count))]
            yield _rows(batch, count, rows)

    return explode


def _rows(batch: pa.RecordBatch, count: list[int], rows: list[tuple]) -> pa.RecordBatch:
    d, octave, own, first, plain, data = zip(*rows, strict=True) if rows else ((),) * 6
    at = pa.array(d, pa.int64())
    return pa.record_batch(
        [
            batch.column("key").take(at), batch.column("text_hash").take(at), pa.array(octave, pa.int64()), pa.array([count[i] for i in d], pa.int64()),
            pa.array(own, pa.int64()), pa.array(first, pa.int64()), pa.array(plain, pa.string()), pa.array(data, pa.binary()),
        ],
        names=["key", "text_hash", "octave", "n", "own", "first", "plain", "data"],
    )


def _fragments(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows: list[int] = []
    out: list[tuple[int, int, int]] = []
    columns = (batch.column(c).to_pylist() for c in ("octave", "own", "first", "data"))
    for i, (octave, own, first, data) in enumerate(zip(*columns, strict=True)):
        found = solve(np.frombuffer(data, np.int32), octave, own - first)
        rows += [i] * len(found)
        out += [(q, a + first, b + first) for q, a, b in found]
    at = pa.array(rows, pa.int64())
    values = [pa.array([r[k] for r in out], pa.int64()) for k in range(3)]
    return pa.record_batch([batch.column("key").take(at), batch.column("text_hash").take(at), *values], names=["key", "text_hash", "period", "start", "stop"])


def tiled(docs: DataFrame, plant: Plant | None = None) -> DataFrame:
    """The documents and their tiles as a written table."""
    bounded_batches(docs.sparkSession)
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(F.coalesce(doc_id, F.lit(_NO_ID)).alias("key"), doc_id.alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return written(rows.mapInArrow(_exploder(plant), _TILED), "tiles")


def stitched(tiles_: DataFrame, times: int = TIMES, least: int = LEAST) -> DataFrame:
    """``key``, ``text_hash``, ``start``, ``length``, ``period`` of every run, from the fragments of the tiles."""
    if times < TIMES or least < LEAST:
        raise ValueError(f"a run holds its period at least {TIMES} times and has at least {LEAST} words")
    cells = tiles_.filter("octave > 0").select("key", "text_hash", "octave", "n", "own", "first", "data")
    few = cells.filter(F.col("n") <= LONG).mapInArrow(per_batch(_fragments), _FRAGMENTS)
    dealt = cells.filter(F.col("n") > LONG).repartition("key", "text_hash", "octave", "own")
    fragments = few.unionByName(dealt.mapInArrow(per_batch(_fragments), _FRAGMENTS))
    fragments = fragments.groupBy("key", "text_hash", "period", "start").agg(F.max("stop").alias("stop"))
    line = Window.partitionBy("key", "text_hash", "period").orderBy("start")
    reached = F.max("stop").over(line.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col("start") <= F.col("reached") - F.col("period"), 0).otherwise(1)
    numbered = fragments.withColumn("reached", reached).withColumn("run", F.sum(fresh).over(line))
    runs = numbered.groupBy("key", "text_hash", "period", "run").agg(F.min("start").alias("start"), (F.max("stop") - F.min("start")).alias("length"))
    return runs.filter(F.col("length") >= F.greatest(F.lit(least), times * F.col("period"))).select("key", "text_hash", "start", "length", "period")


def find_runs(docs: DataFrame, times: int = TIMES, least: int = LEAST) -> DataFrame:
    """``doc_id``, ``text_hash`` (xxhash64 of the text), ``start``, ``length``, ``period`` of every run of every text."""
    return stitched(tiled(docs), times, least).select(F.nullif("key", F.lit(_NO_ID)).alias("doc_id"), "text_hash", "start", "length", "period")


def _runs_of(runs: DataFrame) -> DataFrame:
    return runs.groupBy("key", "text_hash").agg(F.sort_array(F.collect_list(F.struct("start", "length", "period"))).alias("runs"))


def kept(words: list[bytes], runs: list[dict]) -> list[bytes]:
    """The words without the repetitions of the runs: each run's first period stays."""
    gone = np.zeros(len(words), bool)
    for r in runs:
        gone[r["start"] + r["period"] : r["start"] + r["length"]] = True
    return [words[i] for i in np.flatnonzero(~gone).tolist()]


def collapse(docs: DataFrame, times: int = TIMES, least: int = LEAST) -> DataFrame:
    """``docs`` with the repetitions cut out of ``text``; texts without a run stay as they are."""
    key, digest, found = (f"__stumpline_{c}" for c in ("key", "hash", "runs"))
    runs = _runs_of(stitched(tiled(docs), times, least)).select(F.col("key").alias(key), F.col("text_hash").alias(digest), F.col("runs").alias(found))
    same = (F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)) == F.col(key)) & (F.xxhash64("text") == F.col(digest))

    @F.arrow_udf("string")
    def collapsed(texts: pa.Array, lists: pa.Array) -> pa.Array:
        pairs = zip(texts.to_pylist(), lists.to_pylist(), strict=True)
        return pa.array([b" ".join(kept(t.encode().split(), r)).decode() if r else t for t, r in pairs], pa.string())

    columns = [collapsed("text", found).alias("text") if c == "text" else F.col(c) for c in docs.columns]
    return docs.join(runs, same, "left").select(*columns)


def _digest(batch: pa.RecordBatch) -> pa.RecordBatch:
    out: list[tuple] = []
    for plain, data, runs in zip(*(batch.column(c).to_pylist() for c in ("plain", "data", "runs")), strict=True):
        runs = runs or []
        lines = "".join(f"{r['start']},{r['length']},{r['period']}\n" for r in runs)
        best = min(runs, key=lambda r: (-r["length"], r["start"], r["period"]), default=None)
        whole = hashlib.sha256(b" ".join(kept(data.split(b" "), runs))).hexdigest() if runs else plain
        top = (best["start"], best["length"], best["period"], 1000 * best["length"] // best["period"]) if best else (None,) * 4
        out.append((len(runs), *top, hashlib.sha256(lines.encode()).hexdigest(), whole))
    names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    kinds = [pa.int64()] * 5 + [pa.string()] * 2
    values = [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)]
    return pa.record_batch([batch.column("key"), *values], names=["key", *names])


def digests(docs: DataFrame, plant: Plant | None = planted_tail) -> DataFrame:
    """Number of runs, the longest run and digests of runs and collapsed words of every row, after ``plant``'s edit."""
    cells = tiled(docs, plant)
    rows = cells.filter("octave = 0").select("key", "text_hash", "plain", "data")
    joined = rows.join(_runs_of(stitched(cells)), ["key", "text_hash"], "left")
    kinds = "key long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    found = joined.select("key", "plain", "data", "runs").mapInArrow(per_batch(_digest), kinds)
    id_: Column = F.nullif("key", F.lit(_NO_ID)).alias("doc_id")
    return found.select(id_, *[c for c in found.columns if c != "key"])
