"""Benchmark decontamination: an FM-index per training shard, searched backwards for all benchmark windows.

Words are runs of digits, letters and characters beyond ASCII, A-Z lower-cased. A benchmark item gives its
windows of ``WINDOW`` consecutive words; a shorter item that has words is one window. Tasks gather documents
into shards of about ``SHARD_BYTES``. The indexed sequence is the shard's words that the benchmark has; any
other word, and the end of a document, ends a run and counts as a sentinel of its own, so no window crosses it.
Suffixes are ordered by refining groups of equal prefixes, the transform goes into a wavelet matrix, all windows
are searched at once by its ranks, and occurrences are located by walking back to sampled suffix positions.
Overlapping occurrences merge into spans.

The benchmark is a stated query set: it is read in blocks of ``BLOCK_WORDS`` words, each a broadcast file of its own.
Every shard is indexed once per block; driver and workers load one block at a time and forget it before the next, so
memory holds a shard and a block, whatever the benchmark's size. All blocks lie on the executors' disks.

Null and empty texts have no words and no hits; null or empty items have no windows; repeated items and repeated
rows each count on their own. Items are listed once per document; items without an id are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stumpline.llm import bytescan
from stumpline.llm.common import bounded_batches

WINDOW = 10
SHARD_BYTES = 8 << 20
BLOCK_WORDS = 1_000_000
SAMPLE = 8


@dataclass(frozen=True)
class Windows:
    """Distinct windows of a block of items, and the items that have them."""

    vocabulary: np.ndarray  # sorted word hashes; symbol s is vocabulary[s - 1]
    symbols: np.ndarray  # the windows' symbols, one after another
    starts: np.ndarray
    sizes: np.ndarray
    item_windows: np.ndarray  # window of each (window, item) pair, sorted
    items: np.ndarray  # item of each pair, as text


def windows_of(items: list[tuple[str, str]], window: int = WINDOW) -> Windows:
    """Windows of (item id as text, text) pairs."""
    data, offsets = bytescan.utf8(pa.array([t for _, t in items], pa.string()))
    data = bytescan.lower(data)
    starts, ends, row = bytescan.spans(data, offsets, bytescan.WORD)
    words = bytescan.hashes(data, starts, ends)
    vocabulary = np.unique(words)
    symbol = np.searchsorted(vocabulary, words).astype(np.int32) + 1
    bounds = np.searchsorted(row, np.arange(len(items) + 1))
    ids: dict[bytes, int] = {}
    pairs: set[tuple[int, str]] = set()
    for (item, _), a, b in zip(items, bounds[:-1], bounds[1:], strict=True):
        for i in range(a, max(b - window, a) + 1 if b > a else a):
            key = symbol[i : min(i + window, b)].tobytes()
            pairs.add((ids.setdefault(key, len(ids)), item))
    sizes = np.array([len(k) // 4 for k in ids], np.int64)
    listed = sorted(pairs)
    return Windows(
        vocabulary, np.frombuffer(b"".join(ids), np.int32), np.cumsum(sizes) - sizes, sizes,
        np.array([w for w, _ in listed], np.int64), np.array([i for _, i in listed], object),
    )


def suffix_order(symbol: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Places in the order of their suffixes; a suffix ends with its run, ``left`` symbols from its place.

    Equal suffixes are in order of place, as if each run ended in a sentinel of its own.
    """
    n = len(symbol)
    bits = max(1, int(symbol.max(initial=0)).bit_length())
    depth = 62 // bits
    key = np.zeros(n, np.int64)
    for j in range(depth):
        here = np.zeros(n, np.int64)
        here[: n - j] = np.where(left[: n - j] > j, symbol[j:], 0) if j < n else 0
        key = key << bits | here
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if n else np.zeros(0, int)
    rank = np.empty(n, np.int64)
    size = np.diff(np.append(first, n))
    rank[order] = np.repeat(first, size)
    slots = np.flatnonzero(np.repeat(size > 1, size))
    while True:
        slots = slots[left[order[slots]] >= depth]
        if not len(slots):
            return order
        rows = order[slots]
        # A suffix that ends here comes before those that go on.
        second = np.where(left[rows] > depth, rank[np.minimum(rows + depth, n - 1)] + 1, 0)
        # Stable by (group, second): slots are already in order of group.
        again = np.lexsort((rows, second, rank[rows]))
        rows = rows[again]
        a, b = rank[rows], second[again]
        new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
        order[slots] = rows
        group = np.flatnonzero(new)
        size = np.diff(np.append(group, len(rows)))
        rank[rows] = np.repeat(slots[group], size)
        slots = slots[np.repeat(size > 1, size)]
        depth *= 2


class WaveletRanks:
    """Ranks of symbols in a sequence: one bit plane per bit of the symbols, highest first."""

    def __init__(self, sequence: np.ndarray, symbols: int) -> None:
        self.bits = max(1, int(symbols).bit_length())
        self.planes: list[np.ndarray] = []
        self.before: list[np.ndarray] = []
        self.zeros: list[int] = []
        for level in reversed(range(self.bits)):
            bit = (sequence >> level & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            plane = np.zeros(len(bit) // 64 + 1, np.uint64)
            plane.view(np.uint8)[: len(packed)] = packed
            ones = np.bitwise_count(plane).astype(np.int64)
            self.planes.append(plane)
            self.before.append(np.cumsum(ones) - ones)
            self.zeros.append(int(len(bit) - bit.sum()))
            sequence = np.concatenate([sequence[~bit], sequence[bit]])
        self.origin = self._walk(np.arange(symbols + 1), np.zeros(symbols + 1, np.int64))

    def _walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k in range(self.bits):
            word = at >> 6
            mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.before[k][word] + np.bitwise_count(self.planes[k][word] & mask)
            at = np.where(symbol >> (self.bits - 1 - k) & 1, self.zeros[k] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        return self._walk(symbol, at) - self.origin[symbol]


class FMIndex:
    """Backward search and location over runs of symbols."""

    def __init__(self, symbol: np.ndarray, left: np.ndarray, run_start: np.ndarray, symbols: int) -> None:
        order = suffix_order(symbol, left)
        previous = np.zeros(len(symbol), np.int32)
        previous[1:] = symbol[:-1]
        previous[run_start] = 0
        # The sentinels come first, one for each run; the symbol before one is the last of its run.
        sentinels = int(run_start.sum())
        self.last = np.concatenate([symbol[left == 1], previous[order]])
        self.ranks = WaveletRanks(self.last, symbols)
        self.first = sentinels + np.append(0, np.cumsum(np.bincount(symbol, minlength=symbols + 1)))
        kept = np.append(np.zeros(sentinels, bool), run_start[order] | (order % SAMPLE == 0))
        self.kept, self.kept_rank, self.position = kept, np.cumsum(kept) - kept, order[kept[sentinels:]]

    def search(self, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that begin with each window."""
        low = np.zeros(len(windows.sizes), np.int64)
        high = np.full(len(windows.sizes), len(self.last), np.int64)
        for step in range(int(windows.sizes.max(initial=0))):
            on = np.flatnonzero((windows.sizes > step) & (low < high))
            if not len(on):
                break
            c = windows.symbols[windows.starts[on] + windows.sizes[on] - 1 - step]
            low[on] = self.first[c] + self.ranks.rank(c, low[on])
            high[on] = self.first[c] + self.ranks.rank(c, high[on])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Place of each suffix: back symbol by symbol to a sampled one."""
        steps = np.zeros(len(rows), np.int64)
        while True:
            on = np.flatnonzero(~self.kept[rows])
            if not len(on):
                return self.position[self.kept_rank[rows]] + steps
            c = self.last[rows[on]]
            rows = rows.copy()
            rows[on] = self.first[c] + self.ranks.rank(c, rows[on])
            steps[on] += 1


def occurrences(words: np.ndarray, doc: np.ndarray, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
    """Word place and window of every occurrence of the windows in one shard."""
    none = np.zeros(0, np.int64)
    if not len(windows.sizes) or not len(words):
        return none, none
    near = np.minimum(np.searchsorted(windows.vocabulary, words), len(windows.vocabulary) - 1)
    place = np.flatnonzero(windows.vocabulary[near] == words)
    if not len(place):
        return none, none
    symbol = near[place].astype(np.int32) + 1
    run_start = np.append(True, (np.diff(place) != 1) | (doc[place[1:]] != doc[place[:-1]]))
    first = np.flatnonzero(run_start)
    end = np.append(first[1:], len(place))
    left = np.repeat(end, end - first) - np.arange(len(place))
    index = FMIndex(symbol, left, run_start, len(windows.vocabulary))
    low, high = index.search(windows)
    count = high - low
    which = np.repeat(np.arange(len(count)), count)
    rows = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    return place[index.locate(rows)], which


@dataclass(frozen=True)
class Found:
    words: np.ndarray  # words of each text
    hit: np.ndarray  # of each word
    row: np.ndarray
    starts: np.ndarray  # bytes of each word
    ends: np.ndarray
    items: list[list[str]]


def search_shard(texts: pa.Array, blocks: list[Broadcast]) -> Found:
    """Hit words and items of the texts of one shard."""
    data, offsets = bytescan.utf8(texts)
    data = bytescan.lower(data)
    starts, ends, row = bytescan.spans(data, offsets, bytescan.WORD)
    words = bytescan.hashes(data, starts, ends)
    change = np.zeros(len(words) + 1, np.int64)
    items: dict[int, set[str]] = {}
    for windows in _loaded(blocks):
        place, which = occurrences(words, row, windows)
        np.add.at(change, place, 1)
        np.add.at(change, place + windows.sizes[which], -1)
        pairs = np.unique(row[place] * max(1, len(windows.sizes)) + which)
        for p in pairs.tolist():
            doc, w = divmod(p, max(1, len(windows.sizes)))
            a, b = np.searchsorted(windows.item_windows, [w, w + 1])
            items.setdefault(doc, set()).update(windows.items[a:b])
    hit = np.cumsum(change[:-1]) > 0
    count = np.bincount(row, minlength=len(texts))
    return Found(count, hit, row, starts, ends, [sorted(items.get(i, ())) for i in range(len(texts))])


def _loaded(blocks: list[Broadcast]) -> Iterator[Windows]:
    """One block after another; a single one stays loaded for the next shard."""
    for block in blocks:
        yield block.value
        if len(blocks) > 1:
            _forget(block)


def _forget(block: Broadcast) -> None:
    """Drop what this process has loaded; the block's file remains and is read again when it is asked for."""
    vars(block).pop("_value", None)


def benchmark_blocks(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> list[Broadcast]:
    """Broadcast windows of the benchmark, at most about ``block_words`` words at a time."""
    spark = benchmark.sparkSession
    items = benchmark.filter("item_id is not null").select(F.col("item_id").cast("string").alias("item"), F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.sum(F.length("text") / 4 + 1)).first()[0] or 0
    blocks = max(1, int(-(-total // block_words)))
    out = []
    for i in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == i).orderBy("item", "text")
        out.append(spark.sparkContext.broadcast(windows_of([(r.item, r.text) for r in part.toLocalIterator()], window)))
        _forget(out[-1])
    return out


def _shards(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(column).nbytes
        if size >= SHARD_BYTES:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def hits(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``, and the byte ``spans`` hit."""
    bounded_batches(docs.sparkSession)
    blocks = benchmark_blocks(benchmark, block_words=block_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches, "text"):
            texts = shard.column("text").combine_chunks()
            texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
            found = search_shard(texts, blocks)
            n_hit = np.bincount(found.row, weights=found.hit, minlength=len(texts)).astype(np.int64)
            ids = shard.column("doc_id").combine_chunks()
            yield pa.record_batch(
                [
                    ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids, pa.array(found.words.astype(np.int64)), pa.array(n_hit),
                    pa.array([len(x) for x in found.items], pa.int64()),
                    pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in found.items], pa.string()),
                    pa.array(n_hit > 0), pa.array(_cuts(found, texts), pa.list_(pa.list_(pa.int64()))),
                ],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, spans array<array<long>>"
    )


def _cuts(found: Found, texts: pa.Array) -> list[list[list[int]]]:
    """Byte ranges of the merged hits, from the first byte of each text."""
    out: list[list[list[int]]] = [[] for _ in range(len(texts))]
    at = np.flatnonzero(found.hit)
    if not len(at):
        return out
    row = found.row[at]
    new = np.append(True, (np.diff(at) != 1) | (row[1:] != row[:-1]))
    last = np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)
    _, offsets = bytescan.utf8(texts)
    for a, b, r in zip(at[new].tolist(), at[last].tolist(), row[new].tolist(), strict=True):
        out[r].append([int(found.starts[a] - offsets[r]), int(found.ends[b] - offsets[r])])
    return out


def clean_array(texts: pa.Array, blocks: list[Broadcast]) -> pa.Array:
    """The texts without the hit spans; texts that were cut are searched again until nothing is found."""
    out = texts.to_pylist()
    rows = list(range(len(out)))
    while rows:
        part = pa.array([out[i] for i in rows], pa.string())
        cuts = _cuts(search_shard(part, blocks), part)
        again = []
        for i, spans in zip(rows, cuts, strict=True):
            if spans:
                raw = out[i].encode()
                ends = [0, *(b for _, b in spans)]
                starts = [*(a for a, _ in spans), len(raw)]
                out[i] = b"".join(raw[a:b] for a, b in zip(ends, starts, strict=True)).decode()
                again.append(i)
        rows = again
    return pa.array(out, pa.string())


def remove_spans(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with every benchmark passage cut out of ``text`` and ``n_chars`` counted anew; all rows stay."""
    bounded_batches(docs.sparkSession)
    blocks = benchmark_blocks(benchmark, block_words=block_words)

    @F.arrow_udf("string")
    def cleaned(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in texts:
            yield clean_array(part, blocks)

    out = docs.withColumn("text", cleaned("text"))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
