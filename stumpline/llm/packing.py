"""Packing documents into sequences of a fixed number of tokens.

Documents are tokenised where they lie, an end id is added, and only longer ones are cut. What is packed are
lengths: the histogram of piece lengths (at most one entry per token of a sequence, however many documents)
gives patterns, each used for as many sequences as the histogram allows. A pattern is filled greedily, largest
length first; then, as long as it gets fuller, its smallest document gives way to the two unpacked ones that
fit its expanded gap most tightly. Pieces of a length are numbered without gaps (within their task while
tokenising, then by the counts of the tasks before), and their number tells pattern, sequence and place.

Null and empty texts are the end id alone. Repeated rows and repeated or null ids are packed each on their own.
An empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache
from unicodedata import normalize

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stumpline.llm.common import bounded_batches, by_rows, written

CAPACITY = 4096
TOKENIZER = "word_bpe_49k.json"
END_ID = 1
#: Words whose ids a worker remembers.
REMEMBERED = 800_000


#: Between an ASCII letter or digit and an ASCII sign other than the apostrophe, tokens never join.
_SEAM = re.compile(rb"(?<=[A-Za-z0-9])(?=[!-&(-/:-@\[-`{-~])")


def _pieces(text: bytes) -> list[bytes]:
    """Parts of a text that are tokenised each by itself; ASCII texts are lower-cased as the tokenizer does."""
    if b"<|" in text:  # may hold the name of a special token
        return text.split()
    return _SEAM.sub(b" ", text.lower() if text.isascii() else text).split()


class WordIds:
    """Token ids of texts, part by part.

    The vocabulary never joins tokens across ASCII blanks nor at a seam, so a text's ids are those of its parts,
    and a worker looks repeated parts up instead of encoding them again.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}

    def _learn(self, new: list[bytes]) -> None:
        named = [(w, w.decode()) for w in new]
        # A run of letters is one word to the tokenizer: many are encoded as one text and cut by word.
        plain, other = [], []
        for word, t in named:
            (plain if normalize("NFC", t).lower().isalpha() else other).append((word, t))
        for i in range(0, len(plain), 1_000):
            part = plain[i : i + 1_000]
            found = self.tokenizer.encode_batch([" ".join([t for _, t in part])], add_special_tokens=False)[0]
            ids = np.array(found.ids, "<u4")
            if found.word_ids[-1] + 1 != len(part):
                other += part
                continue
            cut = np.searchsorted(np.array(found.word_ids, np.int64), np.arange(len(part) + 1)).tolist()
            raw = ids.tobytes()
            for (word, _), x, y in zip(part, cut[:-1], cut[1:], strict=True):
                self.known[word] = raw[4 * x : 4 * y]
        for i in range(0, len(other), 10_000):
            part = other[i : i + 10_000]
            for (word, _), e in zip(part, self.tokenizer.encode_batch_fast([t for _, t in part], add_special_tokens=False), strict=True):
                self.known[word] = np.array(e.ids, "<u4").tobytes()

    def __call__(self, texts: list[bytes]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        split = [_pieces(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        self._learn(list(set().union(*split).difference(self.known)))
        known = self.known
        for words in split:
            yield b"".join(map(known.__getitem__, words))


@cache
def word_ids(tokenizer: str) -> WordIds:
    """One per worker process, so that its tasks share what was looked up."""
    if os.path.isabs(tokenizer):
        return WordIds(tokenizer)
    import public_tokenizers

    return WordIds(public_tokenizers.path(tokenizer))


def pieces(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of every row as a written table; ``task`` and ``number`` count the pieces of a length."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = word_ids(tokenizer)
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            out: list[tuple] = []
            texts = batch.column("text").cast(pa.binary()).fill_null(b"").to_pylist()
            for doc, ids in zip(batch.column("doc_id").to_pylist(), ids_of(texts), strict=True):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    length = len(part) // 4
                    out.append((doc, piece, at // 4, length, zlib.crc32(part), task, int(seen[length])))
                    seen[length] += 1
            if out:
                columns = list(zip(*out, strict=True))
                types = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "number"])

    found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, task long, number long"
    )
    return written(found, "pieces")


def patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """Sequences for a histogram of lengths: (how many, [(length, copies in each)])."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    lengths = np.flatnonzero(left).tolist()
    out = []
    while lengths:
        used: dict[int, int] = {}

        def fill(gap: int) -> int:
            i = bisect_right(lengths, gap) - 1
            while i >= 0 and gap:
                size = lengths[i]
                k = min(int(left[size]) - used.get(size, 0), gap // size)  # noqa: B023
                if k > 0:
                    used[size] = used.get(size, 0) + k  # noqa: B023
                    gap -= k * size
                i = min(i - 1, bisect_right(lengths, gap) - 1)
            return gap

        gap = fill(capacity)
        while gap:
            small = min(used)
            room = gap + small
            free = left[: room + 1].copy()
            for size, k in used.items():
                if size <= room:
                    free[size] -= k
            size = np.flatnonzero(free > 0)
            if not len(size):
                break
            mate = size[np.maximum(np.searchsorted(size, room - size, "right") - 1, 0)]
            total = size + mate
            total[(total > room) | ((mate == size) & (free[size] < 2))] = 0
            best = int(np.argmax(total))
            if total[best] <= small:
                break
            used[small] -= 1
            for s in (int(size[best]), int(mate[best])):
                used[s] = used.get(s, 0) + 1
            used = {s: k for s, k in used.items() if k}
            gap = room - int(total[best])
        many = min(int(left[s]) // k for s, k in used.items())
        for s, k in used.items():
            left[s] -= many * k
            if not left[s]:
                lengths.remove(s)
        out.append((many, sorted(used.items(), reverse=True)))
    return out


def _slots(found: list[tuple[int, list[tuple[int, int]]]]) -> dict[str, np.ndarray]:
    """Runs of piece numbers with one pattern, by length and first number."""
    next_number: dict[int, int] = {}
    rows, sequence = [], 0
    for many, content in found:
        offset = 0
        for length, k in content:
            first = next_number.get(length, 0)
            rows.append((length, first, k, sequence, offset))
            next_number[length] = first + many * k
            offset += length * k
        sequence += many
    rows.sort()
    names = ("length", "first", "copies", "sequence", "offset")
    return {n: np.array([r[i] for r in rows], np.int64) for i, n in enumerate(names)}


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset`` of every piece."""
    spark = docs.sparkSession
    found = pieces(docs, tokenizer, capacity)
    counts = written(found.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "lengths")
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    counted = counts.groupBy("length").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("tasks")).collect()
    # Their file has few bytes a row, so that Spark takes many for small.
    base = by_rows(base, sum(r.tasks for r in counted))
    histogram = {r.length: r.n for r in counted}
    slots = spark.sparkContext.broadcast(_slots(patterns(histogram, capacity)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = slots.value
        key = s["length"] << 48 | s["first"]
        for batch in batches:
            length, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            i = np.searchsorted(key, length << 48 | number, "right") - 1
            t = number - s["first"][i]
            sequence = s["sequence"][i] + t // s["copies"][i]
            offset = s["offset"][i] + t % s["copies"][i] * length
            yield pa.record_batch([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=[*batch.schema.names[:5], "sequence_id", "offset"])

    numbered = found.join(base, ["length", "task"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("number") + F.col("base")).alias("number"))
    return numbered.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
