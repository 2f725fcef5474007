"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked at few differing bits.

With two segments of 32 bits, two fingerprints that differ in at most two bits have a segment that differs in
at most one. Each segment is indexed 32 times, each time with another bit masked (its one-wildcard variants);
fingerprints that share a variant are joined on it and verified. Copies count once. A variant shared by more
than ``BUCKET`` fingerprints is not expanded into pairs: its members are indexed by all their one-bit
neighbours instead. Fingerprints with a common neighbour differ in two bits at most and any two that differ
in one or two bits have one, so a star over each neighbour (at most 65 members) loses no link.

Joins of fingerprints are by shuffle: each has 64 variants, far more rows than Spark expects of an explode, and
a broadcast of them fills the driver.

Null and empty texts have fingerprint zero. Fingerprints belong to texts, so repeated rows share one. A null
doc_id never names a component unless all its ids are null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stumpline.llm import bytescan
from stumpline.llm.common import bounded_batches, by_rows, by_shuffle, per_batch, written
from stumpline.llm.graph import components

WORDS = 3
SEED = 42
DISTANCE = 2
BUCKET = 32
_CHUNK = 1 << 17


def fingerprint_array(texts: pa.Array, words: int = WORDS) -> np.ndarray:
    """Signed 64-bit SimHash of each text."""
    data, offsets = bytescan.utf8(texts)
    data = bytescan.lower(data)
    starts, ends, row = bytescan.spans(data, offsets, bytescan.NOT_SPACE)
    n = len(offsets) - 1
    size = ends - starts
    # Words with one blank after each, so that a shingle is a slice.
    joined = np.full(int(size.sum()) + len(size), 0x20, np.uint8)
    to = np.cumsum(size + 1) - size - 1
    inside = bytescan.NOT_SPACE[data] == 1
    joined[np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)] = data[inside]
    count = np.bincount(row, minlength=n)
    first = np.cumsum(count) - count
    last = np.minimum(np.arange(len(row)) + words - 1, (first + count - 1)[row])
    keep = (np.arange(len(row)) + words <= (first + count)[row]) | ((np.arange(len(row)) == first[row]) & (count[row] < words))
    a, b, row = to[keep], (to + size)[last[keep]], row[keep]
    raw, digest = joined.tobytes(), xxhash.xxh64_digest
    ones = np.zeros((n, 64), np.int64)
    for i in range(0, len(a), _CHUNK):
        part = slice(i, i + _CHUNK)
        packed = b"".join([digest(raw[x:y], SEED) for x, y in zip(a[part].tolist(), b[part].tolist(), strict=True)])
        bits = np.unpackbits(np.frombuffer(packed, np.uint8).reshape(-1, 8), axis=1)
        which, at = np.unique(row[part], return_index=True)
        ones[which] += np.add.reduceat(bits, at, axis=0, dtype=np.int32)
    total = np.bincount(row, minlength=n)
    return np.packbits(2 * ones > total[:, None], axis=1).view(">i8").astype(np.int64).ravel()


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id``, ``text_hash`` (64-bit, tells rows with the same id apart) and ``fp`` of every row, as a written table."""
    bounded_batches(docs.sparkSession)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array(fingerprint_array(batch.column("text"), words))],
            names=["doc_id", "text_hash", "fp"],
        )

    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash"))
    return written(rows.mapInArrow(per_batch(run), "doc_id long, text_hash long, fp long"), "simhash")


def _variants(fps: DataFrame) -> DataFrame:
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned("fp", 32)
    keys = [
        F.lit((32 * s + bit) << 32).bitwiseOR(seg.bitwiseAND(F.lit(0xFFFFFFFF ^ (1 << bit))))
        for s, seg in enumerate((low, high))
        for bit in range(32)
    ]
    return fps.select("fp", F.explode(F.array(*keys)).alias("key"))


def links(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Edges ``a``, ``b`` that connect exactly the distinct fingerprints at most two bits apart."""
    index = _variants(fps)
    shared = index.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = written(index.join(by_shuffle(shared), "key"), "variants")
    few = members.filter(F.col("n") <= bucket).select("key", F.col("fp").alias("a"))
    other = few.select("key", F.col("a").alias("b"))
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    pairs = few.join(by_shuffle(other), "key").filter((F.col("a") < F.col("b")) & (apart <= DISTANCE)).select("a", "b")
    crowded = members.filter(F.col("n") > bucket).select("fp").distinct()
    flips = [F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit((1 << b) - (1 << 64) * (b == 63))) for b in range(64)]]
    around = crowded.select("fp", F.explode(F.array(*flips)).alias("middle"))
    centre = around.groupBy("middle").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    star = around.join(by_shuffle(centre.drop("n")), "middle").filter("fp <> b").select(F.col("fp").alias("a"), "b")
    return pairs.unionByName(star).distinct()


def component_ids(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``fp``, ``root`` and ``component_id`` (smallest doc_id) of every distinct fingerprint."""
    each = written(prints.groupBy("fp").agg(F.min("doc_id").alias("lo")), "prints")
    roots = components(links(each.select("fp"), bucket)).withColumnRenamed("node", "fp")
    each = each.join(by_shuffle(roots), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = each.groupBy("root").agg(F.min("lo").alias("component_id"))
    return written(each.join(by_shuffle(ids), "root").select("fp", "root", "component_id"), "components")


def near_duplicates(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row."""
    prints = fingerprints(docs)
    found = prints.join(by_shuffle(component_ids(prints, bucket)), "fp")
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row with the smallest doc_id stays.

    Of rows with that id the one with the smallest text hash stays, and of rows with equal ids and texts one.
    """
    prints = fingerprints(docs)
    roots = component_ids(prints, bucket).select("fp", "root")
    rows = prints.groupBy("fp", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    order = F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "text_hash", "n")
    best = rows.join(by_shuffle(roots), "fp").groupBy("root").agg(F.min(order).alias("r"))
    # Names that no column of the documents is expected to have.
    kept_id, kept_hash, many = (f"__stumpline_{name}" for name in ("id", "hash", "many"))
    best = written(best.select(F.col("r.doc_id").alias(kept_id), F.col("r.text_hash").alias(kept_hash), F.col("r.n").alias(many)), "kept")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(kept_id)) & (F.xxhash64("text") == F.col(kept_hash))
    one = F.col(many) == 1
    groups = best.agg(F.count_if(one).alias("single"), F.count_if(~one).alias("repeated")).first()
    once = docs.join(by_rows(best.filter(one), groups.single), same, "left_semi")
    if not groups.repeated:
        return once
    return once.unionByName(docs.join(by_rows(best.filter(~one), groups.repeated), same, "left_semi").dropDuplicates(["doc_id", "text"]))
