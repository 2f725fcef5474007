"""Sharding by extendible hashing: a directory indexed by the leading bits of hashed ids.

All documents start in one bucket; a bucket over the byte limit splits on the next bit, the others stay as they
are. Bytes are summed per cell of ``LEVEL_BITS`` further bits, so a pass over the ids splits buckets by up to so
many bits at once; only documents of buckets that are still too large go on to the next pass. The directory has
2**LEVEL_BITS cells for each bucket that went on, and the depth of a cell's bucket is the smallest at which the
bucket fits.

A bucket whose documents share one hash (repeated rows, one very long text) cannot split: it stays a shard by
itself and is marked ``over_limit``. Null ids hash as empty text; null texts weigh nothing. An empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stumpline.llm.common import written

LIMIT_BYTES = 1 << 20
LEVEL_BITS = 12
HASH_BITS = 48


def hash_bits(doc_id: str) -> Column:
    """48 hashed bits of an id as a string of 0 and 1."""
    hexed = F.substring(F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), 1, HASH_BITS // 4)
    return F.lpad(F.conv(hexed, 16, 2), HASH_BITS, "0")


def directory(sizes: DataFrame, limit: int = LIMIT_BYTES, level_bits: int = LEVEL_BITS) -> DataFrame:
    """Cells (``cell``, leading bits) with their bucket (``shard``, leading bits) from ``bits`` and ``bytes`` of rows."""
    parts: list[DataFrame] = []
    rest, base = sizes, 0
    while True:
        top = min(base + level_bits, HASH_BITS)
        cells = rest.groupBy(F.substring("bits", 1, top).alias("cell")).agg(
            F.sum("bytes").alias("bytes"), F.min("bits").alias("lo"), F.max("bits").alias("hi")
        )
        depths = [F.struct(F.lit(d).alias("depth"), F.substring("cell", 1, d).alias("shard")) for d in range(base, top + 1)]
        cells = written(cells, "cells")
        spread = cells.select("*", F.explode(F.array(*depths)).alias("at"))
        fits = spread.groupBy("at.depth", "at.shard").agg(F.sum("bytes").alias("total"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        fits = fits.filter((F.col("total") <= limit) | (F.col("lo") == F.col("hi"))).select("depth", "shard")
        inside = spread.select("cell", "at.depth", "at.shard").join(fits, ["depth", "shard"])
        found = written(cells.select("cell").join(inside.groupBy("cell").agg(F.min("depth").alias("depth")), "cell", "left"), "depths")
        parts.append(found.filter("depth is not null").select("cell", F.expr("substring(cell, 1, depth)").alias("shard")))
        large = found.filter("depth is null").select("cell")
        if large.isEmpty():
            break
        rest = rest.join(large, F.substring("bits", 1, top) == F.col("cell"), "left_semi")
        base = top
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def assign(docs: DataFrame, limit: int = LIMIT_BYTES, level_bits: int = LEVEL_BITS) -> DataFrame:
    """``doc_id``, ``bytes``, ``shard`` (its hash prefix; empty for a single shard), ``depth``, ``shard_bytes``, ``over_limit``."""
    rows = docs.select("doc_id", hash_bits("doc_id").alias("bits"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"))
    rows = written(rows, "sizes")
    cells = directory(rows, limit, level_bits)
    out = None
    for width in [r[0] for r in cells.select(F.length("cell").alias("w")).distinct().collect()]:  # one for each pass
        part = rows.withColumn("cell", F.substring("bits", 1, width)).join(cells.filter(F.length("cell") == width), "cell")
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = rows.withColumn("cell", F.lit("")).withColumn("shard", F.lit(""))
    total = out.groupBy("shard").agg(F.sum("bytes").alias("shard_bytes"))
    return out.join(total, "shard").select(
        "doc_id", "bytes", "shard", F.length("shard").cast("long").alias("depth"), "shard_bytes", (F.col("shard_bytes") > limit).alias("over_limit")
    )


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT_BYTES) -> None:
    """Write ``docs`` as one folder of Parquet files per shard (``shard=h<bits>``), rows of a shard together."""
    found = assign(docs, limit).select(F.col("doc_id").alias("__stumpline_id"), F.concat(F.lit("h"), "shard").alias("shard")).distinct()
    rows = docs.join(found, F.col("doc_id").eqNullSafe(F.col("__stumpline_id"))).drop("__stumpline_id")
    rows.repartition("shard").write.partitionBy("shard").parquet(path)


SQL = f"""
WITH RECURSIVE r AS (SELECT doc_id, strlen(text) AS bytes, md5(CAST(doc_id AS VARCHAR)) AS m FROM documents),
b AS (SELECT doc_id, bytes, array_to_string([lpad(bin(CAST(strpos('0123456789abcdef', c) - 1 AS BIGINT)), 4, '0') FOR c IN string_split(substr(m, 1, {HASH_BITS // 4}), '')], '') AS bits FROM r),
t AS (SELECT depth, substr(bits, 1, depth) AS shard, sum(bytes) AS shard_bytes, min(bits) AS lo, max(bits) AS hi
    FROM b, (SELECT unnest(range(0, {HASH_BITS} + 1)) AS depth) GROUP BY 1, 2 HAVING sum(bytes) <= {LIMIT_BYTES} OR min(bits) = max(bits)),
f AS (SELECT b.doc_id, b.bytes, b.bits, min(t.depth) AS depth FROM b JOIN t ON substr(b.bits, 1, t.depth) = t.shard GROUP BY 1, 2, 3)
SELECT f.doc_id, CAST(f.bytes AS BIGINT) AS bytes, t.shard, CAST(f.depth AS BIGINT) AS depth,
    CAST(t.shard_bytes AS BIGINT) AS shard_bytes, t.shard_bytes > {LIMIT_BYTES} AS over_limit
FROM f JOIN t ON t.depth = f.depth AND t.shard = substr(f.bits, 1, f.depth)
"""
