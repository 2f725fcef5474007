"""Cross-site boilerplate: lines that many distinct sites share.

Lines are compared without blanks at their ends; empty ones are no candidates. A first count drops lines that
cannot reach ``sites`` (fewer occurrences, or one site only). For the rest HyperLogLog sketches of the sites
merge by aggregation; lines whose estimate is within ``BAND`` of the threshold get exact distinct counts. A
spread line stays in the document with the smallest id that has it and goes from all others, so that the corpus
loses no text.

Null texts have no lines and stay null; a text may become empty. A null site counts as no site. Null ids are one
document. Repeated rows and rows with the same id are one document when the first holder is chosen, and each
loses its lines. An empty table gives no rows. Lines are told apart by 128 bits of hashes.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from stumpline.llm.common import bounded_batches, written

SITES = 8
BAND = 0.15
SKETCH_BITS = 12
SALTS = 32
_ID, _HASH, _CUT = "__stumpline_id", "__stumpline_hash", "__stumpline_cut"


def _occurrences(docs: DataFrame, site: str) -> DataFrame:
    """One row per candidate line: two hashes, document, place in the text, hashed site."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        F.when(F.col(site).isNotNull(), F.xxhash64(site)).alias("site"),
        F.posexplode(F.split("text", "\n")).alias("place", "line"),
    )
    line = F.trim("line")
    return rows.filter(F.length(line) > 0).select(
        F.xxhash64(line).alias("a"), F.xxhash64(line, F.lit(1)).alias("b"), "doc_id", "text_hash", "site", "place"
    )


def spread_lines(docs: DataFrame, site: str = "source", sites: int = SITES) -> DataFrame:
    """``a``, ``b`` (line hashes) and ``first`` (smallest doc_id) of the lines on at least ``sites`` distinct sites."""
    lines = _occurrences(docs, site)
    count = lines.groupBy("a", "b").agg(F.count("site").alias("n"), F.min("site").alias("x"), F.max("site").alias("y"), F.min("doc_id").alias("first"))
    wanted = F.col("n") >= sites
    often = written(count.filter(wanted & (F.col("x") != F.col("y")) if sites > 1 else wanted).select("a", "b", "first"), "lines")
    # A hot line's rows are spread over salts: the salted key is not the join's, so Spark may split its partition.
    salted = lines.filter("site is not null").select("a", "b", "site", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(SALTS)).alias("salt"))
    key = F.col("a").bitwiseXOR(F.col("salt")).alias("key")
    among = salted.join(often, ["a", "b"]).groupBy(key, "b", "salt").agg(F.min("first").alias("first"), F.hll_sketch_agg("site", F.lit(SKETCH_BITS)).alias("sketch"))
    back = F.col("key").bitwiseXOR(F.col("salt")).alias("a")
    merged = among.groupBy(back, "b").agg(F.min("first").alias("first"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("sites"))
    estimate = written(merged, "sketches")
    sure = estimate.filter(F.col("sites") > sites * (1 + BAND)).select("a", "b", "first")
    near = estimate.filter(F.col("sites").between(sites * (1 - BAND), sites * (1 + BAND))).select("a", "b", "first")
    exact = salted.join(near, ["a", "b"]).groupBy(key, "b", "salt", "site").agg(F.min("first").alias("first"))
    exact = exact.select(back, "b", "first", "site").distinct().groupBy("a", "b", "first").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= sites)
    return sure.unionByName(exact.select("a", "b", "first"))


@F.arrow_udf(StringType())
def _without(texts: pa.Array, cuts: pa.Array) -> pa.Array:
    out = []
    for text, cut in zip(texts.to_pylist(), cuts.to_pylist(), strict=True):
        if cut:
            gone = set(cut)
            text = "\n".join([x for i, x in enumerate(text.split("\n")) if i not in gone])
        out.append(text)
    return pa.array(out, pa.string())


def _cut(docs: DataFrame, site: str, sites: int) -> DataFrame:
    """``docs`` with one more column, the places of the lines to remove (null for none)."""
    bounded_batches(docs.sparkSession)
    spread = written(spread_lines(docs, site, sites), "spread")
    gone = _occurrences(docs, site).select("a", "b", "doc_id", "text_hash", "place").join(spread, ["a", "b"])
    gone = gone.filter(~F.col("doc_id").eqNullSafe(F.col("first")))
    places = gone.groupBy(F.col("doc_id").alias(_ID), F.col("text_hash").alias(_HASH)).agg(F.sort_array(F.collect_set("place")).alias(_CUT))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(_ID)) & (F.xxhash64("text") == F.col(_HASH))
    return docs.join(places, same, "left").drop(_ID, _HASH)


def remove_spread(docs: DataFrame, site: str = "source", sites: int = SITES) -> DataFrame:
    """``docs`` without cross-site boilerplate; ``n_chars`` is counted anew, all rows stay."""
    out = _cut(docs, site, sites).withColumn("text", _without("text", _CUT)).drop(_CUT)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def _lines(text: str) -> Column:
    return F.when(F.col(text).isNull(), 0).otherwise(F.size(F.split(text, "\n")))


def digest(docs: DataFrame, site: str = "source", sites: int = SITES) -> DataFrame:
    """``doc_id``, ``n_lines``, ``n_removed``, ``kept_chars`` and ``kept_sha256`` of every row."""
    found = _cut(docs.select("doc_id", "text", site), site, sites)
    kept = found.withColumn("kept", _without("text", _CUT))
    return kept.select(
        "doc_id", _lines("text").cast("long").alias("n_lines"), F.coalesce(F.size(_CUT), F.lit(0)).cast("long").alias("n_removed"),
        F.length("kept").cast("long").alias("kept_chars"), F.sha2("kept", 256).alias("kept_sha256"),
    )


SQL = f"""
WITH l AS (SELECT doc_id, source, place, trim(line, ' ') AS line FROM (
    SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place
    FROM documents) WHERE length(trim(line, ' ')) > 0),
spread AS (SELECT line, min(doc_id) AS first FROM l GROUP BY line HAVING count(DISTINCT source) >= {SITES}),
gone AS (SELECT doc_id, list(place) AS places FROM l JOIN spread USING (line) WHERE doc_id <> first GROUP BY doc_id),
kept AS (SELECT d.doc_id, string_split(d.text, chr(10)) AS lines, coalesce(g.places, []) AS places FROM documents d LEFT JOIN gone g USING (doc_id)),
cut AS (SELECT doc_id, len(lines) AS n_lines, len(places) AS n_removed,
    array_to_string(list_filter(lines, lambda x, i: NOT list_contains(places, i)), chr(10)) AS kept FROM kept)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_removed AS BIGINT) AS n_removed,
    CAST(length(kept) AS BIGINT) AS kept_chars, sha256(kept) AS kept_sha256 FROM cut
"""
