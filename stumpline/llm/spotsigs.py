"""SpotSigs fingerprints: short chains of content words that follow common words.

Words are runs between blanks and ASCII punctuation, lower-cased. Each common word is an anchor; with the next
``CHAIN`` content words among the ``REACH`` words after it, it makes a signature (fewer when there are fewer). A
fingerprint is the sorted set of 32-bit signature hashes. A text without anchors takes every word as one. Two
fingerprints compare by Jaccard.

``near_pairs`` partitions sets by length so that only neighbouring partitions can reach the threshold, indexes
the rarest signatures of each set (any two sets over the threshold share one of them), and verifies candidates
whose lengths allow the threshold. Equal fingerprints are one class.

Null and empty texts have an empty fingerprint; two empty ones are alike (1.0), an empty and another one are not
(0.0). Fully repeated rows are one document in the order, whose result every one of them has; rows with the same id and
other text are told apart by text. A null id comes last in the descending order. Extra columns change nothing. An empty
table gives no rows, and a single document's next one is itself.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stumpline.llm.common import written

#: Common words of the four languages.
ANCHORS = (
    "the of and to in a is that it for on was be with as by at this are from or an not have he his had which you but "
    "der die das und ist ein eine nicht von zu den mit sich des auf im dem auch es an werden aus er hat dass sie "
    "le la les de des et un une en du est que pour dans ce il qui au sur se pas plus par je avec "
    "el los las y que en un una por con no su para es al lo como más o pero sus"
).split()
CHAIN = 2
REACH = 8
SPLIT = r"[\s\p{Punct}]+"


def _words(text: str) -> Column:
    return F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), SPLIT)


def _signatures(words: str) -> Column:
    """Sorted set of signature hashes of a column of words."""
    w = F.col(words)
    content = lambda x: (x != "") & ~x.isin(ANCHORS)

    def chain(x: Column, i: Column) -> Column:
        return F.hash(x, F.slice(F.filter(F.slice(w, i + 2, REACH), content), 1, CHAIN))

    at_anchors = F.filter(F.transform(w, lambda x, i: F.when(x.isin(ANCHORS), chain(x, i))), lambda s: s.isNotNull())
    at_all = F.filter(F.transform(w, lambda x, i: F.when(x != "", chain(x, i))), lambda s: s.isNotNull())
    return F.sort_array(F.array_distinct(F.when(F.exists(w, lambda x: x.isin(ANCHORS)), at_anchors).otherwise(at_all)))


def with_signatures(df: DataFrame, text: str, column: str) -> DataFrame:
    """``df`` with the fingerprint (array of int) of ``text``."""
    words = f"__words_{column}"
    return df.withColumn(words, _words(text)).withColumn(column, _signatures(words)).drop(words)


def fingerprint(signatures: str | Column) -> Column:
    """A fingerprint as a string: its hashes in order, comma-joined."""
    col = F.col(signatures) if isinstance(signatures, str) else signatures
    return F.array_join(col.cast("array<string>"), ",")


def likeness(a: str, b: str) -> Column:
    """Jaccard of two fingerprints."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / F.greatest(either, F.lit(1)))


def near_pairs(docs: DataFrame, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(``doc_id``, ``class_id`` of every row; ``a``, ``b``, ``likeness`` of classes with Jaccard >= ``threshold``).

    A class is the documents with one fingerprint, named by the fingerprint's 64-bit hash. Empty fingerprints are a
    class without pairs.
    """
    marked = with_signatures(docs.select(F.col("doc_id").cast("long"), "text"), "text", "sigs")
    members = written(marked.select("doc_id", F.xxhash64("sigs").alias("class_id"), "sigs"), "spots")
    sets = written(members.select("class_id", "sigs").dropDuplicates(["class_id"]), "sets")
    size = F.size("sigs")
    # Partition k holds lengths in [t^-k, t^-(k+1)); sets over the threshold are in one partition or two neighbours.
    part = F.floor(F.log(size.cast("double")) / F.lit(-math.log(threshold)) + F.lit(1e-9)).cast("int").alias("part")
    spots = sets.filter(size > 0).select("class_id", size.alias("n"), part, F.explode("sigs").alias("spot"))
    common = spots.groupBy("spot").agg(F.count(F.lit(1)).alias("df"))
    ranked = spots.join(common, "spot").groupBy("class_id", "n", "part").agg(F.sort_array(F.collect_list(F.struct("df", "spot"))).alias("s"))
    rarest = F.slice("s", 1, (F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1).cast("int"))
    index = written(ranked.select("class_id", "n", "part", F.explode(rarest).alias("r")).select("class_id", "n", "part", "r.spot"), "rare")
    left = index.select(F.col("class_id").alias("a"), F.col("n").alias("n_a"), F.explode(F.array("part", F.col("part") + 1)).alias("part"), "spot", F.col("part").alias("own"))
    right = index.select(F.col("class_id").alias("b"), F.col("n").alias("n_b"), "part", "spot")
    able = (F.col("n_b") * threshold <= F.col("n_a") + 1e-9) & (F.col("n_a") * threshold <= F.col("n_b") + 1e-9)
    once = (F.col("own") < F.col("part")) | (F.col("a") < F.col("b"))
    found = left.join(right, ["part", "spot"]).filter(able & once).select("a", "b").distinct()
    sides = found.join(sets.select(F.col("class_id").alias("a"), F.col("sigs").alias("x")), "a").join(sets.select(F.col("class_id").alias("b"), F.col("sigs").alias("y")), "b")
    pairs = sides.withColumn("likeness", likeness("x", "y")).filter(F.col("likeness") >= threshold)
    return members.select("doc_id", "class_id"), pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "likeness")


def next_rows(rows: DataFrame) -> DataFrame:
    """``rows`` (``doc_id``, ``hash``, ...) with ``next_id`` and ``next_hash``: the following row in descending order.

    After the last row comes the first. Rows are cut into ranges; within a range a window looks ahead, and the last
    row of a range takes the first of the next one that has rows (one row for each range).
    """
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("hash").desc()]
    cut = written(rows.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id()), "ranges")
    w = Window.partitionBy("range").orderBy(*order)
    ahead = cut.withColumns({"after": F.lead(F.struct("doc_id", "hash")).over(w), "place": F.row_number().over(w)})
    heads = ahead.filter("place = 1").select("range", F.struct("doc_id", "hash").alias("head"))
    around = Window.orderBy("range")
    first = F.first("head").over(around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select("range", F.coalesce(F.lead("head").over(around), first).alias("following"))
    found = ahead.join(heads, "range").withColumn("after", F.coalesce("after", "following"))
    return found.select(*rows.columns, F.col("after.doc_id").alias("next_id"), F.col("after.hash").alias("next_hash"))


def edited_likeness(docs: DataFrame) -> DataFrame:
    """Every text against its edited form and the next document, with both fingerprints.

    The last third (floor) of a text gives way to as many first characters of the next document, in descending
    order of doc_id. Texts are shuffled once, by row; a document sends its successor's first characters only.
    """
    lowest = F.lit(-(1 << 63))  # stands for a null id
    text = F.coalesce("text", F.lit("")).alias("text")
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), lowest).alias("key"), F.xxhash64("text").alias("hash"), text)
    order = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("hash"), F.coalesce(F.length("text"), F.lit(0)).alias("n_chars"))
    order = written(order.groupBy("doc_id", "hash", "n_chars").agg(F.count(F.lit(1)).alias("n")), "rows")
    after = next_rows(order).select(
        F.coalesce("doc_id", lowest).alias("to_key"), F.col("hash").alias("to_hash"), "n_chars", "n",
        F.coalesce("next_id", lowest).alias("key"), F.col("next_hash").alias("hash"),
    )
    after = written(after, "next")
    repeated = not order.filter("n > 1").isEmpty()
    if repeated:
        rows = rows.dropDuplicates(["key", "hash"])
    # Both joins below read this one exchange.
    texts = rows.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key", "hash")
    sent = texts.join(after, ["key", "hash"]).select("to_key", "to_hash", F.expr("substring(text, 1, n_chars div 3)").alias("prefix"), "text", "n")
    sent = with_signatures(sent, "text", "next_sigs").select(F.col("to_key").alias("key"), F.col("to_hash").alias("hash"), "prefix", "next_sigs", "n")
    own = texts.join(sent, ["key", "hash"]).withColumn("n_chars", F.length("text").cast("long"))
    own = own.withColumn("edited", F.expr("concat(substring(text, 1, CAST(n_chars - n_chars div 3 AS INT)), prefix)"))
    own = with_signatures(with_signatures(own, "text", "sigs"), "edited", "edited_sigs")
    out = own.select(
        F.nullif("key", lowest).alias("doc_id"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint("sigs").alias("fingerprint"),
        fingerprint("edited_sigs").alias("edited_fingerprint"), likeness("sigs", "edited_sigs").alias("near_edited"), likeness("sigs", "next_sigs").alias("near_next"), "n",
    )
    return _each(out) if repeated else out.drop("n")


def _each(rows: DataFrame, step: int = 1_000) -> DataFrame:
    """Every row ``n`` times; rows of many copies are dealt over all tasks in parts of ``step``."""
    parts = F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / step))
    dealt = rows.filter("n > 1").withColumn("part", F.explode(parts)).repartition("doc_id", "edited_sha256", "part")
    copies = dealt.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(step), F.col("n") - step * F.col("part")))))
    return rows.filter("n = 1").unionByName(copies.drop("part", "copy")).drop("n")
