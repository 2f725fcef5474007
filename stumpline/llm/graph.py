"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stumpline.llm.common import forget, written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (smallest node reachable) for every node of the edges ``a``, ``b`` (longs).

    Large-star and small-star rounds: each node points its larger neighbours, then its smaller ones, at the
    smallest node it knows, until nothing changes. Every round is a few joins and partial minima; nothing
    is collected. Loops and edges with a null end are ignored; no edges give no rows.
    """
    edges = edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = written(edges.distinct(), "edges")
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
        after = written(small.select("e.a", F.col("e.m").alias("b")).filter("a <> b").distinct(), "edges")
        new = _state(after)
        forget(now)
        now = after
        if new == state:
            break
        state = new
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
