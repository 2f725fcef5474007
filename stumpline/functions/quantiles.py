"""Exact linear-interpolation quantiles without gathering the values in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stumpline.functions.scan import Running, Total, hot_groups, scan


def exact_quantiles(
    df: DataFrame, value: str, probs: Mapping[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """One row per ``by`` group (one row in all without ``by``) with a column per quantile.

    Equal values are counted first, so the ranked input has one row per distinct value.
    """
    counts = (
        df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_c"))
    )
    # Rows bound the distinct values, and counting them needs none of the value's columns.
    hot = hot_groups(df, list(by))
    ranked = scan(counts, list(by), [value], hot, _upto=Running(F.col("_c")), _all=Total(F.col("_c")))

    def at(rank: Column) -> Column:
        inside = (F.col("_upto") >= rank) & (F.col("_upto") - F.col("_c") < rank)
        return F.max(F.when(inside, F.col(value).cast("double")))

    aggs = []
    for name, q in probs.items():
        pos = (F.col("_all") - 1) * F.lit(float(q))
        frac = F.max(pos - F.floor(pos))
        low, high = at(F.floor(pos) + 1), at(F.ceil(pos) + 1)
        aggs.append((low + (high - low) * frac).alias(name))
    return ranked.groupBy(*by).agg(*aggs)


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach every column of a one-row aggregate to ``df`` as a scalar subquery."""
    packed = one_row.select(F.struct(*one_row.columns).alias("_s"))
    out = df.withColumn("_one", packed.scalar())
    for c in one_row.columns:
        out = out.withColumn(c, F.col("_one")[c])
    return out.drop("_one")
