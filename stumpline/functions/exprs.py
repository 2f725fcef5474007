"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_int(col: Column, default: int) -> Column:
    """Lenient integer: unparsable or missing values become ``default``, fractions are cut."""
    return F.coalesce(col.cast("string").try_cast("double").try_cast("int"), F.lit(default))


def title_case(col: Column) -> Column:
    """Trimmed text with a capital after every non-letter, not only after spaces.

    Only names with a letter right after a mark or digit need the split.
    """
    text = F.trim(col)
    pieces = F.split(F.lower(text), r"(?<=[^\p{L}])|(?=[^\p{L}])")
    marked = F.rlike(text, F.lit(r"[^\p{L} ]\p{L}"))
    return F.when(marked, F.array_join(F.transform(pieces, F.initcap), "")).otherwise(F.initcap(text))


def at_least(col: Column, floor: float) -> Column:
    return F.greatest(col, F.lit(floor))


def clip(col: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(col, F.lit(low)), F.lit(high))


def flag_sum(cond: Column) -> Column:
    """Number of rows where ``cond`` holds."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def sum_where(value: Column, cond: Column) -> Column:
    return F.sum(F.when(cond, value).otherwise(F.lit(0)))


def bowled_wide(prefix: str = "wides") -> Column:
    return F.coalesce(F.col(prefix), F.lit(0)) > 0


def legal_ball() -> Column:
    """Neither a wide nor a no-ball."""
    return (F.coalesce(F.col("wides"), F.lit(0)) <= 0) & (F.coalesce(F.col("noballs"), F.lit(0)) <= 0)


def boundary_ball() -> Column:
    """Four or more off the bat, not a wide."""
    return (F.col("runs_off_bat") >= 4) & (F.coalesce(F.col("wides"), F.lit(0)) == 0)


def six_ball() -> Column:
    return (F.col("runs_off_bat") >= 6) & (F.coalesce(F.col("wides"), F.lit(0)) == 0)


def dot_ball() -> Column:
    """Nothing off the bat on a legal ball."""
    return (F.col("runs_off_bat") == 0) & legal_ball()


def rate(num: Column, den: Column, scale: float = 1.0) -> Column:
    """``num / max(den, 1) * scale`` in double arithmetic."""
    return num.cast("double") / F.greatest(den, F.lit(1)) * F.lit(float(scale))
