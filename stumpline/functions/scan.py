"""Ordered per-group calculations that survive hot groups.

A plain ``Window.partitionBy(keys)`` puts each group into one task. That is the
right plan while groups are small, and ``scan`` uses it then: one exchange and
one sort for all requested columns. When a group holds more rows than one task
should sort, ``scan`` range-partitions the rows of the hot groups on
(keys, order), solves every slice on its own and carries slice summaries
forward. The summaries number at most (slices + hot groups) rows; up to
``MAX_BROADCAST_ROWS`` they are broadcast, more are joined by a shuffle. Both
routes give the same rows.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stumpline.session import ensure_checkpoint_dir, stored

HOT_ROWS_CONF = "spark.stumpline.hotGroupRows"
HOT_ROWS_DEFAULT = 1_000_000
# The largest hot groups are listed and broadcast. Hot groups beyond the list are a table, joined by a shuffle:
# each has less than 1/MAX_LISTED of the rows.
MAX_LISTED = 10_000
MAX_BROADCAST_ROWS = 100_000
# Answers of hot_groups that are kept for the same files.
MAX_REMEMBERED = 256


@dataclass(frozen=True)
class Hot:
    """Groups too large for one task: (keys..., rows) of the largest, and a table of the keys of any further ones."""

    listed: list[tuple] = field(default_factory=list)
    more: DataFrame | None = None
    groups: int = 0
    rows: int = 0

    def __bool__(self) -> bool:
        return self.groups > 0


NO_HOT = Hot()
_remembered: OrderedDict[tuple, Hot] = OrderedDict()


@dataclass(frozen=True)
class Running:
    """Inclusive running sum."""

    value: Column


@dataclass(frozen=True)
class Total:
    """Sum over the whole group, on every row."""

    value: Column


@dataclass(frozen=True)
class RowNumber:
    """1-based position in the group."""


@dataclass(frozen=True)
class Lag:
    """Value ``n`` rows earlier, null when there is none."""

    value: Column
    n: int = 1


@dataclass(frozen=True)
class Trailing:
    """Sum over the current row and the ``n - 1`` rows before it."""

    value: Column
    n: int


@dataclass(frozen=True)
class Since:
    """Running sum that restarts at every row where ``reset`` holds (that row included)."""

    reset: Column
    value: Column


@dataclass(frozen=True)
class Last:
    """Latest non-null value up to and including the row; null before the first."""

    value: Column


Op = Running | Total | RowNumber | Lag | Trailing | Since | Last


def hot_rows_limit(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(HOT_ROWS_CONF, str(HOT_ROWS_DEFAULT)))


def hot_groups(df: DataFrame, keys: Sequence[str]) -> Hot:
    """Groups too large for one task.

    One partially aggregated count over the key columns; everything else is pruned. The answer only
    steers the physical route, never the result. It is kept for plans that read the same bytes (a
    grown table is counted again), and that of a larger table may be passed on to tables derived from it.
    """
    limit = hot_rows_limit(df)
    narrow = df.select(*keys) if keys else df.select(F.lit(1).alias("_one"))
    plan = narrow._jdf.queryExecution().optimizedPlan()
    known = (
        df.sparkSession.sparkContext.applicationId, plan.semanticHash(), plan.canonicalized().toString(),
        str(plan.stats().sizeInBytes()), tuple(keys), limit, MAX_LISTED,
    )
    if known not in _remembered:
        counts = narrow.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit)
        _remembered[known] = _found(counts, keys)
        while len(_remembered) > MAX_REMEMBERED:
            _remembered.popitem(last=False)
    return _remembered[known]


def _found(counts: DataFrame, keys: Sequence[str]) -> Hot:
    top = [tuple(r) for r in counts.orderBy(F.desc("_n"), *keys).limit(MAX_LISTED + 1).collect()]
    if len(top) <= MAX_LISTED:
        return Hot(top, None, len(top), sum(r[-1] for r in top))
    table = stored(counts, "hot")
    total = table.agg(F.count(F.lit(1)).alias("groups"), F.sum("_n").alias("rows")).first()
    return Hot(top[:MAX_LISTED], table.select(*keys), total["groups"], total["rows"])


def hot_frame(df: DataFrame, keys: Sequence[str], hot: Hot) -> DataFrame:
    schema = df.select(*keys).schema
    rows = [tuple(h[: len(keys)]) for h in hot.listed]
    return F.broadcast(df.sparkSession.createDataFrame(rows, schema))


def null_safe_join(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join where null matches null."""
    right = other.select(*[F.col(k).alias(f"_r_{k}") for k in keys])
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return df.join(right, cond, how)


def _split(df: DataFrame, keys: Sequence[str], hot: Hot) -> tuple[DataFrame, DataFrame]:
    """The rows of other groups and those of hot groups."""
    listed = hot_frame(df, keys, hot)
    cold, heavy = null_safe_join(df, listed, keys, "left_anti"), null_safe_join(df, listed, keys, "left_semi")
    if hot.more is not None:
        heavy = heavy.unionByName(null_safe_join(cold, hot.more, keys, "left_semi"))
        cold = null_safe_join(cold, hot.more, keys, "left_anti")
    return cold, heavy


def _plain(df: DataFrame, keys: Sequence[str], order: Sequence, ops: dict[str, Op]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first: dict[str, Column] = {}
    second: dict[str, Column] = {}
    third: dict[str, Column] = {}
    drop: list[str] = []
    for name, op in ops.items():
        if isinstance(op, Running):
            first[name] = F.sum(op.value).over(upto)
        elif isinstance(op, Total):
            first[name] = F.sum(op.value).over(whole)
        elif isinstance(op, RowNumber):
            first[name] = F.row_number().over(w).cast("long")
        elif isinstance(op, Lag):
            first[name] = F.lag(op.value, op.n).over(w)
        elif isinstance(op, Last):
            first[name] = F.last(op.value, ignorenulls=True).over(upto)
        elif isinstance(op, Trailing):
            first[name] = F.sum(op.value).over(w.rowsBetween(-(op.n - 1), 0))
        else:
            run, base = f"_run_{name}", f"_base_{name}"
            first[run] = F.sum(op.value).over(upto)
            mark = F.when(op.reset, F.col(run) - op.value)
            second[base] = F.last(mark, ignorenulls=True).over(upto)
            third[name] = F.col(run) - F.coalesce(F.col(base), F.lit(0))
            drop += [run, base]
    out = df.withColumns(first)
    if second:
        out = out.withColumns(second).withColumns(third).drop(*drop)
    return out


def _sliced(df: DataFrame, keys: Sequence[str], order: Sequence, ops: dict[str, Op], hot: Hot) -> DataFrame:
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    slices = max(2, shuffle, -(-hot.rows // hot_rows_limit(df)))
    # The slice number must not change between the two readers below, hence the checkpoint.
    ranged = (
        df.repartitionByRange(slices, *keys, *order).withColumn("_slice", F.spark_partition_id()).checkpoint()
    )
    part = [*keys, "_slice"]
    w = Window.partitionBy(*part).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    local: dict[str, Column] = {"_rn": F.row_number().over(w), "_cn": F.count(F.lit(1)).over(whole)}
    local2: dict[str, Column] = {}
    for name, op in ops.items():
        if isinstance(op, (Running, Since)):
            local[f"_l_{name}"] = F.sum(op.value).over(upto)
        if isinstance(op, Since):
            mark = F.when(op.reset, F.col(f"_l_{name}") - op.value)
            local2[f"_b_{name}"] = F.last(mark, ignorenulls=True).over(upto)
        if isinstance(op, Last):
            local[f"_l_{name}"] = F.last(op.value, ignorenulls=True).over(upto)
        if isinstance(op, Lag):
            local[f"_l_{name}"] = F.lag(op.value, op.n).over(w)
            local[f"_v_{name}"] = op.value
        if isinstance(op, Trailing):
            local[f"_l_{name}"] = F.sum(op.value).over(w.rowsBetween(-(op.n - 1), 0))
            local[f"_v_{name}"] = op.value
        if isinstance(op, Total):
            local[f"_v_{name}"] = op.value
    step = ranged.withColumns(local)
    if local2:
        step = step.withColumns(local2)

    aggs = [F.count(F.lit(1)).alias("_n")]
    for name, op in ops.items():
        if isinstance(op, (Running, Since, Last)):
            aggs.append(F.max_by(F.col(f"_l_{name}"), F.col("_rn")).alias(f"_s_{name}"))
        if isinstance(op, Total):
            aggs.append(F.sum(F.col(f"_v_{name}")).alias(f"_s_{name}"))
        if isinstance(op, Since):
            aggs.append(F.max_by(F.col(f"_b_{name}"), F.col("_rn")).alias(f"_e_{name}"))
        if isinstance(op, (Lag, Trailing)):
            near_end = F.when(
                F.col("_cn") - F.col("_rn") < op.n, F.struct("_rn", F.col(f"_v_{name}").alias("v"))
            )
            aggs.append(F.sort_array(F.collect_list(near_end)).alias(f"_t_{name}"))
    summary = step.groupBy(*part).agg(*aggs)

    w2 = Window.partitionBy(*keys).orderBy("_slice")
    before = w2.rowsBetween(Window.unboundedPreceding, -1)
    all2 = w2.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carry: dict[str, Column] = {"_o_n": F.coalesce(F.sum("_n").over(before), F.lit(0))}
    carry2: dict[str, Column] = {}
    for name, op in ops.items():
        if isinstance(op, (Running, Since)):
            carry[f"_o_{name}"] = F.coalesce(F.sum(f"_s_{name}").over(before), F.lit(0))
        if isinstance(op, Last):
            carry[f"_o_{name}"] = F.last(f"_s_{name}", ignorenulls=True).over(before)
        if isinstance(op, Total):
            carry[f"_o_{name}"] = F.sum(f"_s_{name}").over(all2)
        if isinstance(op, Since):
            mark = F.when(F.col(f"_e_{name}").isNotNull(), F.col(f"_o_{name}") + F.col(f"_e_{name}"))
            carry2[f"_c_{name}"] = F.col(f"_o_{name}") - F.coalesce(
                F.last(mark, ignorenulls=True).over(before), F.lit(0)
            )
        if isinstance(op, (Lag, Trailing)):
            # Every earlier slice of the group has a row, so n slices hold the n wanted rows.
            carry[f"_h_{name}"] = F.flatten(F.collect_list(f"_t_{name}").over(w2.rowsBetween(-op.n, -1)))
    offsets = summary.withColumns(carry)
    if carry2:
        offsets = offsets.withColumns(carry2)
    keep = [c for c in offsets.columns if c[:3] in ("_o_", "_c_", "_h_")]
    offsets = offsets.select(*[F.col(k).alias(f"_k_{k}") for k in part], *keep)
    cond = F.lit(True)
    for k in part:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    small = slices + hot.groups <= MAX_BROADCAST_ROWS
    joined = step.join(F.broadcast(offsets) if small else offsets, cond)

    rn = F.col("_rn")
    final: list[Column] = [F.col(c) for c in df.columns if c not in ops]
    for name, op in ops.items():
        here = F.col(f"_l_{name}")
        if isinstance(op, Running):
            col = F.col(f"_o_{name}") + here
        elif isinstance(op, Total):
            col = F.col(f"_o_{name}")
        elif isinstance(op, Last):
            col = F.coalesce(here, F.col(f"_o_{name}"))
        elif isinstance(op, RowNumber):
            col = F.col("_o_n") + rn
        elif isinstance(op, Since):
            base = F.col(f"_b_{name}")
            col = F.when(base.isNotNull(), here - base).otherwise(F.col(f"_c_{name}") + here)
        else:
            halo = F.col(f"_h_{name}")
            size = F.size(halo)
            if isinstance(op, Lag):
                back = F.lit(op.n) - rn + 1
                col = F.when(rn > op.n, here).when(size >= back, F.get(halo, size - back)["v"])
            else:
                take = F.least(F.lit(op.n) - rn, size)
                tail = F.slice(halo, size - take + 1, F.greatest(take, F.lit(0)))
                zero = F.lit(0).cast(step.schema[f"_l_{name}"].dataType)
                more = F.aggregate(tail, zero, lambda a, x: a + x["v"])
                col = F.when(take > 0, here + more).otherwise(here)
        final.append(col.alias(name))
    return joined.select(*final)


def scan(
    df: DataFrame, keys: Sequence[str], order: Sequence, hot: Hot | None = None, **ops: Op
) -> DataFrame:
    """Add one column per op, computed per ``keys`` group in ``order``.

    ``order`` has to identify a row within its group, or the result of ties is arbitrary.
    Values of sums are expected to be non-null. ``hot`` passes what ``hot_groups`` has already
    found for these keys.
    """
    if hot is None:
        hot = hot_groups(df, keys)
    if not hot:
        return _plain(df, keys, order, ops)
    if not keys:
        return _sliced(df, keys, order, ops, hot)
    cold, heavy = _split(df, keys, hot)
    return _plain(cold, keys, order, ops).unionByName(_sliced(heavy, keys, order, ops, hot))


def lookup(
    df: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "left", hot: Hot | None = None
) -> DataFrame:
    """Join ``other`` (unique on ``keys``) to ``df``, spreading the listed hot keys over salts."""
    if hot is None:
        hot = hot_groups(df, keys)
    if not hot:
        return df.join(other, list(keys), how)
    salts = max(2, -(-hot.listed[0][-1] // hot_rows_limit(df)))
    listed = hot_frame(df, keys, hot).withColumn("_hot", F.lit(True))
    many = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    left = df.join(listed, list(keys), "left").withColumn(
        "_salt",
        F.when(F.col("_hot"), F.pmod(F.xxhash64(*df.columns), F.lit(salts))).otherwise(F.lit(0)).cast("int"),
    )
    right = other.join(listed, list(keys), "left").withColumn("_salt", F.explode(many)).drop("_hot")
    return left.drop("_hot").join(right, [*keys, "_salt"], how).drop("_salt")
