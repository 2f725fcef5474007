"""Boosted trees for two classes, by MLlib's rules, in one stage a tree where a guess holds.

Trees are grown level by level on sums per (node, feature, bin) over all rows, as MLlib does: its cuts, its first tree on
the labels, its later ones on the gradient of the logistic loss, its choice of splits, pruning and importances. MLlib takes
two stages a level. Here the driver guesses all splits of a tree on a bounded sample of rows, and one stage adds up, over
all rows, every node of the guessed tree. Each split is then chosen by these sums alone, from the root down. Where the choice is
not the guess, the sums below it are dropped and the next stage guesses on from there, so the sample decides how many
stages a tree takes, at most one a level, and never what the tree is.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stumpline.operators.stages import _Stage
from stumpline.session import stored

#: Bins of a feature.
BINS = 32
#: Rows that cuts are taken from and splits are guessed on.
SAMPLE_ROWS = 20_000
#: Rows below which a task is not worth its start, and rows that a task takes at most.
FEW_ROWS, MOST_ROWS = 25_000, 1_000_000
#: Rows that a task looks at together.
BLOCK_ROWS = 65_536
#: Trees after which the margins of all rows are written anew and the sample is drawn anew.
REBASE = 16
#: What every row adds to its pull on the next tree, by which the sample is drawn.
LEAST_PULL = 0.1
#: Tasks whose sums the driver adds up by itself; those of more are added up in a further stage.
MOST_SUMS = 32
#: Sums of a bin: rows, weights, weighted targets, weighted squared targets.
SUMS = 4
#: A cut that no bin is above.
ALL_LEFT = 255

#: Rows as (bins by feature, label of -1 or 1, weight, id, margin), and the trees that the margin holds.
Block = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]
#: Feature and cut of every inner node and value of every leaf of a full tree, in the order of a heap.
Tree = tuple[np.ndarray, np.ndarray, np.ndarray]


def _leaf(bins: np.ndarray, tree: Tree) -> np.ndarray:
    feature, cut, value = tree
    at, row = np.zeros(bins.shape[1], dtype=np.int64), np.arange(bins.shape[1])
    for _ in range(len(value).bit_length() - 1):
        at = 2 * at + 1 + (bins[feature[at], row] > cut[at])
    return value[at - len(feature)]


def _bins(x: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """The number of cuts below each value, feature by feature."""
    return np.stack([np.searchsorted(c, x[:, j], side="left").astype(np.uint8) for j, c in enumerate(cuts)])


def _array(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


class BoostedTrees(_Stage):
    """Adds ``probability`` of class 1 for the array ``features``, and the 0/1 ``prediction``.

    The leaves of a row, one of each tree, are added up to half the log odds of class 1.
    """

    column = Param(Params._dummy(), "column", "array of features", TypeConverters.toString)
    sizes = Param(Params._dummy(), "sizes", "cuts of each feature", TypeConverters.toListInt)
    cuts = Param(Params._dummy(), "cuts", "cuts, feature after feature", TypeConverters.toListFloat)
    depth = Param(Params._dummy(), "depth", "levels of inner nodes", TypeConverters.toInt)
    nodes = Param(Params._dummy(), "nodes", "feature of every inner node, tree after tree", TypeConverters.toListInt)
    above = Param(Params._dummy(), "above", "its cut: bins above it go right", TypeConverters.toListInt)
    leaves = Param(Params._dummy(), "leaves", "value of every leaf, tree after tree", TypeConverters.toListFloat)
    importance = Param(Params._dummy(), "importance", "share of the gain by feature", TypeConverters.toListFloat)

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802  named as MLlib's models name it
        return DenseVector(self.value("importance"))

    def trees(self) -> list[Tree]:
        inner = 2 ** self.getOrDefault(self.depth) - 1
        parts = [np.array(self.value(n)).reshape(-1, w) for n, w in (("nodes", inner), ("above", inner), ("leaves", inner + 1))]
        return list(zip(*parts, strict=True))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        sizes, trees = self.value("sizes"), self.trees()
        cuts = np.split(np.array(self.value("cuts"), float), np.cumsum(sizes)[:-1])

        @F.arrow_udf("double")
        def chance(column: pa.Array) -> pa.Array:
            bins = _bins(_array(column, len(sizes)), cuts)
            margin = np.zeros(bins.shape[1])
            for tree in trees:
                margin += _leaf(bins, tree)
            with np.errstate(over="ignore"):
                return pa.array(1 / (1 + np.exp(-2 * margin)))

        return dataset.withColumn("probability", chance(self.getOrDefault(self.column))).withColumn(
            "prediction", (F.col("probability") > 0.5).cast("double")
        )


def _cuts(values: np.ndarray, weight: np.ndarray, bins: int) -> np.ndarray:
    """Halfway between neighbouring values: everywhere if these are few, else where strides of equal weight end."""
    value, at = np.unique(values, return_inverse=True)
    if len(value) <= bins:
        return (value[1:] + value[:-1]) / 2
    share = np.bincount(at, weights=weight)
    stride = share.sum() / bins
    target, reached, found = stride, share[0], []
    for i in range(1, len(value)):
        before, reached = reached, reached + share[i]
        if abs(before - target) < abs(reached - target):
            found.append((value[i - 1] + value[i]) / 2)
            target += stride
    return np.array(found)


def _uniform(ids: np.ndarray, salt: int) -> np.ndarray:
    """A number in [0, 1) for each row: a hash of its id."""
    with np.errstate(over="ignore"):
        x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt * 0xD1B54A32D192ED03 % 2**64)
        for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
        x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)) * 2.0**-53


def _drawn(ids: np.ndarray, tree: int, rate: float, seed: int) -> np.ndarray:
    """Which rows a tree learns from."""
    return np.arange(len(ids)) if rate >= 1 else np.flatnonzero(_uniform(ids, seed * 1_000_003 + 2 * tree) < rate)


def _sums(
    bins: np.ndarray, weight: np.ndarray, target: np.ndarray, rows: np.ndarray, splits: dict[int, tuple[int, int]], wanted: Sequence[int]
) -> np.ndarray:
    """Sums of the ``wanted`` nodes by feature and bin. ``splits`` has feature and cut of the nodes above them."""
    width = len(bins)
    out = np.zeros((len(wanted), SUMS, width, BINS))
    if len(rows) < len(weight):
        bins, weight, target = bins[:, rows], weight[rows], target[rows]
    at = np.zeros(len(rows), np.int64)
    first = 0
    while True:
        # ``at`` is the node of each row in a level that begins at ``first``.
        place = np.full(first + 1, -1)
        for i, node in enumerate(wanted):
            if first <= node <= 2 * first:
                place[node - first] = i
        if (place >= 0).any():
            slot = place[at - first]
            mine = slot >= 0
            b, w, y, slot = (bins, weight, target, slot) if mine.all() else (bins[:, mine], weight[mine], target[mine], slot[mine])
            even = (w == 1).all()
            values = (None, w * y, w * y * y, *(() if even else (w,)))
            for f in range(width):
                code = slot * BINS + b[f]
                found = [np.bincount(code, v, len(wanted) * BINS).reshape(-1, BINS) for v in values]
                for j, k in enumerate((0, 0 if even else 3, 1, 2)):
                    out[:, j, f] += found[k]
        if max(wanted) <= 2 * first:
            return out
        feature, cut = (np.array([splits.get(n, (-1, 0))[k] for n in range(first, 2 * first + 1)]) for k in (0, 1))
        by = feature[at - first]
        on = by >= 0
        if not on.all():
            bins, weight, target, at, by = bins[:, on], weight[on], target[on], at[on], by[on]
        at = 2 * at + 1 + (bins[by, np.arange(len(at))] > cut[at - first])
        first = 2 * first + 1


@dataclass(frozen=True)
class _Split:
    feature: int
    cut: int
    gain: float
    left: np.ndarray
    right: np.ndarray


def _impurity(s: np.ndarray) -> np.ndarray:
    """Variance of the targets; sums come first."""
    w = np.maximum(s[1], np.finfo(float).tiny)
    return np.where(s[1] > 0, (s[3] - s[2] * s[2] / w) / w, 0.0)


def _best(sums: np.ndarray, cuts: np.ndarray) -> _Split | None:
    """The split of greatest gain; of splits that differ by rounding only the first. ``cuts`` counts those of each feature."""
    run = sums.cumsum(-1)
    left, whole = run[..., :-1], run[..., -1:]
    right = whole - left
    total = np.maximum(whole[1], np.finfo(float).tiny)
    own = _impurity(whole)
    gain = own - left[1] / total * _impurity(left) - right[1] / total * _impurity(right)
    able = (left[0] >= 1) & (right[0] >= 1) & (np.arange(BINS - 1) < cuts[:, None])
    gain = np.where(able, gain, -np.inf)
    top = gain.max(initial=-np.inf)
    if not top > 0:
        return None
    f, c = np.unravel_index(np.argmax(gain >= top - 1e-9 * top - 1e-14 * own.max()), gain.shape)
    return _Split(int(f), int(c), float(gain[f, c]), left[:, f, c], right[:, f, c]) if gain[f, c] > 0 else None


def _pure(sums: np.ndarray) -> bool:
    return abs(float(_impurity(sums))) < np.finfo(float).eps


def _guess(sample: Block, target: np.ndarray, rows: np.ndarray, known: dict[int, tuple[int, int]], open_nodes: Sequence[int], depth: int, cuts: np.ndarray) -> tuple[dict[int, tuple[int, int]], list[int]]:
    """Splits below the open nodes as the sample has them, and all nodes whose sums such a tree needs."""
    splits, wanted, level = dict(known), [], list(open_nodes)
    while level:
        wanted += level
        below = []
        sums = _sums(sample[0], sample[2], target, rows, splits, level)
        for node, s in zip(level, sums, strict=True):
            found = _best(s, cuts)
            if found is not None:
                splits[node] = found.feature, found.cut
                below += [n for n in (2 * node + 1, 2 * node + 2) if n < 2**depth - 1]
        level = below
    return splits, wanted


def _target(block: Block, done: Sequence[Tree]) -> tuple[np.ndarray, np.ndarray]:
    """Margin after all trees ``done``, and what the next tree fits."""
    bins, y, _, _, margin, held = block
    for tree in done[held:]:
        margin = margin + _leaf(bins, tree)
    if not done:
        return margin, y
    with np.errstate(over="ignore"):
        return margin, 4 * y / (1 + np.exp(2 * y * margin))


def _grow(sums_of: Callable[..., tuple[dict[int, tuple[int, int]], dict[int, np.ndarray]]], depth: int, cuts: np.ndarray) -> tuple[dict[int, _Split], dict[int, np.ndarray]]:
    """Splits of a tree and sums (rows, weights, targets, squares) of its nodes. ``sums_of`` adds up open nodes and what it guesses below."""
    splits: dict[int, _Split] = {}
    stats: dict[int, np.ndarray] = {}
    open_nodes = [0]
    while open_nodes:
        guessed, sums = sums_of({n: (s.feature, s.cut) for n, s in splits.items()}, open_nodes)
        missing = []
        while open_nodes:
            node = open_nodes.pop(0)
            if node not in sums:
                missing.append(node)
                continue
            stats.setdefault(node, sums[node][:, 0].sum(-1))
            found = _best(sums[node], cuts)
            if found is None:
                continue
            splits[node] = found
            if guessed.get(node) != (found.feature, found.cut):  # what was added up below belongs to another split
                under = [2 * node + 1, 2 * node + 2]
                while under:
                    n = under.pop()
                    if n in sums:
                        del sums[n]
                    if n < 2**depth - 1:
                        under += [2 * n + 1, 2 * n + 2]
            for child, s in ((2 * node + 1, found.left), (2 * node + 2, found.right)):
                stats[child] = s
                if child < 2**depth - 1 and not _pure(s):
                    open_nodes.append(child)
        open_nodes = missing
    return splits, stats


def _tree(splits: dict[int, _Split], stats: dict[int, np.ndarray], depth: int, step: float, importance: np.ndarray) -> Tree:
    """The tree as arrays; adds the gains of what stays after pruning to ``importance``."""
    inner = 2**depth - 1
    feature, cut, value = np.zeros(inner, np.int64), np.full(inner, ALL_LEFT, np.int64), np.zeros(inner + 1)

    def mean(node: int) -> float:
        return float(stats[node][2] / stats[node][1]) if stats[node][1] > 0 else 0.0

    def fill(node: int) -> float | None:
        """Prediction if the node is a leaf."""
        if node in splits:
            s = splits[node]
            both = fill(2 * node + 1), fill(2 * node + 2)
            if both[0] is None or both[0] != both[1]:
                feature[node], cut[node] = s.feature, s.cut
                importance[s.feature] += s.gain * stats[node][1]
                return None
        else:
            both = (mean(node),)
        low = node
        while low < inner:
            low = 2 * low + 1
        value[low - inner] = step * both[0]
        return both[0]

    fill(0)
    return feature, cut, value


def fit(
    df: DataFrame, features: str, label: str, weight: str | None = None, trees: int = 100, depth: int = 4, step: float = 0.1, rate: float = 1.0, seed: int = 42
) -> BoostedTrees:
    """Trees that tell ``label`` 1 from 0 by the array ``features``; each learns from a ``rate`` of the rows.

    Rows are kept in the shared folder under numbers that decide which trees learn from them.
    """
    spark = df.sparkSession
    rows = stored(
        df.select(
            F.col(features).alias("x"), F.col(label).cast("double").alias("y"),
            (F.lit(1.0) if weight is None else F.col(weight).cast("double")).alias("w"), F.monotonically_increasing_id().alias("id"),
        ),
        "boosting",
    )
    wrong = F.col("y").isNull() | ~F.col("y").isin(0.0, 1.0) | F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(wrong).alias("wrong"), F.max(F.size("x")).alias("width")).first()
    if not seen["n"]:
        raise ValueError("no rows to learn from")
    if seen["wrong"]:
        raise ValueError("labels have to be 0 or 1, and features finite")
    width = seen["width"]
    # A tree has no more bins than rows.
    most = min(BINS, seen["n"])

    sampled = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).toArrow()
    x = _array(sampled["x"].combine_chunks(), width)
    y, w, ids = (sampled[c].to_numpy() for c in ("y", "w", "id"))
    cuts = tuple(_cuts(x[:, j], w, most) for j in range(width))
    many = np.array([len(c) for c in cuts])
    odds = np.full(len(y), len(y) / seen["n"])
    sample: Block = (_bins(x, cuts), 2 * y - 1, w / odds, ids, np.zeros(len(y)), 0)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(parts: list) -> pa.RecordBatch:
            block = (*(np.concatenate(c, axis=-1) for c in zip(*parts, strict=True)), 0)
            return pa.record_batch([pa.array([pickle.dumps(block)], pa.binary())], names=["block"])

        held: list = []
        for b in batches:
            n = len(b)
            got = [b.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3)]
            held.append((_bins(_array(b.column(0), width), cuts), 2 * got[0] - 1, got[1], got[2], np.zeros(n)))
            if sum(len(h[1]) for h in held) >= BLOCK_ROWS:
                yield made(held)
                held = []
        if held:
            yield made(held)

    cores = spark.sparkContext.defaultParallelism
    tasks = max(min(cores, -(-seen["n"] // FEW_ROWS)), -(-seen["n"] // MOST_ROWS))
    blocks = rows.repartition(tasks).mapInArrow(pack, "block binary").rdd.map(lambda r: bytes(r[0])).persist(StorageLevel.MEMORY_AND_DISK)
    done: list[Tree] = []
    importance = np.zeros(width)
    last = None
    try:
        for m in range(trees):
            if m % REBASE == 1:
                last, blocks = blocks, blocks.map(_rebase(tuple(done))).persist(StorageLevel.MEMORY_AND_DISK)
                if seen["n"] > SAMPLE_ROWS:
                    sample, odds = _sampled(blocks, sample, odds, tuple(done), seed)
            margin, target = _target(sample, done)
            sample = (*sample[:4], margin, len(done))
            drawn = _drawn(sample[3], m, rate, seed)

            def sums_of(known: dict, open_nodes: Sequence[int], blocks=blocks, sample=sample, target=target, drawn=drawn) -> tuple:
                splits, wanted = _guess(sample, target, drawn, known, open_nodes, depth, many)
                found = _total(blocks, tasks, width, tuple(done), rate, seed, splits, wanted)
                return splits, dict(zip(wanted, found, strict=True))

            grown = _grow(sums_of, depth, many)
            if last is not None:
                last.unpersist()
                last = None
            done.append(_tree(*grown, depth, step if m else 1.0, importance))
    finally:
        blocks.unpersist()
    whole = importance.sum()
    flat = [np.concatenate(part).tolist() for part in zip(*done, strict=True)]
    return BoostedTrees(
        column=features, sizes=many.tolist(), cuts=np.concatenate(cuts).tolist(), depth=depth, nodes=flat[0], above=flat[1], leaves=flat[2],
        importance=(importance / whole if whole > 0 else importance).tolist(),
    )


def _rebase(done: tuple[Tree, ...]) -> Callable[[bytes], bytes]:
    def run(packed: bytes) -> bytes:
        block = pickle.loads(packed)
        return pickle.dumps((*block[:4], _target(block, done)[0], len(done)))

    return run


def _sampled(blocks: RDD, sample: Block, odds: np.ndarray, done: tuple[Tree, ...], seed: int) -> tuple[Block, np.ndarray]:
    """About ``SAMPLE_ROWS`` rows, drawn by their pull on the next tree and weighted against it, and the odds of each.

    Trees mend what few rows get wrong, and an even sample has too few of those to guess by.
    """

    def pull(weight: np.ndarray, target: np.ndarray) -> np.ndarray:
        return weight * (np.abs(target) + LEAST_PULL)

    before = pull(sample[2] * odds, _target(sample, done)[1])
    scale = SAMPLE_ROWS / (before / odds).sum()
    for _ in range(20):
        scale *= SAMPLE_ROWS / (np.minimum(1, scale * before) / odds).sum()

    def run(packed: Iterator[bytes]) -> Iterator[tuple]:
        for block in map(pickle.loads, packed):
            margin, target = _target(block, done)
            chance = np.minimum(1, scale * pull(block[2], target))
            kept = _uniform(block[3], seed * 1_000_003 + 2 * len(done) + 1) < chance
            yield block[0][:, kept], block[1][kept], block[2][kept] / chance[kept], block[3][kept], margin[kept], chance[kept]

    found = [np.concatenate(part, axis=-1) for part in zip(*blocks.mapPartitions(run).collect(), strict=True)]
    return (*found[:5], len(done)), found[5]


def _total(
    blocks: RDD, tasks: int, width: int, done: tuple[Tree, ...], rate: float, seed: int, splits: dict[int, tuple[int, int]], wanted: Sequence[int]
) -> np.ndarray:
    """Sums of the wanted nodes over all rows, in one stage."""
    def run(packed: Iterator[bytes]) -> Iterator[np.ndarray]:
        total = np.zeros((len(wanted), SUMS, width, BINS))
        for block in map(pickle.loads, packed):
            total += _sums(block[0], block[2], _target(block, done)[1], _drawn(block[3], len(done), rate, seed), splits, wanted)
        yield total

    parts = blocks.mapPartitions(run)
    return parts.treeReduce(np.add, 2) if tasks > MOST_SUMS else sum(parts.collect())

