"""k-means for several numbers of clusters at once: every pass over the rows serves all of them.

Centres start from the best few of several k-means++ runs on a bounded random sample. Then Lloyd's steps go over all
rows for all these starts together: a task adds up its rows per (start, centre) in numpy, the sums are added up by Spark,
and the driver sees one row per (start, centre). The start with the smallest inertia counts. It ends when no centre moves any more, and raises where the steps do not suffice. The last
pass gives every cluster's size, sum and squared norms at the final centres, from which a pass has the squared-distance
silhouette of all k together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stumpline.session import stored

#: Rows that starting centres are sought on.
SAMPLE_ROWS = 10_000
#: Starts that all rows decide between, where the sample is not all of them.
STARTS = 3
#: A centre has stopped when it moves less than this share of the features' mean variance (squared).
TOLERANCE = 1e-9


@dataclass(frozen=True)
class Clusters:
    """Final centres in order of their coordinates, with size, sum and squared norms of the rows nearest to each."""

    centres: np.ndarray
    inertia: float
    size: np.ndarray
    total: np.ndarray
    squares: np.ndarray


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1), 0)


def _starts(x: np.ndarray, k: int, rng: np.random.Generator, runs: int, keep: int) -> list[np.ndarray]:
    """The best ``keep`` different ones of ``runs`` k-means++ starts, each moved until its centres stop."""
    found: dict[float, np.ndarray] = {}
    for _ in range(runs):
        centres = x[[rng.integers(len(x))]]
        while len(centres) < k:
            away = _distances(x, centres).min(1)
            share = away / away.sum() if away.sum() > 0 else None
            centres = np.vstack([centres, x[rng.choice(len(x), p=share)]])
        for _ in range(1_000):
            near = _distances(x, centres).argmin(1)
            size = np.bincount(near, minlength=k)
            total = np.stack([np.bincount(near, weights=x[:, j], minlength=k) for j in range(x.shape[1])], axis=1)
            moved = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centres)
            still, centres = np.array_equal(moved, centres), moved
            if still:
                break
        found.setdefault(round(float(_distances(x, centres).min(1).sum()), 6), centres)
    return [found[inertia] for inertia in sorted(found)[:keep]]


def _rows(batch: pa.RecordBatch, width: int) -> np.ndarray:
    x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    if not np.isfinite(x).all():
        raise ValueError("features to cluster by have to be finite")
    return x


def _pass(points: DataFrame, width: int, centres: dict[int, np.ndarray]) -> dict[int, Clusters]:
    """Sums of the rows nearest to each centre, for every k in one scan."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {k: np.zeros((len(c), width + 3)) for k, c in centres.items()}
        for batch in batches:
            x = _rows(batch, width)
            square = (x * x).sum(1)
            for k, c in centres.items():
                away = _distances(x, c)
                near = away.argmin(1)
                columns = [np.ones(len(x)), away[np.arange(len(x)), near], square, *x.T]
                found[k] += np.stack([np.bincount(near, weights=v, minlength=len(c)) for v in columns], axis=1)
        at = [(k, i) for k, c in centres.items() for i in range(len(c))]
        sums = [found[k][i].tolist() for k, i in at]
        yield pa.record_batch([pa.array([p[0] for p in at], pa.int32()), pa.array([p[1] for p in at], pa.int32()), pa.array(sums, pa.list_(pa.float64()))], names=["k", "c", "s"])

    parts = points.mapInArrow(add, "k int, c int, s array<double>")
    rows = parts.groupBy("k", "c").agg(F.array(*[F.sum(F.col("s")[i]) for i in range(width + 3)]).alias("s")).collect()
    out = {}
    for k, c in centres.items():
        s = np.zeros((len(c), width + 3))
        for r in rows:
            if r["k"] == k:
                s[r["c"]] = r["s"]
        out[k] = Clusters(c, float(s[:, 1].sum()), s[:, 0], s[:, 3:], s[:, 2])
    return out


def points_of(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The features as one array per row, written once for all passes."""
    return stored(df.select(F.array(*[F.col(c).cast("double") for c in cols]).alias("v")), "points")


def fit(
    points: DataFrame, width: int, ks: Sequence[int], seed: int = 42, runs: int = 10, steps: int = 300, tolerance: float = TOLERANCE
) -> dict[int, Clusters]:
    """Clusters for every k of ``ks``; raises where the centres still move after ``steps`` passes."""
    sample = points.orderBy(F.rand(seed)).limit(SAMPLE_ROWS).collect()
    if not sample:
        raise ValueError("no rows to cluster")
    x = np.array([r["v"] for r in sample], float).reshape(len(sample), width)
    if not np.isfinite(x).all():
        raise ValueError("features to cluster by have to be finite")
    spread = float(x.var(axis=0).mean())
    # A sample that holds all rows shows which start is best.
    keep = STARTS if len(sample) == SAMPLE_ROWS else 1
    starts = [(k, c) for k in ks for c in _starts(x, k, np.random.default_rng([seed, k]), runs, keep)]
    live, done = dict(enumerate(c for _, c in starts)), {}
    for _ in range(steps):
        for at, got in _pass(points, width, live).items():
            moved = np.where(got.size[:, None] > 0, got.total / np.maximum(got.size, 1)[:, None], got.centres)
            if ((moved - got.centres) ** 2).sum() <= tolerance * spread:
                done[at] = moved[np.lexsort(moved.T[::-1])]
                del live[at]
            else:
                live[at] = moved
        if not live:
            last = _pass(points, width, done)
            return {k: min((last[at] for at, (j, _) in enumerate(starts) if j == k), key=lambda f: f.inertia) for k in ks}
    raise RuntimeError(f"centres still move after {steps} steps for k = {sorted({starts[at][0] for at in live})}")


def silhouettes(points: DataFrame, width: int, found: dict[int, Clusters]) -> dict[int, float]:
    """Mean squared-distance silhouette of every k in one pass; -1 where fewer than two clusters have rows."""
    able = {k: f for k, f in found.items() if (f.size > 0).sum() > 1}
    score: Callable[[np.ndarray, Clusters], np.ndarray] = _silhouette

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = dict.fromkeys(able, 0.0)
        for batch in batches:
            x = _rows(batch, width)
            for k, f in able.items():
                total[k] += float(score(x, f).sum())
        yield pa.record_batch([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.float64())], names=["k", "s"])

    rows = points.mapInArrow(add, "k int, s double").groupBy("k").agg(F.sum("s").alias("s")).collect()
    mean = {r["k"]: r["s"] / float(found[r["k"]].size.sum()) for r in rows}
    return {k: mean.get(k, -1.0) for k in found}


def _silhouette(x: np.ndarray, f: Clusters) -> np.ndarray:
    own = _distances(x, f.centres).argmin(1)
    at = np.arange(len(x))
    total = np.maximum((x * x).sum(1)[:, None] * f.size - 2 * x @ f.total.T + f.squares, 0)
    size = f.size[own]
    inside = total[at, own] / np.maximum(size - 1, 1)
    mean = np.where(f.size > 0, total / np.maximum(f.size, 1), np.inf)
    mean[at, own] = np.inf
    outside = mean.min(1)
    top = np.maximum(inside, outside)
    return np.where((size > 1) & (top > 0), (outside - inside) / np.where(top > 0, top, 1), 0.0)
