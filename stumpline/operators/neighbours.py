"""The rows most alike given ones by cosine similarity, exactly, with whole cells of rows left out.

An index assigns every vector to the nearest of a few pivots (rows picked by hash), and packs the vectors of a cell in
tiles, without a shuffle. Angles obey the triangle inequality: a vector of a cell is no nearer to a target than the
target's angle to the pivot less the cell's radius. A target first meets the cells around it until they hold enough
vectors; the n-th best of these is a bound, and only cells that can beat it are met after that. Tiles and blocks of
targets are multiplied as matrices, a tile gives its n best rows per target, and no pair becomes a row. What a target's
best rows are is decided on sums that do not depend on the tile, so ties stay ties.

Vectors with a null, a NaN or no length have similarity 0 to all. Rows without a name are left out. An empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stumpline.session import stored

#: Pivots, at most; they and the cells' sizes and radii are what the driver sees.
MAX_CELLS = 1_024
#: Rows of a tile, rows that a task holds before it writes its tiles, and targets that a tile meets at a time.
TILE_ROWS = 4_096
HELD_ROWS = 1 << 16
BLOCK_TARGETS = 1_000
#: What rounding may add to an angle (radians) and to a product.
_SLACK = 1e-6
_NEAR = 1e-9
_NO_LENGTH = -1


@dataclass(frozen=True)
class Index:
    """Tiles (``cell``, ``radius``, ``rows``, ``players``, ``vectors``), unit pivots, rows and radius of every cell."""

    tiles: DataFrame
    pivots: np.ndarray
    rows: np.ndarray
    radius: np.ndarray
    no_length: int


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors of an Arrow list column; one with a null or NaN becomes zero."""
    x = np.array(column.flatten().to_numpy(zero_copy_only=False), float).reshape(-1, width)
    x[~np.isfinite(x).all(axis=1)] = 0
    return x


def _unit(x: np.ndarray) -> np.ndarray:
    size = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.divide(x, size, out=np.zeros_like(x), where=size > 0)


def _angles(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(_unit(x) @ pivots.T, -1, 1))


def _named(df: DataFrame, features: Sequence[str], player: str) -> DataFrame:
    vector = F.array(*[F.col(f).cast("double") for f in features])
    return df.select(F.col(player).cast("string").alias("p"), vector.alias("v")).dropna(subset=["p"])


def build_index(df: DataFrame, features: Sequence[str], player: str = "player") -> Index:
    """Assign all rows to cells and write them as tiles: one pass after the pivots are picked."""
    width = len(features)
    known = _named(df, features, player)
    many = min(MAX_CELLS, int(known.count() ** 0.5) + 1)
    able = F.exists("v", lambda x: x != 0) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x))
    picked = known.filter(able).orderBy(F.xxhash64("p", "v"), "p").limit(many).select("v").collect()
    pivots = _unit(np.array([r["v"] for r in picked], float).reshape(-1, width))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[np.ndarray] = []
        vectors: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            p, x = np.concatenate(names), np.concatenate(vectors)
            cell, away = np.full(len(x), _NO_LENGTH), np.zeros(len(x))
            long = x.any(axis=1)
            if long.any():
                angle = _angles(x[long], pivots)
                cell[long] = angle.argmin(axis=1)
                away[long] = angle.min(axis=1)
            order = np.argsort(cell, kind="stable")
            cuts = np.flatnonzero(np.diff(cell[order])) + 1
            for at in np.split(order, cuts):
                for i in range(0, len(at), TILE_ROWS):
                    some = at[i : i + TILE_ROWS]
                    row = (int(cell[some[0]]), float(away[some].max()), len(some), p[some].tolist(), x[some].tobytes())
                    yield pa.record_batch([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names=list(columns))
            names.clear()
            vectors.clear()

        for batch in batches:
            if batch.num_rows:
                names.append(np.array(batch.column("p").to_pylist(), object))
                vectors.append(_matrix(batch.column("v"), width))
            if sum(len(v) for v in vectors) >= HELD_ROWS:
                yield from flush()
        if vectors:
            yield from flush()

    columns = ("cell", "radius", "rows", "players", "vectors")
    kinds = (pa.int32(), pa.float64(), pa.int32(), pa.list_(pa.string()), pa.binary())
    tiles = stored(known.mapInArrow(assign, "cell int, radius double, rows int, players array<string>, vectors binary"), "tiles")
    rows, radius, no_length = np.zeros(len(pivots), np.int64), np.zeros(len(pivots)), 0
    for r in tiles.groupBy("cell").agg(F.sum("rows").alias("n"), F.max("radius").alias("radius")).collect():
        if r["cell"] == _NO_LENGTH:
            no_length = r["n"]
        else:
            rows[r["cell"]], radius[r["cell"]] = r["n"], r["radius"]
    return Index(tiles, pivots, rows, radius, no_length)


def _pairs(targets: DataFrame, width: int, chosen: Callable[[np.ndarray, np.ndarray], list[np.ndarray]]) -> DataFrame:
    """One row per (target, chosen cell); ``chosen`` takes vectors and bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("v"), width)
                cells = chosen(x, batch.column("bound").to_numpy(zero_copy_only=False))
                at = pa.array(np.repeat(np.arange(len(x)), [len(c) for c in cells]))
                cell = pa.array(np.concatenate(cells).astype(np.int32) if cells else [], pa.int32())
                yield pa.record_batch([cell, *(batch.column(c).take(at) for c in ("target", "v", "bound"))], names=["cell", "target", "v", "bound"])

    return targets.select("target", "v", "bound").mapInArrow(run, "cell int, target string, v array<double>, bound double")


def first_cells(index: Index, targets: DataFrame, width: int, n: int) -> DataFrame:
    """For each target the cells nearest to it that hold more than ``n`` vectors together."""
    pivots, rows = index.pivots, index.rows

    def chosen(x: np.ndarray, _: np.ndarray) -> list[np.ndarray]:
        order = np.argsort(_angles(x, pivots), axis=1, kind="stable")
        enough = (np.cumsum(rows[order], axis=1) <= n).sum(axis=1) + 1
        return [o[:k] for o, k in zip(order, enough, strict=True)]

    return _pairs(targets, width, chosen)


def able_cells(index: Index, targets: DataFrame, width: int) -> DataFrame:
    """For each target the cells that may hold a vector whose similarity reaches the target's ``bound``."""
    pivots, radius, no_length = index.pivots, index.radius, index.no_length

    def chosen(x: np.ndarray, bound: np.ndarray) -> list[np.ndarray]:
        best = np.cos(np.maximum(0, _angles(x, pivots) - radius - _SLACK))
        best[~x.any(axis=1)] = 0
        cells = [np.flatnonzero(b >= low - _NEAR) for b, low in zip(best, bound, strict=True)]
        if no_length:
            cells = [np.append(c, _NO_LENGTH) if low <= _NEAR else c for c, low in zip(cells, bound, strict=True)]
        return cells

    return _pairs(targets, width, chosen)


def tile_best(
    players: list[str], x: np.ndarray, names: list[str], t: np.ndarray, n: int
) -> Iterator[tuple[str, str, float]]:
    """(target, player, similarity) of each target's ``n`` best rows of a tile, itself excluded."""
    sq_x, sq_t = (x * x).sum(axis=1), (t * t).sum(axis=1)
    size = np.sqrt(sq_x[:, None] * sq_t[None])
    near = np.divide(x @ t.T, size, out=np.zeros_like(size), where=size > 0)
    who = np.array(players, object)
    for j, name in enumerate(names):
        at = np.flatnonzero(who != name)
        if not len(at):
            continue
        s = near[at, j]
        if len(at) > n:
            at = at[s >= np.partition(s, len(s) - n)[len(s) - n] - _NEAR]
        # One row's sum does not depend on the rows around it, unlike a matrix product.
        dot, size_j = (x[at] * t[j]).sum(axis=1), size[at, j]
        exact = np.divide(dot, size_j, out=np.zeros(len(at)), where=size_j > 0)
        order = sorted(range(len(at)), key=lambda i: (-exact[i], who[at[i]]))  # noqa: B023
        for i in order[:n]:
            yield name, who[at[i]], float(exact[i])


def _best(index: Index, pairs: DataFrame, width: int, n: int, blocks: int) -> DataFrame:
    """``target``, ``player``, ``similarity``: the best of every tile that a pair's cell has, at least the ``n`` best of all."""
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("target"), F.lit(blocks)))
    pivots = index.pivots
    packed = salted.groupBy("cell", "salt").agg(F.collect_list(F.struct("target", "v", "bound")).alias("targets"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[str, str, float]] = []
            for i in range(batch.num_rows):
                x = np.frombuffer(batch.column("vectors")[i].as_py()).reshape(-1, width)
                block = batch.column("targets")[i].values
                names, bound = block.field("target").to_pylist(), block.field("bound").to_numpy(zero_copy_only=False)
                t, cell = _matrix(block.field("v"), width), batch.column("cell")[i].as_py()
                best = np.zeros(len(t))
                if cell != _NO_LENGTH:
                    away = _angles(t, pivots[cell : cell + 1])[:, 0]
                    best = np.where(t.any(axis=1), np.cos(np.maximum(0, away - batch.column("radius")[i].as_py() - _SLACK)), 0.0)
                able = np.flatnonzero(best >= bound - _NEAR)
                rows += tile_best(batch.column("players")[i].as_py(), x, [names[j] for j in able], t[able], n)
            yield pa.record_batch([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["target", "player", "similarity"])

    kinds = (pa.string(), pa.string(), pa.float64())
    joined = index.tiles.join(packed, "cell").select("cell", "radius", "players", "vectors", "targets")
    return joined.mapInArrow(run, "target string, player string, similarity double")


def _ranked(found: DataFrame, n: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("target").orderBy(F.desc("similarity"), "player"))
    return found.withColumn("rank", place).filter(F.col("rank") <= n)


def bounds(index: Index, targets: DataFrame, width: int, n: int, blocks: int) -> DataFrame:
    """``targets`` with the similarity of the ``n``-th best row around them as their ``bound``."""
    open_ = targets.withColumn("bound", F.lit(-2.0))
    seen = _ranked(_best(index, first_cells(index, open_, width, n), width, n, blocks), n)
    low = seen.groupBy("target").agg(F.when(F.count(F.lit(1)) == n, F.min("similarity")).alias("bound"))
    return targets.join(low, "target", "left").withColumn("bound", F.coalesce("bound", F.lit(-2.0)))


def most_alike(df: DataFrame, features: Sequence[str], targets: DataFrame, n: int, player: str = "player") -> DataFrame:
    """``target``, ``player``, ``similarity``, ``rank`` of the ``n`` rows most alike each target."""
    width = len(features)
    index = build_index(df, features, player)
    wanted = targets.select(F.col(player).cast("string").alias("p")).dropna().distinct()
    mine = stored(_named(df, features, player).join(wanted, "p").select(F.col("p").alias("target"), "v"), "targets")
    blocks = max(1, -(-mine.count() // BLOCK_TARGETS))
    limited = stored(bounds(index, mine, width, n, blocks), "bounds")
    return _ranked(_best(index, able_cells(index, limited, width), width, n, blocks), n)
