import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stumpline.operators import neighbours
from stumpline.operators.selection import similar_players

NAMES = ["a", "b", "c"]


def table(spark, rows):
    return spark.createDataFrame(rows, "player string, a double, b double, c double")


def plain(rows, targets, n):
    out = []
    for t, *x in rows:
        if t not in targets:
            continue
        scored = []
        for p, *y in rows:
            if p is not None and p != t:
                bad = any(v is None or v != v for v in (*x, *y))
                size = 0 if bad else sum(v * v for v in x) * sum(v * v for v in y)
                scored.append((-(sum(u * v for u, v in zip(x, y, strict=True)) / size**0.5 if size else 0.0), p))
        out += [(t, p, round(-s, 9), i + 1) for i, (s, p) in enumerate(sorted(scored)[:n])]
    return sorted(out)


@pytest.mark.parametrize("tile", [3, 4096])
def test_most_alike_match_all_pairs_with_ties_nulls_and_zeros(spark, tile, monkeypatch):
    monkeypatch.setattr(neighbours, "TILE_ROWS", tile)
    monkeypatch.setattr(neighbours, "HELD_ROWS", 4 * tile)
    monkeypatch.setattr(neighbours, "BLOCK_TARGETS", 50)
    rng = random.Random(2)
    rows = [(f"p{i:03}", *(float(rng.randint(-3, 3)) for _ in NAMES)) for i in range(150)]
    rows += [(f"same{i:02}", 1.0, 2.0, 3.0) for i in range(40)] + [("zero", 0.0, 0.0, 0.0), ("null", None, 1.0, 1.0), ("nan", float("nan"), 1.0, 1.0), (None, 1.0, 1.0, 1.0)]
    df = table(spark, rows)
    got = [(r.target, r.player, round(r.similarity, 9), r["rank"]) for r in similar_players(df, NAMES, df, 4).collect()]
    assert sorted(got) == plain(rows, {r[0] for r in rows} - {None}, 4)
    few = df.filter("player in ('zero', 'p007')")
    assert similar_players(df, NAMES, few, 300).count() == 2 * 192
    assert similar_players(df.limit(0), NAMES, few, 3).count() == 0
    assert similar_players(df, NAMES, few.limit(0), 3).count() == 0


def test_far_cells_are_not_multiplied(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 8))
    rows = [(f"p{i}", *(centres[i % 20] + 0.05 * rng.normal(size=8)).tolist()) for i in range(4000)]
    names = [f"f{j}" for j in range(8)]
    df = spark.createDataFrame(rows, "player string, " + ", ".join(f"{f} double" for f in names))
    index = neighbours.build_index(df, names)
    mine = df.select(F.col("player").alias("target"), F.array(*names).alias("v")).filter("substring(target, 2) % 40 = 0")
    limited = neighbours.bounds(index, mine, 8, 5, 1)
    pairs = neighbours.able_cells(index, limited, 8).join(index.tiles, "cell").agg(F.sum("rows")).first()[0]
    assert index.tiles.agg(F.sum("rows")).first()[0] == 4000
    assert pairs < 0.25 * mine.count() * 4000
