import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stumpline.functions import scan as scans
from stumpline.functions.quantiles import exact_quantiles, with_scalars
from stumpline.functions.scan import Lag, Last, RowNumber, Running, Since, Total, Trailing, hot_groups, lookup, scan


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(5)
    data = [
        ("a" if rnd.random() < 0.5 else rnd.choice(["b", "c", None]), i, rnd.randint(0, 5), int(rnd.random() < 0.1))
        for i in range(1200)
    ]
    return data, spark.createDataFrame(data, "k string, i long, v int, w int").repartition(5).cache()


def ops():
    v = F.col("v")
    return {
        "run": Running(v),
        "all": Total(v),
        "n": RowNumber(),
        "l1": Lag(v),
        "l5": Lag(v, 5),
        "t12": Trailing(v, 12),
        "s": Since(F.col("w") > 0, v),
        "seen": Last(F.when(F.col("w") > 0, F.struct("i", "v"))),
    }


def expected(data):
    groups = {}
    for k, i, v, w in sorted(data, key=lambda r: r[1]):
        groups.setdefault(k, []).append((i, v, w))
    out = set()
    for k, g in groups.items():
        total, run, since, seen = sum(v for _, v, _ in g), 0, 0, None
        for at, (i, v, w) in enumerate(g):
            run += v
            since = v if w else since + v
            seen = (i, v) if w else seen
            past = lambda n, at=at, g=g: g[at - n][1] if at >= n else None
            out.add((k, i, run, total, at + 1, past(1), past(5), sum(x[1] for x in g[max(0, at - 11) : at + 1]), since, seen))
    return out


@pytest.mark.parametrize("limit", [10**6, 150, 20])
def test_scan_matches_brute_force_on_both_routes(rows, hot, limit):
    data, df = rows
    hot(limit)
    got = scan(df, ["k"], ["i"], **ops()).select("k", "i", *ops()).collect()
    assert {tuple(r) for r in got} == expected(data)


def test_scan_without_keys(rows, hot):
    data, df = rows
    hot(100)
    got = {r["i"]: (r["n"], r["all"]) for r in scan(df, [], ["i"], n=RowNumber(), all=Total(F.lit(1))).collect()}
    assert got == {i: (i + 1, len(data)) for i in range(len(data))}


@pytest.mark.parametrize("limit", [10**6, 3])
def test_quantiles_interpolate(rows, hot, limit):
    data, df = rows
    hot(limit)
    got = exact_quantiles(df, "v", {"a": 0.25, "b": 0.8}, ["k"]).collect()
    for r in got:
        values = [v for k, _, v, _ in data if k == r["k"]]
        assert (r["a"], r["b"]) == pytest.approx(tuple(np.quantile(values, [0.25, 0.8])))
    one = exact_quantiles(df, "i", {"a": 0.1}).first()["a"]
    assert one == pytest.approx(np.quantile([r[1] for r in data], 0.1))


def test_lookup_spreads_hot_keys(spark, rows, hot):
    _, df = rows
    hot(100)
    other = spark.createDataFrame([("a", 1), ("b", 2)], "k string, x int")
    out = lookup(df, other, ["k"])
    got = {(r["k"], r["i"], r["x"]) for r in out.collect()}
    assert got == {(r["k"], r["i"], {"a": 1, "b": 2}.get(r["k"])) for r in df.collect()}
    assert hot_groups(df, ["k"]).listed[0][0] == "a"


def test_hot_groups_beyond_the_list_are_split_too(rows, hot, monkeypatch):
    data, df = rows
    hot(20)
    monkeypatch.setattr(scans, "MAX_LISTED", 1)
    monkeypatch.setattr(scans, "MAX_BROADCAST_ROWS", 0)
    found = hot_groups(df, ["k"])
    assert (found.groups, len(found.listed), found.more.count()) == (4, 1, 4)
    got = scan(df, ["k"], ["i"], **ops()).select("k", "i", *ops()).collect()
    assert {tuple(r) for r in got} == expected(data)


def test_grown_table_is_counted_again(spark, hot, tmp_path):
    hot(100)
    path = f"{tmp_path}/t"
    spark.range(80).selectExpr("1 AS k", "id").write.parquet(path)
    assert not hot_groups(spark.read.parquet(path), ["k"])
    spark.range(80).selectExpr("1 AS k", "id + 100 AS id").write.mode("append").parquet(path)
    assert hot_groups(spark.read.parquet(path), ["k"]).rows == 160


def test_scalars(spark):
    df = spark.range(3)
    one = df.agg(F.max("id").alias("hi"), F.min("id").alias("lo"))
    assert [tuple(r) for r in with_scalars(df, one).orderBy("id").collect()] == [(0, 2, 0), (1, 2, 0), (2, 2, 0)]
