"""Boosted trees against MLlib's, and the stages they take."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from stumpline.operators import boosting
from stumpline.operators import decision as de


@pytest.fixture
def rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3_000, 5))
    x[:, 1] = rng.integers(0, 3, len(x))
    x[:, 2] = np.where(rng.random(len(x)) < 0.5, 0.0, x[:, 2])
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=len(x)) > 0.3).astype(int)
    data = [(i, v, int(c), float(w)) for i, (v, c, w) in enumerate(zip(x.tolist(), y, rng.choice([1.0, 2.5], len(x)), strict=True))]
    return spark.createDataFrame(data, "i int, features array<double>, y int, w double").cache()


@pytest.mark.parametrize("weight", [None, "w"])
def test_trees_are_those_of_mllib(rows, weight):
    ours = boosting.fit(rows, "features", "y", weight, trees=8, depth=4, step=0.1)
    vectors = rows.withColumn("features", array_to_vector("features"))
    learner = GBTClassifier(labelCol="y", maxIter=8, maxDepth=4, stepSize=0.1, **({"weightCol": weight} if weight else {}))
    theirs = learner.fit(vectors)
    got = dict(ours.transform(rows).select("i", "probability").collect())
    want = dict(theirs.transform(vectors).select("i", vector_to_array("probability")[1]).collect())
    assert got == pytest.approx(want, abs=1e-9)
    # Where two features part the rows of a node alike, MLlib takes the one that rounding favours.
    assert ours.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=2e-3)


def test_a_guess_from_few_rows_changes_stages_only(spark, rows, monkeypatch):
    """The cuts held, trees are the same whether the sample holds all rows or few, and a tree takes one stage where it holds all."""
    calls = []
    total = boosting._total
    monkeypatch.setattr(boosting, "_total", lambda *a: calls.append(1) or total(*a))
    coarse = rows.withColumn("features", F.transform("features", lambda v: F.round(v * 2)))
    found = {}
    for sample in (20_000, 400):
        monkeypatch.setattr(boosting, "SAMPLE_ROWS", sample)
        monkeypatch.setattr(boosting, "_cuts", lambda values, weight, bins: np.arange(-15, 15) + 0.5)
        calls.clear()
        found[sample] = boosting.fit(coarse, "features", "y", trees=20, rate=0.8), len(calls)
    assert found[20_000][1] == 20 and 20 < found[400][1] <= 80
    a, b = (f[0].transform(coarse).orderBy("i").toPandas()["probability"] for f in found.values())
    assert a.to_numpy() == pytest.approx(b.to_numpy(), abs=1e-9)


def test_tasks_blocks_and_drawn_rows(rows, monkeypatch):
    """Rows dealt to more tasks and smaller blocks, with sums added up in a further stage, give the same trees."""
    once = boosting.fit(rows, "features", "y", trees=18, rate=0.8)
    for name, v in {"FEW_ROWS": 300, "BLOCK_ROWS": 100, "MOST_SUMS": 2, "REBASE": 4}.items():
        monkeypatch.setattr(boosting, name, v)
    many = boosting.fit(rows, "features", "y", trees=18, rate=0.8)
    assert many.value("nodes") == once.value("nodes") and many.value("leaves") == pytest.approx(once.value("leaves"), abs=1e-9)
    ids = np.arange(100_000)
    first, second = (np.isin(ids, boosting._drawn(ids, t, 0.8, 42)) for t in (0, 1))
    assert abs(first.mean() - 0.8) < 0.01 and abs((first & second).mean() - 0.64) < 0.01


def test_save_and_load(rows, tmp_path):
    model = boosting.fit(rows, "features", "y", trees=3)
    model.save(f"file://{tmp_path}/model")
    back = boosting.BoostedTrees.load(f"file://{tmp_path}/model")
    assert back.transform(rows).collect() == model.transform(rows).collect()


def test_wrong_rows_raise(spark):
    schema = "features array<double>, y int"
    for bad in ([], [([1.0], 2)], [([float("nan")], 1)], [([1.0], None)]):
        with pytest.raises(ValueError):
            boosting.fit(spark.createDataFrame(bad, schema), "features", "y", trees=1)
    one = boosting.fit(spark.createDataFrame([([1.0], 1), ([2.0], 1)], schema), "features", "y", trees=3)
    assert one.value("importance") == [0.0]


def test_benefit_classifier_takes_a_stage_a_tree(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, 1, 1 + i // 6, *x, int(x[0] + rng.normal() > 0)) for i, x in enumerate(rng.normal(size=(300, len(de.STATE_COLUMNS))).tolist())]
    schema = "match_id long, innings int, over int, " + ", ".join(f"{c} double" for c in de.STATE_COLUMNS) + ", sub_benefit int"
    calls = []
    total = boosting._total
    monkeypatch.setattr(boosting, "_total", lambda *a: calls.append(1) or total(*a))
    model, scored = de.train_benefit_classifier(spark.createDataFrame(rows, schema), trees=5)
    found = scored.collect()
    assert len(calls) == 5 and found and all((r["probability"] > 0.5) == (r["prediction"] == 1) for r in found)
    first = de.feature_importance(scored, model, de.STATE_COLUMNS).first()
    assert first["feature"] == de.STATE_COLUMNS[0]
