import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler

from stumpline.operators import clusters as cl
from stumpline.operators import lloyd
from stumpline.sources import store


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 4, (5, 3))
    rows = [tuple(map(float, centres[i % 5] + rng.normal(0, 1, 3))) for i in range(1500)] + [(9.0, 9.0, 9.0)] * 200
    return spark.createDataFrame(rows, "a double, b double, c double").repartition(6).cache()


@pytest.mark.parametrize("sample", [400, 10_000])
def test_inertia_is_not_above_that_of_mllib_and_centres_stand_still(table, sample, monkeypatch):
    monkeypatch.setattr(lloyd, "SAMPLE_ROWS", sample)
    cols = ["a", "b", "c"]
    vectors = VectorAssembler(inputCols=cols, outputCol="features").transform(table)
    points = lloyd.points_of(table, cols)
    found = lloyd.fit(points, 3, [2, 3, 5, 7])
    scores = lloyd.silhouettes(points, 3, found)
    x = np.array(table.collect())
    for k, f in found.items():
        model = KMeans(k=k, seed=1, maxIter=200, tol=1e-9).fit(vectors)
        assert f.inertia <= model.summary.trainingCost * 1.005
        near = ((x[:, None] - f.centres[None]) ** 2).sum(-1)
        own = near.argmin(1)
        assert near.min(1).sum() == pytest.approx(f.inertia)
        for c in range(k):
            assert x[own == c].mean(0) == pytest.approx(f.centres[c], abs=1e-3)
        labelled = cl.nearest_centre(cols, f).transform(vectors)
        judge = ClusteringEvaluator(featuresCol="features", predictionCol="cluster")
        assert scores[k] == pytest.approx(judge.evaluate(labelled), abs=1e-6)


def test_steps_that_do_not_suffice_and_odd_tables(spark, table, monkeypatch):
    monkeypatch.setattr(lloyd, "SAMPLE_ROWS", 20)
    points = lloyd.points_of(table, ["a", "b"])
    with pytest.raises(RuntimeError, match="still move"):
        lloyd.fit(points, 2, [6], steps=1, tolerance=0.0)
    with pytest.raises(ValueError, match="no rows"):
        lloyd.fit(lloyd.points_of(table.limit(0), ["a"]), 1, [2])
    same = spark.createDataFrame([(1.0, 2.0)] * 30, "a double, b double")
    found = lloyd.fit(lloyd.points_of(same, ["a", "b"]), 2, [3])
    assert found[3].inertia == 0 and lloyd.silhouettes(lloyd.points_of(same, ["a", "b"]), 2, found) == {3: -1.0}
    bad = spark.createDataFrame([(1.0,), (None,)], "a double")
    with pytest.raises(ValueError, match="finite"):
        lloyd.fit(lloyd.points_of(bad, ["a"]), 1, [2])


def test_saved_pipeline_gives_the_unsaved_clusters(spark, table, tmp_path):
    df = table.withColumn("flat", table.a * 0)
    fit = cl.fit_clusters(df, ["a", "b", "c", "flat"], components=2)
    store.save_model(fit.pipeline, f"{tmp_path}/model")
    loaded = store.load_pipeline(f"{tmp_path}/model")
    assert sorted(map(tuple, loaded.transform(df).collect())) == sorted(map(tuple, fit.pipeline.transform(df).collect()))
    assert fit.centers() == loaded.stages[1].centre_list()
