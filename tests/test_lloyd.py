"""Rounds of many k-means models in shared passes: what ``KMeans`` finds, in as many passes as the slowest model needs."""

import random

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.linalg import Vectors

from riskframe.operators import lloyd, models


@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(3)
    rows = [(i, Vectors.dense([rng.gauss(3 * (i % 4), 1), rng.gauss(2 * (i % 3), 1)])) for i in range(700)]
    return spark.createDataFrame([*rows, *rows[:50]], ["id", "features"]).coalesce(3).persist()


def _starters(**settings):
    return [KMeans(k=k, seed=seed, **settings) for k in (2, 3, 5) for seed in (1, 2)]


def test_the_centers_of_kmeans(points, monkeypatch):
    monkeypatch.setattr(lloyd, "BLOCK_POINTS", 64)
    whole = [s.fit(points) for s in _starters(maxIter=300)]
    begun = [np.array(s.fit(points).clusterCenters()) for s in _starters(maxIter=0)]
    settled = lloyd.settle(lloyd.blocks(points, "features").persist(), begun, 300, 1e-4)
    for model, (centers, cost) in zip(whole, settled, strict=True):
        assert np.allclose(model.clusterCenters(), centers, rtol=0, atol=1e-9)
        assert model.summary.trainingCost == pytest.approx(cost)
        mine = points.withColumn("at", models.vector_to_array("features")).select("id", lloyd.nearest("at", centers).alias("prediction"))
        assert sorted(mine.collect()) == sorted(model.transform(points).select("id", "prediction").collect())


def test_max_iter_ends_the_rounds(points):
    starter = KMeans(k=5, seed=1, maxIter=0)
    settled = lloyd.settle(lloyd.blocks(points, "features"), [np.array(starter.fit(points).clusterCenters())], 2, 1e-4)
    assert np.allclose(KMeans(k=5, seed=1, maxIter=2).fit(points).clusterCenters(), settled[0][0])


def test_ties_go_to_the_first_center_and_an_empty_center_stays():
    (sums, cost), = lloyd.partial_sums(np.array([[0.0], [2.0]]), [np.array([[-1.0], [1.0], [1.0], [90.0]])])
    assert sums.tolist() == [[0.0, 1.0], [2.0, 1.0], [0.0, 0.0], [0.0, 0.0]] and cost == 2.0


def test_fits_share_their_passes(spark, monkeypatch):
    rng = random.Random(5)
    schema = "customer_id string, " + ", ".join(f"{c} double" for c in models.SEGMENT_INPUTS)
    rows = [(f"C{i}", *(rng.gauss(i % 3, 1) for _ in models.SEGMENT_INPUTS)) for i in range(120)]
    customers = spark.createDataFrame(rows, schema)
    seen, fit = [], KMeans.fit
    monkeypatch.setattr(KMeans, "fit", lambda self, *args: seen.append(fit(self, *args).summary.numIter) or fit(self, *args))
    models.segment_customers(customers, (3, 4), starts=3).collect()
    assert seen == [0] * 6  # no fit passes over the points in rounds of its own
