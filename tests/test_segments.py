"""Segmentation: fits run side by side and give what they give one after the other."""

import random
import threading

import pytest
from pyspark.ml.clustering import KMeans

from riskframe.operators import models

SCHEMA = "customer_id string, " + ", ".join(f"{c} double" for c in models.SEGMENT_INPUTS)


@pytest.fixture(scope="module")
def customers(spark):
    rng = random.Random(5)
    rows = [(f"C{i}", *(rng.gauss(10 * (i % 3), 1) for _ in models.SEGMENT_INPUTS)) for i in range(90)]
    return spark.createDataFrame(rows, SCHEMA)


def test_fits_run_side_by_side(customers, monkeypatch):
    met, fit = threading.Barrier(2), KMeans.fit

    def together(self, *args):
        met.wait(60)  # broken, and so an error, if fits come one at a time
        return fit(self, *args)

    monkeypatch.setattr(KMeans, "fit", together)
    found = models.segment_customers(customers, (2, 3), starts=2)
    assert {r["cluster_count"] for r in found.collect()} == {3}


def test_the_same_as_one_at_a_time(customers, monkeypatch):
    rows = lambda: sorted(models.segment_customers(customers, (2, 3, 4), starts=3).collect())
    side_by_side = rows()
    monkeypatch.setattr(models, "FITS_AT_ONCE", 1)
    assert side_by_side == rows() and len(side_by_side) == 90
