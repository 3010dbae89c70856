"""Classifier training: all training rows, dealt evenly over the task slots before boosting."""

from pyspark.ml import Pipeline
from pyspark.sql.classic.dataframe import DataFrame

from riskframe.operators import models

INPUTS = ("a", "b")
TRAINING = models.Training(rounds=2, depth=2)


def _rows(spark, count):
    rows = [(f"R{i}", float(i % 7), float(i % 11), i % 7 > 3) for i in range(count)]
    return spark.createDataFrame(rows, "row_id string, a double, b double, bad boolean").coalesce(1)


def test_training_rows_are_dealt_evenly(spark, monkeypatch):
    seen, fit = [], Pipeline.fit

    def watched(self, rows):
        seen.append(rows.rdd.glom().map(lambda part: sorted(r["row_id"] for r in part)).collect())
        return fit(self, rows)

    monkeypatch.setattr(Pipeline, "fit", watched)
    monkeypatch.setattr(models, "EVEN_FROM", 100, raising=False)
    features = _rows(spark, 400)
    _, scored = models.train_classifier(features, INPUTS, "bad", "row_id", TRAINING)
    sizes = [len(part) for part in seen[0]]
    assert len(sizes) == spark.sparkContext.defaultParallelism and max(sizes) - min(sizes) <= 1
    train, test = models.split(features, "row_id", TRAINING.test_share, TRAINING.seed)
    assert sorted(sum(seen[0], [])) == sorted(r["row_id"] for r in train.collect())
    assert {r["row_id"]: r["label"] for r in scored.collect()} == {r["row_id"]: r["bad"] for r in test.collect()}


def test_few_rows_stay_where_they_are(spark, monkeypatch):
    monkeypatch.setattr(models, "evenly_staged", None)
    _, scored = models.train_classifier(_rows(spark, 100), INPUTS, "bad", "row_id", TRAINING)
    assert 0 < scored.count() < 100


def test_every_training_row_is_trained_on(spark, monkeypatch):
    seen, fit = [], Pipeline.fit

    def watched(self, rows):
        seen.extend(r["row_id"] for r in rows.collect())
        return fit(self, rows)

    monkeypatch.setattr(Pipeline, "fit", watched)
    monkeypatch.setattr(DataFrame, "count", lambda self: 50_000_000)  # the size that a bound would look at
    features = _rows(spark, 400)
    models.train_classifier(features, INPUTS, "bad", "row_id", TRAINING)
    train, _ = models.split(features, "row_id", TRAINING.test_share, TRAINING.seed)
    assert sorted(seen) == sorted(r["row_id"] for r in train.collect())
