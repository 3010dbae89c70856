"""Segmentation and classifier training on the feature datasets, with pyspark.ml."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial
from typing import Any

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators import lloyd
from riskframe.session import shared_dir, staged, work_path

SEGMENT_INPUTS = (
    "age",
    "income",
    "credit_score",
    "hist_total_txns",
    "hist_avg_txn_amount",
    "hist_total_spend",
    "hist_fraud_count",
)
# Identifiers and anything derived from the label stay out.
FRAUD_INPUTS = (
    "amount",
    "txns_last_1h",
    "spend_last_1h",
    "txns_last_24h",
    "spend_last_24h",
    "txns_last_7d",
    "spend_last_7d",
    "seconds_since_last_txn",
    "device_customer_count",
    "device_txn_count",
    "device_risk_score",
    "ip_customer_count",
    "ip_txn_count",
    "ip_risk_score",
    "merchant_risk_score",
    "amount_vs_cust_avg",
    "amount_z_score",
    "txn_hour",
    "age",
    "income",
    "credit_score",
    "is_new_device",
    "is_new_ip",
    "is_weekend",
    "is_unusual_hour",
    "is_off_peak",
    "is_different_city",
)
DEFAULT_INPUTS = (
    "loan_amount",
    "interest_rate",
    "tenure_months",
    "monthly_income",
    "debt_to_income",
    "delinquency_history",
    "age",
    "income",
    "credit_score",
    "installment_to_income",
    "hist_total_txns",
    "hist_avg_txn_amount",
    "hist_total_spend",
)


@dataclass(frozen=True)
class Training:
    """Share held out, seed, boosting rounds and tree shape.

    With ``early_stop`` a share of the training part judges each round, and boosting ends when a round no longer
    lowers its loss by ``tolerance``. All labelled rows that are not held out are trained on, all held-out rows scored.
    """

    test_share: float = 0.20
    seed: int = 42
    rounds: int = 300
    depth: int = 6
    step: float = 0.05
    subsample: float = 0.8
    early_stop: bool = False
    validation_share: float = 0.10
    tolerance: float = 0.001


FRAUD_TRAINING = Training(early_stop=True)
CREDIT_TRAINING = Training(rounds=200, depth=5)


def _numeric(df: DataFrame, inputs: Sequence[str], *keep: str) -> DataFrame:
    return df.select(*keep, *[F.col(c).cast("double").alias(c) for c in inputs])


#: Independent fits that run side by side, as ``CrossValidator`` does it; their jobs are many and short.
FITS_AT_ONCE = 12


def _side_by_side(spark: SparkSession, calls: Sequence[Callable[[], Any]]) -> list[Any]:
    """Results of ``calls`` in their order; the Spark jobs of ``FITS_AT_ONCE`` of them run at a time."""
    with ThreadPoolExecutor(FITS_AT_ONCE) as pool:
        return list(pool.map(lambda call: call(), map(inheritable_thread_target(spark), calls)))


def segment_customers(
    features: DataFrame, clusters: Sequence[int] = (3, 4, 5, 6, 7, 8), *, seed: int = 42, max_iter: int = 300, starts: int = 10
) -> DataFrame:
    """(customer_id, segment, cluster_count, silhouette) for the k with the best silhouette; each k is the
    best of ``starts`` starts by the sum of squared distances. The rounds of all fits share their passes."""
    filled = _numeric(features, SEGMENT_INPUTS, "customer_id").fillna(0.0)
    assembled = VectorAssembler(inputCols=list(SEGMENT_INPUTS), outputCol="raw").transform(filled)
    scaler = StandardScaler(inputCol="raw", outputCol="features", withMean=True).fit(assembled)
    scaled = scaler.transform(assembled).select("customer_id", "features")
    spark = features.sparkSession
    scaled = scaled.withColumn("at", vector_to_array("features"))
    points = staged(scaled, work_path(spark, "segments")).persist()  # the starts of sixty fits read it
    settings = {"maxIter": 0, "featuresCol": "features", "predictionCol": "segment"}  # the first centers only
    starters = [KMeans(k=k, seed=seed + start, **settings) for k in clusters for start in range(starts)]
    begun = [np.array(m.clusterCenters()) for m in _side_by_side(spark, [partial(s.fit, points) for s in starters])]
    packed = lloyd.blocks(points, "features").persist()
    settled = lloyd.settle(packed, begun, max_iter, starters[0].getTol())
    packed.unpersist()
    models = [_best_start(settled[at : at + starts]) for at in range(0, len(settled), starts)]
    judge = ClusteringEvaluator(predictionCol="segment")
    segmented = [points.withColumn("segment", lloyd.nearest("at", centers)) for centers in models]
    qualities = _side_by_side(spark, [partial(judge.evaluate, rows) for rows in segmented])
    quality, k, rows = max(zip(qualities, clusters, segmented, strict=True), key=lambda found: found[0])
    points.unpersist()
    return rows.select("customer_id", "segment", F.lit(k).alias("cluster_count"), F.lit(float(quality)).alias("silhouette"))


def _best_start(settled: Sequence[tuple[np.ndarray, float]]) -> np.ndarray:
    """Centers with the least sum of squared distances; the first ones where others differ by rounding only."""
    least = min(cost for _, cost in settled)
    return next((centers for centers, cost in settled if cost <= least * (1 + 1e-9)), settled[0][0])


def split(df: DataFrame, row_id: str, test_share: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """Train and test part by a hash of the id: the same rows again after any recomputation."""
    bucket = F.pmod(F.xxhash64(F.col(row_id), F.lit(seed)), F.lit(10_000))
    limit = int(round(test_share * 10_000))
    return df.filter(bucket >= limit), df.filter(bucket < limit)


#: From so many training rows on they are dealt evenly, which takes one shuffle of them.
EVEN_FROM = 200_000


def evenly_staged(rows: DataFrame) -> DataFrame:
    """``rows`` in files of equal length, as many as tasks run at a time.

    Each level of each tree is a stage over all training rows, which lasts as long as its largest part, or twice as long
    if there is one part more than task slots. The scan packs such files into one part each.
    """
    spark = rows.sparkSession
    dealt = rows.repartition(spark.sparkContext.defaultParallelism)
    return staged(dealt, work_path(spark, "even"))


def train_classifier(
    features: DataFrame, inputs: Sequence[str], label: str, row_id: str, training: Training = FRAUD_TRAINING
) -> tuple[PipelineModel, DataFrame]:
    """Boosted trees with balanced class weights; returns the model and the scored test part."""
    rows = _numeric(features.filter(F.col(label).isNotNull()), inputs, row_id, F.col(label).cast("double").alias("label"))
    # Imputation, training and scoring all read these rows; the features are computed once.
    rows = staged(rows, work_path(features.sparkSession, "training"))
    train, test = split(rows, row_id, training.test_share, training.seed)
    if train.count() >= EVEN_FROM:  # medians, bins and rounds then read these rows only
        train = evenly_staged(train)
    context = features.sparkSession.sparkContext
    if not context.getCheckpointDir():  # boosting cuts its lineage there every ten rounds
        context.setCheckpointDir(shared_dir(features.sparkSession))
    share = train.agg(F.avg("label")).first()[0]
    if not share or share >= 1:
        raise ValueError(f"training data for {label} holds a single class")
    weight = F.when(F.col("label") == 1, F.lit(0.5 / share)).otherwise(F.lit(0.5 / (1 - share)))
    stages = [
        Imputer(inputCols=list(inputs), outputCols=[f"{c}_filled" for c in inputs], strategy="median"),
        VectorAssembler(inputCols=[f"{c}_filled" for c in inputs], outputCol="features", handleInvalid="keep"),
        GBTClassifier(
            featuresCol="features",
            labelCol="label",
            weightCol="weight",
            maxIter=training.rounds,
            maxDepth=training.depth,
            stepSize=training.step,
            subsamplingRate=training.subsample,
            seed=training.seed,
            **({"validationIndicatorCol": "_judges", "validationTol": training.tolerance} if training.early_stop else {}),
        ),
    ]
    judges = F.pmod(F.xxhash64(F.col(row_id), F.lit(training.seed + 2)), F.lit(10_000)) < int(training.validation_share * 10_000)
    model = Pipeline(stages=stages).fit(train.withColumn("weight", weight).withColumn("_judges", judges))
    scored = model.transform(test).select(
        row_id, (F.col("label") == 1).alias("label"), vector_to_array("probability")[1].alias("probability")
    )
    return model, scored
