"""Discrimination of a score: ROC-AUC, PR-AUC and KS."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def score_histogram(df: DataFrame, score: Column, label: Column, digits: int = 4) -> DataFrame:
    """Positives and negatives per rounded score: at most 10^digits + 1 rows for scores in [0, 1].

    Rows without score or label are counted out, not filtered: a filter would work out the score a second time.
    """
    scored = F.col("score").isNotNull()
    return (
        df.select(F.round(score, digits).alias("score"), label.alias("label"))
        .groupBy("score")
        .agg(F.count_if(F.col("label") & scored).alias("pos"), F.count_if(~F.col("label") & scored).alias("neg"))
        .filter(F.col("pos") + F.col("neg") > 0)
    )


def score_metrics(df: DataFrame, score: Column, label: Column, digits: int = 4) -> DataFrame:
    """One row of metrics. Only the histogram, whose size is fixed by ``digits``, is ordered."""
    everything = Window.partitionBy(F.lit(0))
    rising = everything.orderBy("score")
    falling = everything.orderBy(F.col("score").desc())
    to_here = (Window.unboundedPreceding, Window.currentRow)
    curve = score_histogram(df, score, label, digits).select(
        "pos",
        "neg",
        F.sum("pos").over(everything).alias("p"),
        F.sum("neg").over(everything).alias("n"),
        F.sum("pos").over(rising.rowsBetween(*to_here)).alias("pos_up"),
        F.sum("neg").over(rising.rowsBetween(*to_here)).alias("neg_up"),
        F.sum("pos").over(falling.rowsBetween(*to_here)).alias("tp"),
        F.sum("neg").over(falling.rowsBetween(*to_here)).alias("fp"),
    )
    # Twice the number of correctly ordered pairs, ties counting half, is a whole number.
    ordered = F.sum((F.col("pos") * (2 * (F.col("neg_up") - F.col("neg")) + F.col("neg"))).cast("decimal(38,0)"))
    pairs = F.max(F.col("p")).cast("double") * F.max("n") * 2
    distance = F.abs(F.try_divide(F.col("pos_up"), F.col("p")) - F.try_divide(F.col("neg_up"), F.col("n")))
    step = F.try_divide(F.col("pos"), F.col("p")) * F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))
    return curve.agg(
        F.max("p").alias("positives"),
        F.max("n").alias("negatives"),
        F.round(F.try_divide(ordered.cast("double"), pairs), 6).alias("roc_auc"),
        F.round(F.sum(step), 6).alias("pr_auc"),
        F.round(F.max(distance), 6).alias("ks"),
    )
