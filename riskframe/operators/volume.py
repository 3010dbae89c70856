"""Daily transaction volume and a seasonal-naive forecast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.behavior import total_amount


def daily_volume(txns: DataFrame) -> DataFrame:
    """Count and amount per calendar day between the first and the last, empty days as 0."""
    daily = (
        txns.filter(F.col("timestamp").isNotNull())
        .groupBy(F.to_date("timestamp").alias("day"))
        .agg(F.count(F.lit(1)).alias("txn_count"), total_amount().alias("amount"))
    )
    calendar = (
        daily.agg(F.min("day").alias("first"), F.max("day").alias("last"))
        .filter("first is not null")
        .select(F.explode(F.sequence("first", "last")).alias("day"))
    )
    return calendar.join(daily, "day", "left").select(
        "day",
        F.coalesce("txn_count", F.lit(0).cast("bigint")).alias("txn_count"),
        F.coalesce("amount", F.lit(0.0)).alias("amount"),
    )


def volume_forecast(daily: DataFrame, horizon_days: int = 30) -> DataFrame:
    """Each future day repeats the same weekday of the last observed week."""
    last = daily.agg(F.max("day")).scalar()
    week = daily.withColumn("_last", last).filter(F.date_diff("_last", "day") < 7)
    repeats = F.sequence(F.date_add("day", 7), F.date_add("_last", horizon_days), F.expr("interval 7 days"))
    due = F.date_add("day", 7) <= F.date_add("_last", horizon_days)
    return week.filter(due).select(F.explode(repeats).alias("day"), "txn_count", "amount")
