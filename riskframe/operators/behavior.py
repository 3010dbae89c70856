"""Spending statistics per customer and anomaly features per transaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import cents, flag, from_cents
from riskframe.operators.clean import deduplicate
from riskframe.operators.skew import join_spread, splittable
from riskframe.sources.schemas import require

# Hours and weekdays (1 = Sunday) behind the time flags, fallback merchant risk.
UNUSUAL_HOURS = (2, 3, 4)
OFF_PEAK_HOURS = (0, 1, 2, 3, 4, 5, 6, 22, 23)
WEEKEND_DAYS = (1, 7)
DEFAULT_MERCHANT_RISK = 0.1


def total_amount(amount: str = "amount") -> Column:
    """Exact sum; null when there is no amount at all."""
    return from_cents(F.sum(cents(F.col(amount))))


def mean_amount(amount: str = "amount") -> Column:
    return F.try_divide(total_amount(amount), F.count(amount))


def customer_amount_stats(txns: DataFrame) -> DataFrame:
    """Mean, sample deviation (1.0 if undefined), maximum and count over the whole history."""
    return txns.groupBy("customer_id").agg(
        mean_amount().alias("cust_avg_amount"),
        F.coalesce(F.stddev_samp("amount"), F.lit(1.0)).alias("cust_std_amount"),
        F.max("amount").alias("cust_max_amount"),
        F.count("transaction_id").alias("cust_total_txns"),
    )


def customer_txn_summary(txns: DataFrame) -> DataFrame:
    """Number, mean, total and fraud count of each customer's transactions."""
    return txns.groupBy("customer_id").agg(
        F.count("transaction_id").alias("hist_total_txns"),
        mean_amount().alias("hist_avg_txn_amount"),
        total_amount().alias("hist_total_spend"),
        F.count_if(F.col("is_fraud")).alias("hist_fraud_count"),
    )


def behavioral_features(
    txns: DataFrame,
    customers: DataFrame,
    merchants: DataFrame,
    history: DataFrame | None = None,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Append customer statistics and profile, amount deviation, time and location flags, and the
    merchant's name and risk (its own score wins over the one on the transaction, then 0.1).

    Statistics come from ``history`` (default: ``txns`` itself; pass the plain transactions when
    ``txns`` already carries costly features). They are joined to the profile first, so the
    transactions meet one customer-keyed table instead of two. ``keys`` (distinct customer_id and
    further columns of ``txns``) spreads that table over the same keys before the join.
    """
    require(txns, "transaction_id", "customer_id", "merchant_id", "amount", "timestamp", "city")
    profile = customers.select(
        "customer_id", "age", "income", "credit_score", "risk_profile", F.col("city").alias("home_city")
    )
    by_customer = customer_amount_stats(txns if history is None else history).join(profile, "customer_id", "left")
    if keys is None:
        rows = txns.join(splittable(by_customer), "customer_id", "left")
    else:
        rows = join_spread(txns, keys.join(by_customer, "customer_id"), keys)
    shops = deduplicate(
        merchants.select("merchant_id", "merchant_name", F.col("merchant_risk_score").alias("_shop_risk")), "merchant_id"
    )
    own_risk = [F.col("merchant_risk_score")] if "merchant_risk_score" in txns.columns else []
    amount, mean, deviation = F.col("amount"), F.col("cust_avg_amount"), F.col("cust_std_amount")
    hour, day = F.hour("timestamp"), F.dayofweek("timestamp")
    return (
        rows.join(splittable(shops), "merchant_id", "left")
        .select(
            *[c for c in txns.columns if c != "merchant_risk_score"],
            F.coalesce(F.col("_shop_risk"), *own_risk, F.lit(DEFAULT_MERCHANT_RISK)).alias("merchant_risk_score"),
            "cust_avg_amount",
            "cust_std_amount",
            "cust_max_amount",
            "cust_total_txns",
            "age",
            "income",
            "credit_score",
            "risk_profile",
            "home_city",
            "merchant_name",
            F.when(mean > 0, amount / mean).otherwise(F.lit(1.0)).alias("amount_vs_cust_avg"),
            F.when(deviation > 0, (amount - mean) / deviation).otherwise(F.lit(0.0)).alias("amount_z_score"),
            hour.alias("txn_hour"),
            day.alias("txn_day_of_week"),
            flag(day.isin(*WEEKEND_DAYS)).alias("is_weekend"),
            flag(hour.isin(*UNUSUAL_HOURS)).alias("is_unusual_hour"),
            flag(hour.isin(*OFF_PEAK_HOURS)).alias("is_off_peak"),
            flag(F.col("city") != F.col("home_city")).alias("is_different_city"),
        )
    )
