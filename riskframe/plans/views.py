"""The SQL feature views, as DataFrames that can be registered as temporary views."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import epoch_micros, rate4
from riskframe.operators.behavior import mean_amount, total_amount
from riskframe.operators.entity import DEVICE, IP, EntityKind, customer_count
from riskframe.operators.skew import OWNER, attach, with_owner
from riskframe.operators.velocity import transaction_velocity_view

UNMAPPED_RISK = 0.05


def _customer_activity(txns: DataFrame) -> DataFrame:
    """Per customer, before any join: the join then moves one row per customer.

    The three distinct counts share one expansion; its rows combine on the map side.
    """
    return txns.groupBy("customer_id").agg(
        F.count("transaction_id").alias("n"),
        total_amount().alias("total"),
        mean_amount().alias("mean"),
        F.stddev_samp("amount").alias("deviation"),
        F.max("amount").alias("largest"),
        F.min("timestamp").alias("first_at"),
        F.max("timestamp").alias("last_at"),
        F.countDistinct("device_id").alias("devices"),
        F.countDistinct("ip_address").alias("ips"),
        F.countDistinct("merchant_id").alias("merchants"),
        F.count_if(F.col("is_fraud")).alias("frauds"),
    )


def _or_zero(name: str, kind: str = "bigint") -> Column:
    return F.coalesce(F.col(name), F.lit(0).cast(kind))


def customer_features_view(customers: DataFrame, txns: DataFrame) -> DataFrame:
    joined = customers.join(_customer_activity(txns), "customer_id", "left")
    return joined.select(
        "customer_id",
        "age",
        "gender",
        "income",
        "employment_status",
        "city",
        "state",
        "credit_score",
        "risk_profile",
        _or_zero("n").alias("total_transactions"),
        _or_zero("total", "double").alias("total_spend"),
        _or_zero("mean", "double").alias("avg_transaction_amount"),
        _or_zero("deviation", "double").alias("stddev_transaction_amount"),
        _or_zero("largest", "double").alias("max_transaction_amount"),
        F.col("last_at").alias("last_transaction_timestamp"),
        _or_zero("devices").alias("unique_devices_used"),
        _or_zero("ips").alias("unique_ips_used"),
        _or_zero("merchants").alias("unique_merchants_visited"),
        _or_zero("frauds").alias("fraud_transaction_count"),
        rate4(_or_zero("frauds"), _or_zero("n")).alias("customer_fraud_rate"),
    )


def customer_transaction_summary(customers: DataFrame, txns: DataFrame) -> DataFrame:
    joined = customers.select("customer_id").join(_customer_activity(txns), "customer_id", "left")
    return joined.select(
        "customer_id",
        _or_zero("n").alias("total_transactions"),
        F.col("total").alias("total_spend"),
        F.col("mean").alias("avg_transaction_amount"),
        F.col("deviation").alias("stddev_amount"),
        F.col("last_at").alias("last_transaction_date"),
        F.col("first_at").alias("first_transaction_date"),
        _or_zero("devices").alias("unique_devices"),
        _or_zero("ips").alias("unique_ips"),
        _or_zero("merchants").alias("unique_merchants"),
        _or_zero("frauds").alias("fraud_transaction_count"),
    )


def high_risk_customers(customers: DataFrame, txns: DataFrame) -> DataFrame:
    summary = customer_transaction_summary(customers, txns)
    frauds, n = F.col("fraud_transaction_count"), F.col("total_transactions")
    return (
        customers.select("customer_id", "risk_profile", "credit_score")
        .join(summary, "customer_id")
        .filter((F.col("risk_profile") == "high") | (frauds > 0) | (F.col("credit_score") < 550))
        .select(
            "customer_id",
            "risk_profile",
            "credit_score",
            "total_transactions",
            "fraud_transaction_count",
            "unique_devices",
            rate4(frauds, n).alias("fraud_rate"),
        )
    )


def _shared(entities: DataFrame, usage: DataFrame, kind: EntityKind) -> DataFrame:
    counted = customer_count(usage, kind).withColumnRenamed(f"{kind.prefix}_customer_count", "_customers")
    return entities.join(counted, kind.key, "left").withColumn("_customers", _or_zero("_customers"))


def _intelligence(entities: DataFrame, usage: DataFrame, kind: EntityKind) -> DataFrame:
    return _shared(entities, usage, kind).select(
        kind.key,
        *kind.profile,
        F.col("_customers").alias("shared_customer_count"),
        F.col("transaction_count").alias("global_transaction_count"),
        F.col("fraud_count").alias("global_fraud_count"),
        rate4(F.col("fraud_count"), F.col("transaction_count")).alias(f"{kind.prefix}_fraud_rate"),
        kind.risk(F.col("_customers")).alias(f"{kind.prefix}_risk_score"),
    )


def device_intelligence(devices: DataFrame, customer_devices: DataFrame) -> DataFrame:
    return _intelligence(devices, customer_devices, DEVICE)


def ip_intelligence(ip_addresses: DataFrame, customer_ips: DataFrame) -> DataFrame:
    return _intelligence(ip_addresses, customer_ips, IP)


def device_risk(devices: DataFrame, customer_devices: DataFrame, as_of: Column) -> DataFrame:
    """``as_of`` stands in for the current time, so results can be reproduced."""
    age_days = (epoch_micros(as_of) - epoch_micros(F.col("first_seen"))) / F.lit(86_400_000_000.0)
    return _shared(devices, customer_devices, DEVICE).select(
        "device_id",
        "device_type",
        "operating_system",
        F.col("_customers").alias("customer_count"),
        "transaction_count",
        "fraud_count",
        rate4(F.col("fraud_count"), F.col("transaction_count")).alias("fraud_rate"),
        age_days.alias("device_age_days"),
    )


def new_device_detection(
    txns: DataFrame, customer_devices: DataFrame, device_view: DataFrame, ip_view: DataFrame
) -> DataFrame:
    """Known-device lookup plus risk scores; entities that are not registered count as 0.05.

    Usage and device risk meet on the distinct (customer, device) pairs first, so the transactions
    are joined once for both, and a popular device is spread over its customers.
    """
    known = customer_devices.select(
        "customer_id", "device_id", F.lit(True).alias("_known"), F.col("use_count").alias("_uses")
    )
    by_device = device_view.select("device_id", F.col("device_risk_score").alias("_device"))
    by_ip = ip_view.select("ip_address", F.col("ip_risk_score").alias("_ip"))
    rows = with_owner(txns)
    pairs = rows.select("customer_id", OWNER, "device_id").filter(F.col("device_id").isNotNull()).distinct()
    rows = attach(rows, pairs, [(known, ["customer_id", "device_id"]), (by_device, ["device_id"])])
    return (
        attach(rows, None, [(by_ip, ["ip_address"])])
        .select(
            "transaction_id",
            "customer_id",
            "account_id",
            "device_id",
            "ip_address",
            "amount",
            "timestamp",
            "merchant_id",
            "merchant_category",
            "is_fraud",
            "fraud_scenario",
            F.col("_known").isNull().alias("is_new_device"),
            F.coalesce(F.col("_uses"), F.lit(0)).alias("customer_device_use_count"),
            F.coalesce(F.col("_device"), F.lit(UNMAPPED_RISK)).alias("device_risk_score"),
            F.coalesce(F.col("_ip"), F.lit(UNMAPPED_RISK)).alias("ip_risk_score"),
        )
    )


def new_device_sample(detection: DataFrame, rows: int = 10) -> DataFrame:
    return (
        detection.filter("is_new_device")
        .select(
            "transaction_id",
            "customer_id",
            "device_id",
            "is_new_device",
            "customer_device_use_count",
            "device_risk_score",
            "is_fraud",
            "fraud_scenario",
        )
        .orderBy("transaction_id")
        .limit(rows)
    )


def new_device_summary(detection: DataFrame) -> DataFrame:
    """One row: transactions, new-device transactions, their share in percent (two digits), frauds."""
    new, total = F.count_if(F.col("is_new_device")), F.count(F.lit(1))
    # Percent with two digits is the four-digit rate times 100, rounded half up on integers.
    hundredths = F.call_function("div", new * 20000 + total, total * 2)
    return detection.agg(
        total.alias("total_transactions"),
        new.alias("new_device_count"),
        F.when(total > 0, hundredths / F.lit(100.0)).alias("new_device_pct"),
        F.count_if(F.col("is_new_device") & F.col("is_fraud")).alias("new_device_fraud_count"),
    )


def build_views(tables: Mapping[str, DataFrame], as_of: Column | None = None) -> dict[str, DataFrame]:
    """All eight views over a mapping of table name to DataFrame."""
    txns, customers = tables["transactions"], tables["customers"]
    if as_of is None:
        as_of = F.current_timestamp()
    devices = device_intelligence(tables["devices"], tables["customer_devices"])
    ips = ip_intelligence(tables["ip_addresses"], tables["customer_ips"])
    return {
        "v_customer_features": customer_features_view(customers, txns),
        "v_device_intelligence": devices,
        "v_ip_intelligence": ips,
        "v_new_device_detection": new_device_detection(txns, tables["customer_devices"], devices, ips),
        "v_transaction_velocity": transaction_velocity_view(txns),
        "v_customer_transaction_summary": customer_transaction_summary(customers, txns),
        "v_device_risk": device_risk(tables["devices"], tables["customer_devices"], as_of),
        "v_high_risk_customers": high_risk_customers(customers, txns),
    }


def register_views(tables: Mapping[str, DataFrame], as_of: Column | None = None) -> list[str]:
    """Register tables and views for ``spark.sql``; returns the view names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    views = build_views(tables, as_of)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
