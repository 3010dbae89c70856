"""The three feature datasets and their summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.behavior import behavioral_features, customer_txn_summary
from riskframe.operators.clean import enforce_types
from riskframe.operators.entity import DEVICE, IP, entity_features
from riskframe.operators.skew import DEFAULT_POLICY, OWNER, SkewPolicy, sliced_keys, splittable, with_owner
from riskframe.operators.velocity import velocity_cuts, velocity_features
from riskframe.sources.schemas import TABLES

# Names and order of the output columns.
VELOCITY_COLUMNS = (
    "txns_last_1h",
    "spend_last_1h",
    "txns_last_24h",
    "spend_last_24h",
    "txns_last_7d",
    "spend_last_7d",
    "seconds_since_last_txn",
)
DEVICE_COLUMNS = (
    "device_type",
    "operating_system",
    "device_customer_count",
    "device_txn_count",
    "device_fraud_rate",
    "device_risk_score",
    "is_new_device",
)
IP_COLUMNS = ("ip_customer_count", "ip_txn_count", "ip_fraud_rate", "ip_risk_score", "is_new_ip")
BEHAVIOR_COLUMNS = (
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
    "amount_vs_cust_avg",
    "amount_z_score",
    "txn_hour",
    "txn_day_of_week",
    "is_weekend",
    "is_unusual_hour",
    "is_off_peak",
    "is_different_city",
)
FRAUD_COLUMNS = (
    *TABLES["transactions"].columns,
    "timestamp_sec",
    *VELOCITY_COLUMNS,
    *DEVICE_COLUMNS,
    *IP_COLUMNS,
    *BEHAVIOR_COLUMNS,
)

# Credit flags.
MAX_DELINQUENCIES = 2
MIN_SOUND_SCORE = 580


def fraud_features(
    txns: DataFrame,
    devices: DataFrame,
    customer_devices: DataFrame,
    ip_addresses: DataFrame,
    customer_ips: DataFrame,
    customers: DataFrame,
    merchants: DataFrame,
    *,
    raw: DataFrame | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
    cuts: DataFrame | None = None,
) -> DataFrame:
    """56 columns per cleaned transaction: velocity, device, IP and behaviour.

    Velocity partitions the transactions by (customer, slice). Device, IP and customer lookups are
    brought to the same keys, so the wide rows are shuffled once for all of them; see
    ``spark.sql.requireAllClusterKeysForCoPartition`` in the session options. Only the merchant
    lookup has another key, and AQE broadcasts it while merchants are few. ``raw`` may name the
    uncleaned transactions: the keys in use are then read without de-duplication first.
    """
    source = txns if raw is None else enforce_types(raw, {"timestamp": "timestamp"})
    cuts = velocity_cuts(with_owner(source), OWNER, policy=policy) if cuts is None else cuts

    def keys(*columns: str) -> DataFrame:
        second = F.col("timestamp").cast("bigint")
        return sliced_keys(source, second, "transaction_id", cuts, *columns)

    enriched = velocity_features(with_owner(txns), key=OWNER, keep_slice=True, policy=policy, cuts=cuts)
    enriched = entity_features(enriched, devices, customer_devices, DEVICE, keys("device_id"))
    enriched = entity_features(enriched, ip_addresses, customer_ips, IP, keys("ip_address"))
    enriched = behavioral_features(enriched, customers, merchants, history=txns, keys=keys())
    return enriched.select(*FRAUD_COLUMNS)


def credit_features(loans: DataFrame, customers: DataFrame, txns: DataFrame) -> DataFrame:
    """26 columns per loan: the loan, its customer, the transaction history, burden and risk flag."""
    # A loan whose customer is unknown may still have a transaction history, hence the full join.
    by_customer = customers.drop("employment_status").join(customer_txn_summary(txns), "customer_id", "full")
    burden = F.try_divide(F.try_divide(F.col("loan_amount"), F.col("tenure_months")), F.col("monthly_income"))
    risky = (F.col("delinquency_history") > MAX_DELINQUENCIES) | (F.col("credit_score") < MIN_SOUND_SCORE)
    columns = TABLES["loans"].columns + [c for c in by_customer.columns if c != "customer_id"]
    joined = loans.join(splittable(by_customer), "customer_id", "left")
    return joined.select(
        *columns,
        F.when(F.col("monthly_income") > 0, burden).otherwise(F.lit(0.0)).alias("installment_to_income"),
        F.coalesce(risky, F.lit(False)).alias("delinquency_risk_flag"),
    )


def customer_features(customers: DataFrame, txns: DataFrame) -> DataFrame:
    """14 columns per customer. Without transactions the mean stays null, the rest is 0."""
    joined = customers.join(customer_txn_summary(txns), "customer_id", "left")
    zero = F.lit(0).cast("bigint")
    return joined.select(
        *TABLES["customers"].columns,
        F.coalesce(F.col("hist_total_txns"), zero).alias("hist_total_txns"),
        "hist_avg_txn_amount",
        F.coalesce(F.col("hist_total_spend"), F.lit(0.0)).alias("hist_total_spend"),
        F.coalesce(F.col("hist_fraud_count"), zero).alias("hist_fraud_count"),
    )


def feature_summary(features: DataFrame) -> DataFrame:
    """Totals and shares of new devices, new IPs and fraud, in one pass."""
    share = lambda c: F.try_divide(F.count_if(F.col(c)) * F.lit(100.0), F.count(F.lit(1)))
    return features.agg(
        F.count(F.lit(1)).alias("total_txns"),
        F.count_if(F.col("is_new_device")).alias("new_device_txns"),
        share("is_new_device").alias("new_device_pct"),
        F.count_if(F.col("is_new_ip")).alias("new_ip_txns"),
        share("is_new_ip").alias("new_ip_pct"),
        F.count_if(F.col("is_fraud")).alias("fraud_txns"),
        share("is_fraud").alias("fraud_pct"),
    )


# The columns of the sample.
def new_entity_sample(features: DataFrame, rows: int = 8) -> DataFrame:
    """The first transactions, by id, that used a device or IP new to their customer."""
    return (
        features.filter(F.col("is_new_device") | F.col("is_new_ip"))
        .select(
            "transaction_id",
            "customer_id",
            "device_id",
            "ip_address",
            "is_new_device",
            "device_risk_score",
            "is_new_ip",
            "ip_risk_score",
            "txns_last_1h",
            "spend_last_24h",
            "amount_z_score",
            "is_fraud",
        )
        .orderBy("transaction_id")
        .limit(rows)
    )
