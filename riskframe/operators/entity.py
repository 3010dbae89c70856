"""Device and IP intelligence: usage counts, risk tiers and new-entity flags."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators.skew import OWNER, join_spread, splittable, with_owner
from riskframe.sources.schemas import require


@dataclass(frozen=True)
class EntityKind:
    """What differs between devices and IP addresses.

    ``tiers`` lists (more customers than, risk score), highest first; ``base_risk`` is the rest.
    """

    key: str
    prefix: str
    tiers: tuple[tuple[int, float], ...]
    base_risk: float = 0.05
    profile: tuple[str, ...] = ()

    def risk(self, customers: Column) -> Column:
        score = F.lit(self.base_risk)
        for above, value in reversed(self.tiers):
            score = F.when(customers > above, F.lit(value)).otherwise(score)
        return score


# Sharing thresholds and their risk scores.
DEVICE = EntityKind("device_id", "device", ((3, 0.85), (1, 0.40)), profile=("device_type", "operating_system"))
IP = EntityKind("ip_address", "ip", ((5, 0.90), (2, 0.50)))


def customer_count(usage: DataFrame, kind: EntityKind) -> DataFrame:
    """Distinct customers per entity. Spark counts (entity, customer) pairs first, so a popular
    entity is spread over its customers before the final count."""
    return usage.groupBy(kind.key).agg(F.countDistinct("customer_id").alias(f"{kind.prefix}_customer_count"))


def entity_profile(entities: DataFrame, usage: DataFrame, kind: EntityKind) -> DataFrame:
    """One row per registered entity: customers, transactions, fraud rate, risk score."""
    p = kind.prefix
    joined = entities.join(customer_count(usage, kind), kind.key, "left")
    customers = F.coalesce(F.col(f"{p}_customer_count"), F.lit(1).cast("bigint"))
    txns = F.coalesce(F.col("transaction_count"), F.lit(0))
    frauds = F.coalesce(F.col("fraud_count"), F.lit(0))
    return joined.select(
        kind.key,
        *kind.profile,
        customers.alias(f"{p}_customer_count"),
        txns.alias(f"{p}_txn_count"),
        F.when(txns > 0, frauds / txns).otherwise(F.lit(0.0)).alias(f"{p}_fraud_rate"),
        kind.risk(customers).alias(f"{p}_risk_score"),
    )


def entity_features(
    txns: DataFrame, entities: DataFrame, usage: DataFrame, kind: EntityKind, keys: DataFrame | None = None
) -> DataFrame:
    """Append the profile of the transaction's entity and ``is_new_<prefix>``.

    An entity missing from ``entities`` gets rate and risk 0.0 and counts 1; a pair missing from
    ``usage`` (or without an entity) is new. All lookups are on unique keys, so rows never multiply.

    Profile and usage are looked up once per distinct (customer, entity) pair in use, and the wide
    rows are joined once, by pair: a popular entity is spread over its customers. ``keys`` may
    bring those combinations, with further columns that ``txns`` is already partitioned by.
    """
    require(txns, "customer_id", kind.key)
    p = kind.prefix
    rows = txns
    if keys is None:
        rows = with_owner(txns)
        keys = rows.select("customer_id", OWNER, kind.key).distinct()
    known = usage.select("customer_id", kind.key).distinct().withColumn(f"is_new_{p}", F.lit(False))
    looked_up = (
        keys.filter(F.col(kind.key).isNotNull())
        .join(known, ["customer_id", kind.key], "left")
        .join(splittable(entity_profile(entities, usage, kind)), kind.key, "left")
    )
    defaults = {f"{p}_customer_count": 1, f"{p}_txn_count": 1, f"{p}_fraud_rate": 0.0, f"{p}_risk_score": 0.0}
    return join_spread(rows, looked_up, keys).select(
        *txns.columns,
        *kind.profile,
        *[F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in defaults.items()],
        F.coalesce(F.col(f"is_new_{p}"), F.lit(True)).alias(f"is_new_{p}"),
    )


def device_features(txns: DataFrame, devices: DataFrame, customer_devices: DataFrame) -> DataFrame:
    return entity_features(txns, devices, customer_devices, DEVICE)


def ip_features(txns: DataFrame, ip_addresses: DataFrame, customer_ips: DataFrame) -> DataFrame:
    return entity_features(txns, ip_addresses, customer_ips, IP)


def refresh_stats(txns: DataFrame, kind: EntityKind) -> DataFrame:
    """Activity counters per entity, recomputed from the transactions."""
    return (
        txns.filter(F.col(kind.key).isNotNull())
        .groupBy(kind.key)
        .agg(
            F.min("timestamp").alias("first_seen"),
            F.max("timestamp").alias("last_seen"),
            F.count(F.lit(1)).alias("transaction_count"),
            F.count_if(F.col("is_fraud")).alias("fraud_count"),
            F.countDistinct("customer_id").alias("customer_count"),
        )
    )


def usage_map(txns: DataFrame, kind: EntityKind) -> DataFrame:
    """Which customer used which entity, since when, until when and how often."""
    return (
        txns.filter(F.col("customer_id").isNotNull() & F.col(kind.key).isNotNull())
        .groupBy("customer_id", kind.key)
        .agg(
            F.min("timestamp").alias("first_used"),
            F.max("timestamp").alias("last_used"),
            F.count(F.lit(1)).alias("use_count"),
        )
    )


def check_new_device(requests: DataFrame, customer_devices: DataFrame) -> DataFrame:
    """Answer (customer_id, device_id) requests: is the device new to the customer, and if not,
    how often and since when was it used."""
    known = customer_devices.select(
        "customer_id",
        "device_id",
        F.lit(True).alias("_known"),
        F.col("use_count").alias("_uses"),
        F.col("first_used").alias("first_used_timestamp"),
    )
    return requests.join(known, ["customer_id", "device_id"], "left").select(
        *requests.columns,
        F.col("_known").isNull().alias("is_new_device"),
        F.coalesce(F.col("_uses"), F.lit(0)).alias("previous_use_count"),
        "first_used_timestamp",
    )


def register_check_new_device(spark: SparkSession, mapping_view: str, name: str = "check_new_device") -> None:
    """The same lookup for SQL: ``SELECT * FROM check_new_device('C1', 'D1')``."""
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(p_customer STRING, p_device STRING)
        RETURNS TABLE (is_new_device BOOLEAN, previous_use_count INT, first_used_timestamp TIMESTAMP)
        RETURN SELECT m.customer_id IS NULL, coalesce(m.use_count, 0), m.first_used
               FROM (SELECT p_customer AS c, p_device AS d) r
               LEFT JOIN {mapping_view} m ON r.c = m.customer_id AND r.d = m.device_id
    """)


def first_use(txns: DataFrame, kind: EntityKind = DEVICE) -> DataFrame:
    """Per (customer, entity) the id of the earliest transaction, by (timestamp, transaction_id).

    A minimum combines on the map side, where a ranking window would gather the whole pair.
    """
    earliest = F.min(F.struct("timestamp", "transaction_id"))
    return (
        txns.filter(F.col("customer_id").isNotNull() & F.col(kind.key).isNotNull())
        .groupBy("customer_id", kind.key)
        .agg(earliest.alias("_earliest"))
        .select("customer_id", kind.key, F.col("_earliest.transaction_id").alias("_first_id"))
    )


def point_in_time_pairs(txns: DataFrame, usage: DataFrame, kind: EntityKind = DEVICE) -> DataFrame:
    """(customer_id, entity, ``_first_id``, ``_known``) per pair in ``txns``."""
    known = usage.select("customer_id", kind.key).distinct().withColumn("_known", F.lit(True))
    return first_use(txns, kind).join(known, ["customer_id", kind.key], "left")


def point_in_time_new(txns: DataFrame, usage: DataFrame, kind: EntityKind = DEVICE) -> DataFrame:
    """Append ``is_first_use`` (nobody but this row came first) and ``is_new_now`` (first use of
    an entity that is not in the customer's known set either)."""
    first = F.coalesce(F.col("_first_id") == F.col("transaction_id"), F.lit(False))
    pairs = splittable(point_in_time_pairs(txns, usage, kind))
    joined = txns.join(pairs, ["customer_id", kind.key], "left")
    return joined.select(
        *txns.columns, first.alias("is_first_use"), (first & F.col("_known").isNull()).alias("is_new_now")
    )
