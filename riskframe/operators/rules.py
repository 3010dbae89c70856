"""Thirteen fraud rules as independent boolean columns, and the label they imply."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import epoch_micros, flag, haversine_km
from riskframe.operators.behavior import mean_amount
from riskframe.operators.clean import deduplicate
from riskframe.operators.entity import DEVICE, IP, customer_count, point_in_time_pairs
from riskframe.operators.skew import DEFAULT_POLICY, OWNER, SkewPolicy, attach, row_cuts, sliced_keys, splittable, with_owner
from riskframe.operators.timeline import look_back

# Rule names in evaluation order with the fraud probability of a hit.
# The network rule comes last: it labels only what no other rule has labelled.
PROBABILITY = {
    "new_device_fraud": 0.18,
    "velocity_attack": 0.70,
    "impossible_travel": 0.85,
    "unusual_hours": 0.35,
    "merchant_collusion": 0.55,
    "account_takeover": 0.60,
    "device_sharing": 0.30,
    "ip_sharing": 0.25,
    "abnormal_spending": 0.45,
    "repeated_failures": 0.40,
    "card_not_present": 0.12,
    "geo_anomaly": 0.28,
    "coordinated_network": 0.30,
}
RULES = tuple(PROBABILITY)
NO_WINDOW = -(1 << 62)


@dataclass(frozen=True)
class RuleConfig:
    """Thresholds and switches; the defaults are fixed values."""

    enabled: frozenset[str] = field(default_factory=lambda: frozenset(RULES))
    velocity_burst: tuple[int, int] = (3, 60)
    failure_burst: tuple[int, int] = (4, 300)
    max_speed_kmh: float = 900.0
    night_hours: tuple[int, ...] = (2, 3, 4)
    night_amount: float = 5000.0
    merchant_risk: float = 0.65
    merchant_amount_factor: float = 3.0
    takeover_amount_factor: float = 5.0
    device_customers: int = 3
    ip_customers: int = 5
    deviations: float = 5.0
    online_method: str = "online"
    online_categories: tuple[str, ...] = ("electronics", "gambling", "cryptocurrency")
    home_distance_km: float = 3000.0
    network_customers: int = 5
    network_seconds: int = 3600


DEFAULT_CONFIG = RuleConfig()


@dataclass(frozen=True)
class RuleInputs:
    """What the rules look up besides the transactions.

    ``homes`` has (customer_id, home_latitude, home_longitude).
    """

    customer_devices: DataFrame
    customer_ips: DataFrame
    merchants: DataFrame
    homes: DataFrame


def customer_baseline(txns: DataFrame) -> DataFrame:
    """Mean and population deviation per customer; the deviation of a single amount counts as 1.0."""
    deviation = F.when(F.count("amount") > 1, F.stddev_pop("amount")).otherwise(F.lit(1.0))
    return txns.groupBy("customer_id").agg(mean_amount().alias("_mean"), deviation.alias("_std"))


def _travel(cfg: RuleConfig) -> dict[str, Column]:
    gap = epoch_micros(F.col("timestamp")) - epoch_micros(F.col("prev_timestamp"))
    distance = haversine_km(F.col("prev_latitude"), F.col("prev_longitude"), F.col("latitude"), F.col("longitude"))
    hours = F.when(gap > 0, gap / F.lit(3_600_000_000.0))
    return {
        "impossible_travel": flag(F.try_divide(distance, hours) > cfg.max_speed_kmh),
        "_has_previous": F.col("prev_timestamp").isNotNull(),
    }


def _clock_window(cfg: RuleConfig) -> Column:
    """Number of the clock window; rows without time share ``NO_WINDOW``, so they still find their
    merchant."""
    length = cfg.network_seconds * 1_000_000
    number = F.floor(epoch_micros(F.col("timestamp")) / F.lit(length)).cast("bigint")
    return F.coalesce(number, F.lit(NO_WINDOW).cast("bigint")).alias("_window")


def _merchant_windows(txns: DataFrame, cfg: RuleConfig) -> DataFrame:
    """Per (merchant, clock window): did many customers pay? Distinct payers are counted as
    (merchant, window, customer) groups first, so a popular merchant is spread."""
    crowded = (F.countDistinct("customer_id") >= cfg.network_customers) & (F.col("_window") != NO_WINDOW)
    windows = txns.select("merchant_id", "customer_id", _clock_window(cfg))
    return windows.groupBy("merchant_id", "_window").agg(crowded.alias("coordinated_network"))


def rule_flags(
    txns: DataFrame,
    inputs: RuleInputs,
    only: Iterable[str] = RULES,
    *,
    also: Mapping[str, DataFrame] | None = None,
    config: RuleConfig = DEFAULT_CONFIG,
    policy: SkewPolicy = DEFAULT_POLICY,
    cuts: DataFrame | None = None,
) -> DataFrame:
    """Append one flag per rule in ``only``; a disabled rule is false. Only lookups that a wanted
    rule needs enter the plan. Unknown outcomes count as false.

    ``also`` maps ``customer_id``, ``device_id`` or ``ip_address`` to a further table keyed by it; its
    columns are appended too, by the joins that the rules make anyway.
    """
    also = dict(also or {})
    asked = [r for r in RULES if r in set(only)]
    wanted = {r for r in asked if r in config.enabled}
    cfg = config
    df = with_owner(txns)
    ordered = wanted & {"velocity_attack", "repeated_failures", "impossible_travel"}
    if ordered:
        at = epoch_micros(F.col("timestamp"))
        cuts = row_cuts(df, OWNER, F.array(at), "transaction_id", policy) if cuts is None else cuts
        limits = {"velocity_attack": cfg.velocity_burst, "repeated_failures": cfg.failure_burst}
        travels = "impossible_travel" in wanted
        df = look_back(
            df,
            ("latitude", "longitude", "timestamp") if travels else (),
            {r: limit for r, limit in limits.items() if r in wanted},
            key=OWNER,
            keep_slice=True,
            policy=policy,
            cuts=cuts,
        )
        if travels:
            df = df.withColumns(_travel(cfg)).drop("prev_latitude", "prev_longitude", "prev_timestamp")

    def keys(*columns: str) -> DataFrame | None:
        return sliced_keys(txns, at, "transaction_id", cuts, *columns) if ordered else None

    by_device, by_ip, by_customer = [], [], []
    if wanted & {"new_device_fraud", "account_takeover"}:
        by_device.append((point_in_time_pairs(txns, inputs.customer_devices, DEVICE), ["customer_id", "device_id"]))
    if "device_sharing" in wanted:
        by_device.append((customer_count(inputs.customer_devices, DEVICE), ["device_id"]))
    if "ip_sharing" in wanted:
        by_ip.append((customer_count(inputs.customer_ips, IP), ["ip_address"]))
    if wanted & {"merchant_collusion", "account_takeover", "abnormal_spending"}:
        by_customer.append((customer_baseline(txns), ["customer_id"]))
    if "geo_anomaly" in wanted:
        by_customer.append((inputs.homes, ["customer_id"]))
    for column, lookups in (("device_id", by_device), ("ip_address", by_ip), ("customer_id", by_customer)):
        if column in also:
            lookups.append((also[column], [column]))
    df = attach(df, keys("device_id"), by_device)
    df = attach(df, keys("ip_address"), by_ip)
    df = attach(df, keys(), by_customer)
    by_merchant = []
    if "merchant_collusion" in wanted:
        shops = inputs.merchants.select("merchant_id", F.col("merchant_risk_score").alias("_shop_risk"))
        by_merchant.append((deduplicate(shops, "merchant_id"), ["merchant_id"]))
    if "coordinated_network" in wanted:
        # Merchant lookups ride along on (merchant, window), which splits a popular merchant by time.
        windows = _merchant_windows(txns, cfg)
        for lookup, on in by_merchant:
            windows = windows.join(splittable(lookup), on, "left")
        by_merchant = [(windows, ["merchant_id", "_window"])]
        df = df.withColumn("_window", _clock_window(cfg))
    df = attach(df, None, by_merchant)

    amount = F.col("amount")
    risk = [F.col("merchant_risk_score")] if "merchant_risk_score" in txns.columns else []
    new_now = lambda: F.col("_known").isNull() & (F.col("_first_id") == F.col("transaction_id"))
    conditions = {
        "new_device_fraud": new_now,
        "velocity_attack": lambda: F.col("velocity_attack"),
        "impossible_travel": lambda: F.col("impossible_travel"),
        "unusual_hours": lambda: F.hour("timestamp").isin(*cfg.night_hours) & (amount > cfg.night_amount),
        "merchant_collusion": lambda: (F.coalesce(F.col("_shop_risk"), *risk) > cfg.merchant_risk)
        & (amount > F.col("_mean") * cfg.merchant_amount_factor),
        "account_takeover": lambda: new_now() & (amount > F.col("_mean") * cfg.takeover_amount_factor),
        "device_sharing": lambda: F.col("device_customer_count") > cfg.device_customers,
        "ip_sharing": lambda: F.col("ip_customer_count") > cfg.ip_customers,
        "abnormal_spending": lambda: F.when(
            F.col("_std") > 0, (amount - F.col("_mean")) / F.col("_std") > cfg.deviations
        ),
        "repeated_failures": lambda: F.col("repeated_failures"),
        "card_not_present": lambda: (F.col("payment_method") == cfg.online_method)
        & F.col("merchant_category").isin(*cfg.online_categories),
        "geo_anomaly": lambda: haversine_km(
            F.col("home_latitude"), F.col("home_longitude"), F.col("latitude"), F.col("longitude")
        )
        > cfg.home_distance_km,
        "coordinated_network": lambda: F.col("coordinated_network"),
    }
    flags = [(flag(conditions[r]()) if r in wanted else F.lit(False)).alias(r) for r in asked]
    extra = [c for column, table in also.items() for c in table.columns if c != column]
    if "impossible_travel" in wanted:
        extra.append("_has_previous")
    return df.select(*txns.columns, *flags, *extra)


def first_match(config: RuleConfig = DEFAULT_CONFIG, *, legacy: bool = False) -> Column:
    """Name of the first rule that fires, over flagged transactions.

    ``legacy`` follows an if/else chain in which an enabled burst or distance rule ends the search
    even without a hit, so that later rules are never reached. The default looks at every rule.
    """
    named = lambda r: F.when(F.col(r), F.lit(r))
    active = [r for r in RULES if r in config.enabled]
    if not legacy:
        return F.coalesce(*[named(r) for r in active]) if active else F.lit(None).cast("string")
    ends_search = {
        "velocity_attack": F.lit(True),
        "repeated_failures": F.lit(True),
        "geo_anomaly": F.lit(True),
        "impossible_travel": F.col("_has_previous"),
    }
    chain = None
    for rule in (r for r in active if r != "coordinated_network"):
        reached = ends_search.get(rule, F.col(rule))
        chain = F.when(reached, named(rule)) if chain is None else chain.when(reached, named(rule))
    label = F.lit(None).cast("string") if chain is None else chain
    return F.coalesce(label, named("coordinated_network"))


def fraud_rule_flags(
    txns: DataFrame,
    inputs: RuleInputs,
    *,
    config: RuleConfig = DEFAULT_CONFIG,
    legacy: bool = False,
    policy: SkewPolicy = DEFAULT_POLICY,
    cuts: DataFrame | None = None,
) -> DataFrame:
    """All flags side by side plus ``first_match``."""
    flagged = rule_flags(txns, inputs, config=config, policy=policy, cuts=cuts)
    return flagged.withColumn("first_match", first_match(config, legacy=legacy)).drop("_has_previous")


def scenario_counts(flagged: DataFrame) -> DataFrame:
    """Per rule: transactions it fires on, and transactions it labels. One pass."""
    measures = {f"h_{r}": F.count_if(F.col(r)) for r in RULES}
    measures |= {f"l_{r}": F.count_if(F.col("first_match") == r) for r in RULES}
    rows = [
        F.struct(
            F.lit(r).alias("scenario"), F.col(f"h_{r}").alias("hit_count"), F.col(f"l_{r}").alias("labelled_count")
        )
        for r in RULES
    ]
    return flagged.agg(*[c.alias(n) for n, c in measures.items()]).select(F.inline(F.array(*rows)))


def rule_score() -> Column:
    """Noisy-or of the rules: one minus the chance that every fired rule is wrong."""
    spared = reduce(
        lambda product, rule: product * (1 - F.when(F.col(rule), F.lit(PROBABILITY[rule])).otherwise(F.lit(0.0))),
        RULES,
        F.lit(1.0),
    )
    return F.round(1 - spared, 6)
