"""Weighted risk, decision and reason codes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import at_most
from riskframe.operators.rules import RULES, rule_score


@dataclass(frozen=True)
class DecisionPolicy:
    """Weights, thresholds on the combined score, and thresholds of the reason codes.

    ``fraud_limits`` and ``credit_limits`` (review, block) optionally act on a single signal.
    """

    fraud: float = 0.45
    credit: float = 0.25
    device: float = 0.15
    ip: float = 0.10
    graph: float = 0.05
    block: float = 0.80
    review: float = 0.40
    credit_reason: float = 0.40
    device_reason: float = 0.40
    ip_reason: float = 0.50
    ring_reason: int = 3
    fraud_limits: tuple[float, float] | None = None
    credit_limits: tuple[float, float] | None = None


DEFAULT_DECISION = DecisionPolicy()
# Limits at which one signal decides alone.
SINGLE_SIGNAL = DecisionPolicy(fraud_limits=(0.40, 0.80), credit_limits=(0.40, 0.70))


def graph_risk(component_size: Column) -> Column:
    return at_most((component_size - 1) / F.lit(4.0), 1.0)


def risk_inputs(
    devices: DataFrame, ip_addresses: DataFrame, default_by_customer: DataFrame, components: DataFrame
) -> dict[str, DataFrame]:
    """The lookups a decision needs besides the rules, by key, for ``rule_flags(also=...)``.

    ``devices`` and ``ip_addresses`` are entity profiles, ``default_by_customer`` has (customer_id,
    credit_risk) and ``components`` (customer_id, component_size).
    """
    by_customer = components.select("customer_id", "component_size").join(
        default_by_customer.select("customer_id", "credit_risk"), "customer_id", "full"
    )
    return {
        "device_id": devices.select("device_id", "device_risk_score"),
        "ip_address": ip_addresses.select("ip_address", "ip_risk_score"),
        "customer_id": by_customer,
    }


def decide(flagged: DataFrame, policy: DecisionPolicy = DEFAULT_DECISION) -> DataFrame:
    """Decide on transactions with all rule flags and the columns of :func:`risk_inputs`; an
    unknown risk counts as 0 and an unknown component as a lone customer."""
    risks = ("credit_risk", "device_risk_score", "ip_risk_score")
    scored = flagged.withColumns(
        {
            "fraud_score": rule_score(),
            "component_size": F.coalesce(F.col("component_size"), F.lit(1).cast("bigint")),
            **{c: F.coalesce(F.col(c), F.lit(0.0)) for c in risks},
        }
    ).withColumn("graph_risk", graph_risk(F.col("component_size")))
    p = policy
    combined = (
        p.fraud * F.col("fraud_score")
        + p.credit * F.col("credit_risk")
        + p.device * F.col("device_risk_score")
        + p.ip * F.col("ip_risk_score")
        + p.graph * F.col("graph_risk")
    )
    blocked, review = F.col("risk_score") >= p.block, F.col("risk_score") >= p.review
    for signal, limits in (("fraud_score", p.fraud_limits), ("credit_risk", p.credit_limits)):
        if limits:
            review, blocked = review | (F.col(signal) >= limits[0]), blocked | (F.col(signal) >= limits[1])
    reasons = [F.when(F.col(rule), F.lit(rule)) for rule in RULES] + [
        F.when(F.col("credit_risk") >= p.credit_reason, F.lit("CREDIT_RISK")),
        F.when(F.col("device_risk_score") >= p.device_reason, F.lit("DEVICE_RISK")),
        F.when(F.col("ip_risk_score") >= p.ip_reason, F.lit("IP_RISK")),
        F.when(F.col("component_size") >= p.ring_reason, F.lit("RING")),
    ]
    codes = F.when(F.col("decision") == "APPROVE", F.array().cast("array<string>")).otherwise(
        F.array_compact(F.array(*reasons))
    )
    return (
        scored.withColumn("risk_score", F.round(combined, 6))
        .withColumn("decision", F.when(blocked, "BLOCK").when(review, "REVIEW").otherwise("APPROVE"))
        .select(
            "transaction_id",
            "customer_id",
            "fraud_score",
            "credit_risk",
            "device_risk_score",
            "ip_risk_score",
            "graph_risk",
            "risk_score",
            "decision",
            codes.alias("reason_codes"),
        )
    )
