"""Credit scoring of loans: instalment, burden, probability of default, expected loss."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import at_least, clip
from riskframe.operators.skew import splittable


@dataclass(frozen=True)
class Scorecard:
    """Fixed values of the default scorecard. Bands are read top down, first match wins."""

    base: float = 0.08
    score_below: tuple[tuple[int, float], ...] = ((500, 4.0), (580, 2.5), (670, 1.5))
    score_good: tuple[int, float] = (750, 0.4)
    dti_above: tuple[tuple[float, float], ...] = ((0.5, 3.0), (0.35, 1.8))
    dti_low: tuple[float, float] = (0.15, 0.6)
    employment: tuple[tuple[str, float], ...] = (
        ("unemployed", 3.5),
        ("student", 2.0),
        ("self-employed", 1.4),
        ("employed", 1.0),
        ("retired", 0.8),
    )
    per_delinquency: float = 0.5
    floor: float = 0.005
    ceiling: float = 0.90
    loss_given_default: float = 0.45


DEFAULT_SCORECARD = Scorecard()


def risk_tier(credit_score: Column) -> Column:
    return F.when(credit_score >= 720, "low").when(credit_score >= 600, "medium").otherwise("high")


def instalment(principal: Column, yearly_percent: Column, months: Column) -> Column:
    """Equal monthly payment; principal / months without interest; null without a term."""
    rate = yearly_percent / F.lit(12.0) / F.lit(100.0)
    growth = F.pow(1 + rate, months)
    return F.when(rate == 0, F.try_divide(principal, months)).otherwise(
        F.try_divide(principal * rate * growth, growth - 1)
    )


def _bands(cases: Sequence[tuple[Column, float]]) -> Column:
    expression = None
    for condition, factor in cases:
        expression = F.when(condition, F.lit(factor)) if expression is None else expression.when(condition, F.lit(factor))
    return expression.otherwise(F.lit(1.0))


def default_probability(
    credit_score: Column,
    dti: Column,
    employment: Column,
    delinquencies: Column,
    card: Scorecard = DEFAULT_SCORECARD,
) -> Column:
    score = _bands(
        [(credit_score < limit, f) for limit, f in card.score_below] + [(credit_score >= card.score_good[0], card.score_good[1])]
    )
    burden = _bands([(dti > limit, f) for limit, f in card.dti_above] + [(dti < card.dti_low[0], card.dti_low[1])])
    work = _bands([(employment == name, f) for name, f in card.employment])
    history = 1 + F.coalesce(delinquencies, F.lit(0)) * F.lit(card.per_delinquency)
    return clip(F.lit(card.base) * score * burden * work * history, card.floor, card.ceiling)


def loan_emi_dti(loans: DataFrame, customers: DataFrame) -> DataFrame:
    """Instalment and its share of monthly income, the latter derived from the yearly income."""
    joined = loans.select("loan_id", "customer_id", "loan_amount", "interest_rate", "tenure_months").join(
        splittable(customers.select("customer_id", "income")), "customer_id", "left"
    )
    monthly = F.round(F.col("income") / 12, 2)
    emi = instalment(F.col("loan_amount"), F.col("interest_rate"), F.col("tenure_months"))
    return joined.select(
        "loan_id",
        "customer_id",
        emi.alias("emi"),
        monthly.alias("monthly_income"),
        F.round(emi / at_least(monthly, 1.0), 4).alias("debt_to_income"),
    )


def default_scores(loans: DataFrame, customers: DataFrame, card: Scorecard = DEFAULT_SCORECARD) -> DataFrame:
    """Loans with ``default_probability`` from the customer's score and the loan's own burden,
    employment and delinquencies."""
    probability = default_probability(
        F.col("credit_score"), F.col("debt_to_income"), F.col("employment_status"), F.col("delinquency_history"), card
    )
    joined = loans.join(splittable(customers.select("customer_id", "credit_score")), "customer_id", "left")
    return joined.select(*loans.columns, probability.alias("default_probability"))


def expected_loss(scored: DataFrame, card: Scorecard = DEFAULT_SCORECARD) -> DataFrame:
    """Probability x loss given default x exposure; a paid-off loan has no exposure."""
    exposure = F.when(F.col("loan_status") == "paid_off", F.lit(0.0)).otherwise(F.col("loan_amount"))
    loss = F.col("default_probability") * F.lit(card.loss_given_default) * exposure
    return scored.withColumns(
        {
            "exposure_at_default": exposure,
            "expected_loss": F.round(loss.cast("decimal(28,8)"), 2).cast("double"),
        }
    )
