"""Percentiles by selection against sorted lists."""

import random

import pytest

from riskframe.operators.percentiles import SHARES, amount_percentiles

SCHEMA = "transaction_id string, customer_id string, amount double, p25 int"


def brute(values, share):
    values = sorted(values)
    place = share * (len(values) - 1)
    low = int(place)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (place - low)


def test_equals_sorted_lists(spark):
    rng = random.Random(3)
    amounts = [lambda: 5.0, lambda: round(rng.uniform(-900, 900), 2), lambda: round(rng.uniform(0, 4e9), 2), lambda: float(rng.choice([1, 2, 655.36, 655.35])), lambda: None]
    rows = [(f"t{i}", who, rng.choice(amounts)(), 0) for i, who in enumerate(rng.choices(["hot", "a", "b", None], [20, 2, 1, 2], k=900))]
    rows += [("x", "single", 7.77, 0), ("y", "none", None, 0), ("z", "bad", float("nan"), 0), rows[0], rows[0]]
    got = {r["customer_id"]: r for r in amount_percentiles(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    known = {}
    for _, who, amount, _ in rows:
        if amount is not None and amount == amount:
            known.setdefault(who, []).append(amount)
    assert got.keys() == known.keys() and "none" not in got and "bad" not in got
    for who, values in known.items():
        assert got[who]["amounts"] == len(values)
        for share in SHARES:
            assert got[who][f"p{100 * share:g}"] == pytest.approx(brute(values, share), abs=1e-4), (who, share)


def test_empty(spark):
    assert amount_percentiles(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_window_holds_a_customers_amounts(spark):
    """Windows run over bins: a customer with 200,000 different amounts never has more than 2^16 rows in one."""
    df = spark.range(200_000).selectExpr("concat('t', id) transaction_id", "'hot' customer_id", "(id * 7919 % 200000) * 1.0 amount", "0 p25")
    (row,) = amount_percentiles(df, [0.5, 1.0]).collect()
    assert (row["amounts"], row["p50"], row["p100"]) == (200_000, 99_999.5, 199_999.0)
