"""Features as of the transaction against a scan of all earlier rows."""

import math
import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskframe.operators import as_of
from riskframe.operators.entity import DEVICE, IP
from riskframe.operators.skew import SkewPolicy

SCHEMA = "transaction_id string, customer_id string, device_id string, ip_address string, timestamp timestamp, amount double, is_fraud boolean, city string"
START = datetime(2024, 1, 1)


def sample(n=260, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        customer = rng.choice(["hot"] * 6 + ["a", "b", "c", "d", "e", None])
        device = rng.choice(["shared"] * 5 + ["d1", "d2", None])
        at = None if rng.random() < 0.05 else START + timedelta(seconds=rng.randrange(60), microseconds=rng.choice([0, 1]))
        amount = None if rng.random() < 0.1 else round(rng.uniform(1, 500), 2)
        rows.append((f"t{i}", customer, device, rng.choice(["i1", "i2", "i3", None]), at, amount, rng.choice([True, False, None]), "x"))
    return rows + [rows[3], rows[3]]


def tier(kind, n):
    return next((score for above, score in kind.tiers if n > above), kind.base_risk)


def brute(rows):
    out = []
    for row in rows:
        t, customer, device, ip, at, amount, *_ = row
        result = [t, customer, device, ip, at, amount]
        for kind, column in ((DEVICE, 2), (IP, 3)):
            past = [r for r in rows if row[column] is not None and at is not None and r[4] is not None and r[column] == row[column] and r[4] < at]
            customers = {r[1] for r in past} - {None}
            used = customer is not None and customer in customers
            rate = sum(bool(r[6]) for r in past) / len(past) if past else 0.0
            result += [len(customers), len(past), rate, tier(kind, len(customers)) if past else 0.0, not used]
        past = [r for r in rows if customer is not None and at is not None and r[4] is not None and r[1] == customer and r[4] < at]
        known = [r[5] for r in past if r[5] is not None]
        mean = sum(round(100 * x) for x in known) / 100 / len(known) if known else None  # exact money
        dev = math.sqrt(sum((x - mean) ** 2 for x in known) / (len(known) - 1)) if len(known) > 1 else 1.0
        ratio = 1.0 if not mean else None if amount is None else amount / mean
        z = 0.0 if mean is None or dev == 0 else None if amount is None else (amount - mean) / dev
        result += [len(past), mean, dev, max(known, default=None), ratio, z]
        out.append(tuple(round(x, 5) if isinstance(x, float) else x for x in result))
    return Counter(out)


def rows_of(df):
    return Counter(tuple(round(x, 5) if isinstance(x, float) else x for x in row) for row in df.collect())


@pytest.mark.parametrize("hot_rows", [1, 5, 10**9])
def test_equals_brute_force(spark, hot_rows):
    rows = sample()
    got = as_of.fraud_features_as_of(spark.createDataFrame(rows, SCHEMA), SkewPolicy(hot_rows=hot_rows))
    assert rows_of(got) == brute(rows)


def test_empty(spark):
    assert as_of.fraud_features_as_of(spark.createDataFrame([], SCHEMA)).count() == 0


def test_slices_are_bounded_by_rows(spark):
    """A dense minute and a sparse year of one key: slices of about ``hot_rows`` ticks, whatever the clock says."""
    dense = spark.range(30_000).select(F.lit("k").alias("key"), F.col("id").alias("at"))
    sparse = spark.range(3_000).select(F.lit("k").alias("key"), (F.col("id") * 10_000_000_000 + 10**6).alias("at"))
    small = spark.range(50).select(F.lit("s").alias("key"), F.col("id").alias("at"))
    ticks = dense.union(sparse).union(small)
    (found,) = as_of.row_borders(ticks, "key", "at", SkewPolicy(hot_rows=1000)).collect()
    borders = found["_borders"]
    assert found["_hot_key"] == "k" and borders == sorted(borders)
    slices = Counter(sum(b <= r["at"] for b in borders) for r in ticks.filter("key = 'k'").collect()) if len(borders) < 60 else {}
    assert 30 <= len(borders) <= 34 and max(slices.values()) <= 1200


def test_a_burst_within_one_instant_is_one_tick(spark):
    rows = [(f"t{i}", "c", "d", "i", START, 1.0, False, "x") for i in range(5000)]
    rows.append(("later", "c", "d", "i", START + timedelta(seconds=1), 2.0, False, "x"))
    df = spark.createDataFrame(rows, SCHEMA)
    ticks, _ = as_of._entity_ticks(df.withColumn("_at", F.unix_micros("timestamp")), DEVICE)
    assert ticks.count() == 2
    got = {r["transaction_id"]: r for r in as_of.fraud_features_as_of(df, SkewPolicy(hot_rows=1)).collect()}
    assert got["later"]["cust_txns_before"] == got["later"]["device_txns_before"] == 5000
    assert got["t7"]["cust_txns_before"] == 0 and got["t7"]["is_new_device_then"]
