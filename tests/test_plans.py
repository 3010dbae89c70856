"""What the plans must look like when no table is small enough to broadcast."""

import pytest
from pyspark.sql import functions as F

from riskframe.operators import clean
from riskframe.operators.entity import device_features
from riskframe.operators.rules import RuleInputs, rule_flags
from riskframe.operators.velocity import velocity_features
from riskframe.plans.catalog import Bank
from riskframe.plans.features import credit_features, fraud_features
from riskframe.session import configure
from riskframe.sources.schemas import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stored")
    bank = Bank(spark, SF)
    tables = {}
    for name, df in {**bank.tables, "homes": bank.rule_inputs.homes}.items():
        df.write.parquet(f"{folder}/{name}")
        tables[name] = spark.read.parquet(f"{folder}/{name}")
    return tables


@pytest.fixture()
def large(spark):
    """As if every table were large: no size-based broadcast, static plan."""
    configure(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def node(plan):
    return plan.nodeName()


def children(plan):
    nodes = plan.children()
    return [nodes.apply(i) for i in range(nodes.size())]


def main_path(df):
    """Operators from the result down the row-carrying side: left of joins, first of unions."""
    plan = df._jdf.queryExecution().executedPlan()
    path = []
    while True:
        path.append(node(plan))
        below = children(plan)
        if not below:
            return path
        plan = below[0]


def everything(df):
    stack, names = [df._jdf.queryExecution().executedPlan()], []
    while stack:
        plan = stack.pop()
        names.append(node(plan))
        stack.extend(children(plan))
    return names


def features(t):
    return fraud_features(
        t["transactions"], t["devices"], t["customer_devices"], t["ip_addresses"], t["customer_ips"], t["customers"], t["merchants"]
    )


def test_velocity_is_one_shuffle_one_sort_one_window(stored, large):
    path = main_path(velocity_features(stored["transactions"]))
    assert path.count("Exchange") == 1 and path.count("Sort") == 1 and path.count("Window") == 1


def test_wide_rows_move_twice_in_fraud_features(stored, large):
    """Once to (owner, slice) for velocity and all customer-bound lookups, once for the merchant."""
    path = main_path(features(stored))
    assert path.count("SortMergeJoin") == 4
    assert path.count("Exchange") == 2


def test_wide_rows_of_rules(stored, large):
    inputs = RuleInputs(stored["customer_devices"], stored["customer_ips"], stored["merchants"], stored["homes"])
    path = main_path(rule_flags(stored["transactions"], inputs))
    assert path.count("Exchange") == 2, "(owner, slice), then (merchant, window)"


def test_device_features_move_wide_rows_once(stored, large):
    path = main_path(device_features(stored["transactions"], stored["devices"], stored["customer_devices"]))
    assert path.count("Exchange") == 1


def test_no_cartesian_products_and_no_python(stored, large):
    inputs = RuleInputs(stored["customer_devices"], stored["customer_ips"], stored["merchants"], stored["homes"])
    for df in (features(stored), rule_flags(stored["transactions"], inputs)):
        names = " ".join(everything(df))
        assert "Cartesian" not in names and "NestedLoop" not in names
        assert "Python" not in names and "Pandas" not in names


def test_scan_reads_only_what_is_needed(stored, large):
    slim = velocity_features(stored["transactions"].select("transaction_id", "customer_id", "amount", "timestamp"))
    text = slim.select("transaction_id", "txns_last_1h")._jdf.queryExecution().executedPlan().toString()
    assert "merchant_id" not in text and "ReadSchema" in text


def test_filters_on_columns_reach_the_scan(stored, large):
    text = clean.enforce_types(stored["transactions"], {"is_fraud": "boolean"}).filter("customer_id = 'C'")
    assert "EqualTo(customer_id,C)" in text._jdf.queryExecution().executedPlan().toString()


def test_duplicates_are_cut_before_the_shuffle(stored, large):
    path = main_path(clean.clean_transactions(stored["transactions"].select(*TABLES["transactions"].columns)))
    assert path.index("Exchange") < len(path) - 1 - path[::-1].index("WindowGroupLimit"), path


def popular(column, value):
    third = F.pmod(F.xxhash64("transaction_id"), F.lit(3)) == 0
    return F.when(third, F.lit(value)).otherwise(F.col(column))


def skewed_features(t):
    return features(t)


def skewed_devices(t):
    return device_features(t["transactions"], t["devices"], t["customer_devices"])


def skewed_rules(t):
    inputs = RuleInputs(t["customer_devices"], t["customer_ips"], t["merchants"], t["homes"])
    return rule_flags(t["transactions"], inputs, ["abnormal_spending", "merchant_collusion"])


def skewed_credit(t):
    return credit_features(t["loans"], clean.clean_customers(t["customers"]), t["transactions"])


@pytest.mark.parametrize("build", [skewed_features, skewed_devices, skewed_rules, skewed_credit])
def test_adaptive_execution_splits_a_popular_key(spark, stored, build):
    """A third of the rows at one merchant, one (customer, device) pair, one borrower: the join
    partition that holds them is cut into several tasks."""
    configure(spark)
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    kept = {key: spark.conf.get(key, None) for key in limits}
    for key, value in limits.items():
        spark.conf.set(key, value)
    try:
        columns = {"merchant_id": "MERCH000007"}
        if build is not skewed_features:
            columns |= {"customer_id": "CUST0000003", "device_id": "DEV0000009"}
        txns = stored["transactions"].repartition(8).withColumns({c: popular(c, v) for c, v in columns.items()})
        one = F.when(F.pmod(F.xxhash64("loan_id"), F.lit(3)) == 0, F.lit("CUST0000003")).otherwise(F.col("customer_id"))
        loans = stored["loans"].repartition(8).withColumn("customer_id", one)
        df = build({**stored, "transactions": txns, "loans": loans})
        assert len(df.collect()) == (loans if build is skewed_credit else txns).count()
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in kept.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
