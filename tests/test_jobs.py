"""The two mains, end to end on stored test tables."""

import pytest

from riskframe.jobs import build_features, load_tables
from riskframe.plans.catalog import Bank
from riskframe.plans.features import FRAUD_COLUMNS
from riskframe.sources.tables import files_sink


@pytest.fixture(scope="module")
def delivered(spark, tmp_path_factory):
    """The nine tables as files, transactions with repeated rows and text timestamps."""
    folder = str(tmp_path_factory.mktemp("delivered"))
    bank = Bank(spark, "/root/testdata/sf0.001")
    for name, df in {**bank.tables, "transactions": bank.transactions_raw}.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return folder, bank


def test_build_features(spark, delivered, tmp_path):
    folder, bank = delivered
    counts = build_features.run(spark, folder, str(tmp_path), by_day=True)
    assert counts == {
        "fraud_features": bank.transactions.count(),
        "credit_features": bank.loans.count(),
        "customer_features": bank.customers.count(),
    }
    stored = spark.read.parquet(f"{tmp_path}/fraud_features.parquet")
    assert set(stored.columns) == {*FRAUD_COLUMNS, "txn_date"}
    day = stored.filter("txn_date = date '2024-01-05'")
    assert "PartitionFilters: [isnotnull(txn_date" in day._jdf.queryExecution().executedPlan().toString()
    same = bank.fraud_features.select(*FRAUD_COLUMNS)
    columns = [c for c in FRAUD_COLUMNS if c not in ("cust_std_amount", "amount_z_score")]
    assert stored.select(columns).exceptAll(same.select(columns)).count() == 0


def test_csv_gives_what_parquet_gives(spark, delivered, tmp_path):
    folder, bank = delivered
    for name, df in {**bank.tables, "transactions": bank.transactions_raw}.items():
        df.write.csv(f"{tmp_path}/csv/{name}.csv", header=True)
    counts = build_features.run(spark, f"{tmp_path}/csv", f"{tmp_path}/from_csv")
    assert counts == build_features.run(spark, folder, f"{tmp_path}/from_parquet")
    for name in counts:
        one, two = (spark.read.parquet(f"{tmp_path}/{source}/{name}.parquet") for source in ("from_csv", "from_parquet"))
        assert one.dtypes == two.dtypes
        columns = [c for c, t in one.dtypes if t != "double"]
        assert one.select(columns).exceptAll(two.select(columns)).count() == 0


def test_load_tables(spark, delivered, tmp_path):
    folder, bank = delivered
    target = str(tmp_path)
    counts, report = load_tables.run(
        spark, folder, files_sink(target), lambda name: spark.read.parquet(f"{target}/{name}.parquet")
    )
    assert counts["transactions"] == bank.transactions_raw.count() and counts["accounts"] == bank.accounts.count()
    found = {r["check"]: r["violations"] for r in report.collect()}
    assert found["duplicate_transactions"] == counts["transactions"] - bank.transactions.count()
    assert spark.sql("select count(*) from v_new_device_detection").first()[0] == counts["transactions"]
