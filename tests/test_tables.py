"""Sources, sinks, views, quality checks."""

from datetime import date, datetime

import pytest
from conftest import rows_by

from riskframe.operators import quality
from riskframe.plans.views import register_views
from riskframe.session import shared_dir, work_path
from riskframe.sources import tables
from riskframe.sources.snapshots import Snapshots
from riskframe.sources.schemas import TABLES


@pytest.fixture()
def bank(spark):
    empty = {n: spark.createDataFrame([], t.schema) for n, t in TABLES.items()}
    customers = [("C1", 30, "F", 5.0, "employed", "X", "Y", date(2020, 1, 1), 200, "high"), ("C2", 30, "F", 5.0, "employed", "X", "Y", None, 700, "low")]
    when = datetime(2024, 1, 1)
    txn = lambda i, c, d, a, t=when: (i, c, "A1", "M1", d, None, a, t, None, None, None, None, None, None, None, None, True, None)
    transactions = [txn("T1", "C1", "D1", 5.0), txn("T1", "C1", "D1", -5.0), txn("T2", "C9", "D9", None, None), txn(None, None, None, 1.0)]
    return {
        **empty,
        "customers": spark.createDataFrame(customers, TABLES["customers"].schema),
        "transactions": spark.createDataFrame(transactions, TABLES["transactions"].schema),
        "devices": spark.createDataFrame([("D1", "mobile", "iOS", when, when, 8, 1)], TABLES["devices"].schema),
    }


def counts(df):
    return {r["check"]: r["violations"] for r in df.collect()}


def test_checks(bank):
    orphans = counts(quality.orphan_checks(bank))
    assert orphans == {
        "orphaned_accounts_customer": 0,
        "orphaned_txns_customer": 1,
        "orphaned_txns_account": 4,
        "orphaned_txns_merchant": 4,
        "orphaned_txns_device": 1,
        "orphaned_loans_customer": 0,
        "orphaned_customer_devices": 0,
    }
    assert counts(quality.null_checks(bank)) == {
        "null_customer_ids": 0,
        "null_transaction_ids": 1,
        "null_transaction_amounts": 1,
        "null_transaction_timestamps": 1,
        "null_device_ids": 1,
        "null_ip_addresses": 4,
    }
    assert counts(quality.range_checks(bank)) == {
        "invalid_credit_scores": 1,
        "negative_txn_amounts": 1,
        "invalid_merchant_risk": 0,
        "negative_loan_amounts": 0,
    }
    assert counts(quality.duplicate_checks(bank))["duplicate_transactions"] == 1
    report = quality.quality_report(bank)
    assert report.count() == 22 and quality.all_passed(report).first()["passed"] is False
    assert rows_by(quality.table_row_counts(bank), "table_name")["transactions"]["row_count"] == 4


def test_views_answer_sql(spark, bank):
    assert len(register_views(bank)) == 8
    row = spark.sql("select * from v_customer_features where customer_id = 'C2'").first()
    assert (row["total_transactions"], row["total_spend"], row["customer_fraud_rate"]) == (0, 0.0, 0.0)
    row = spark.sql("select * from v_customer_transaction_summary where customer_id = 'C2'").first()
    assert row["total_spend"] is None and row["fraud_transaction_count"] == 0
    assert [r[0] for r in spark.sql("select customer_id from v_high_risk_customers").collect()] == ["C1"]
    row = spark.sql("select * from v_device_intelligence").first()
    assert (row["shared_customer_count"], row["device_fraud_rate"], row["device_risk_score"]) == (0, 0.125, 0.05)
    risks = spark.sql("select distinct device_risk_score, ip_risk_score, is_new_device from v_new_device_detection").collect()
    assert [tuple(r) for r in risks] == [(0.05, 0.05, True)]
    assert spark.sql("select device_age_days from v_device_risk").first()[0] > 0


def test_load_all(spark, bank, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    bank["customers"].selectExpr("* except (customer_since)", "cast(customer_since as string) customer_since").write.parquet(f"{source}/customers.parquet")
    spark.createDataFrame([("1", "C1", "D1", "2024-01-01 00:00:00", "2024-02-01T10:00:00", "3")], "id string, customer_id string, device_id string, first_used string, last_used string, use_count string").write.csv(f"{source}/customer_devices.csv", header=True)
    bank["loans"].write.parquet(f"{source}/loans.parquet")
    written = tables.load_all(spark, source, tables.files_sink(target))
    assert written == {**{n: 0 for n in TABLES}, "customers": 2, "customer_devices": 1}
    loaded = spark.read.parquet(f"{target}/customers.parquet")
    assert dict(loaded.dtypes)["customer_since"] == "date"
    pair = spark.read.parquet(f"{target}/customer_devices.parquet")
    assert "id" not in pair.columns and pair.first()["last_used"] == datetime(2024, 2, 1, 10)
    tables.load_all(spark, source, tables.files_sink(target), truncate_first=False)
    assert spark.read.parquet(f"{target}/customers.parquet").count() == 4
    tables.load_all(spark, source, tables.files_sink(target))
    assert spark.read.parquet(f"{target}/customers.parquet").count() == 2


def test_load_version(spark, bank, tmp_path):
    source = str(tmp_path / "in")
    bank["customers"].write.parquet(f"{source}/customers.parquet")
    bank["devices"].write.parquet(f"{source}/devices.parquet")
    store = Snapshots(spark, str(tmp_path / "store"))
    for batch in ("monday", "monday"):  # a retry adds nothing
        version = tables.load_version(spark, source, store, batch)
    assert version.number == 1 and set(version.tables) == {"customers", "devices"}
    assert store.read("customers").count() == bank["customers"].count()
    bank["loans"].limit(0).write.parquet(f"{source}/loans.parquet")
    assert tables.load_version(spark, source, store, "tuesday").number == 2
    assert store.read("loans").count() == 0 and store.read("devices").count() == bank["devices"].count()


def test_read_all_and_typed(spark, bank, tmp_path):
    spark.createDataFrame([("D1", "mobile", "iOS", "2024-01-01", "2024-01-01", "8", "x")], TABLES["devices"].columns).write.csv(f"{tmp_path}/devices.csv", header=True)
    found = tables.read_all(spark, str(tmp_path))
    assert set(found) == set(TABLES) and found["loans"].isEmpty()
    row = tables.typed("devices", found["devices"]).first()
    assert (row["transaction_count"], row["fraud_count"]) == (8, None)
    with pytest.raises(ValueError):
        tables.typed("devices", found["devices"].drop("device_type"))


def test_formats_and_counts(bank, tmp_path, spark):
    tables.files_sink(str(tmp_path), ("parquet", "csv"))("customers", bank["customers"], "overwrite")
    assert spark.read.csv(f"{tmp_path}/customers.csv", header=True).count() == 2
    assert tables.write_datasets({"a": bank["customers"], "b": bank["loans"]}, str(tmp_path)) == {"a": 2, "b": 0}


class FakeSession:
    """Just what the folder lookup reads."""

    def __init__(self, setting, master):
        self.conf, self.sparkContext = self, self
        self.setting, self.master, self.applicationId = setting, master, "app-1"

    def get(self, _, default):
        return self.setting or default


def test_shared_folder_follows_the_cluster_setting():
    assert shared_dir(FakeSession("hdfs:///shared", "yarn")) == "hdfs:///shared"
    assert work_path(FakeSession("hdfs:///shared/", "yarn"), "x").startswith("hdfs:///shared/x-")
    with pytest.raises(RuntimeError):
        shared_dir(FakeSession(None, "yarn"))
    local = FakeSession(None, "local[4]")
    assert shared_dir(local) == shared_dir(local) != ""
