from datetime import datetime, timedelta

import pytest
from conftest import rows_by

from riskframe.operators import clean
from riskframe.operators.behavior import behavioral_features, customer_amount_stats
from riskframe.operators.entity import (
    DEVICE,
    check_new_device,
    device_features,
    ip_features,
    point_in_time_new,
    refresh_stats,
    register_check_new_device,
    usage_map,
)
from riskframe.operators.quality import amount_checks
from riskframe.operators.velocity import transaction_velocity_view, velocity_features
from riskframe.plans.features import FRAUD_COLUMNS, credit_features, customer_features, fraud_features
from riskframe.sources.schemas import LOAD_ORDER, TABLES

DAY = datetime(2031, 3, 5)  # a Wednesday


def at(hour, minute=0, second=0, micro=0):
    return DAY.replace(hour=hour, minute=minute, second=second, microsecond=micro)


def txns(spark, rows):
    return spark.createDataFrame(rows, "transaction_id string, customer_id string, amount double, timestamp timestamp")


class TestVelocity:
    def test_windows_and_gap(self, spark):
        """Five payments of two customers: each sees its own past only."""
        steps = [("ann", 0, 2.25), ("ann", 40, 7.5), ("bob", 41, 9.0), ("ann", 95, 0.25), ("ann", 26 * 60, 1.0)]
        raw = txns(spark, [(f"p{i}", who, money, DAY + timedelta(minutes=m)) for i, (who, m, money) in enumerate(steps)])
        got = rows_by(velocity_features(clean.clean_transactions(raw)), "transaction_id")
        column = lambda name: [got[f"p{i}"][name] for i in range(5)]
        assert column("txns_last_1h") == [0, 1, 0, 1, 0]
        assert column("spend_last_1h") == [2.25, 9.75, 9.0, 7.75, 1.0]
        assert column("txns_last_24h") == [0, 1, 0, 2, 0]
        assert column("txns_last_7d") == [0, 1, 0, 2, 3]
        assert column("seconds_since_last_txn") == [999999, 2400, 999999, 3300, 87900]

    def test_window_bounds_ties_and_nulls(self, spark):
        raw = txns(
            spark,
            [
                ("A", "C1", 1.0, at(10)),
                ("B", "C1", 2.0, at(11)),  # exactly one hour later: A still counts
                ("C", "C1", 4.0, at(11)),  # tied with B
                ("D", "C1", None, at(11, 0, 1)),  # A has left, no amount of its own
                ("E", "C1", 8.0, None),  # no time: a group of its own
                ("F", "C2", None, at(11)),  # nothing to add up
            ],
        )
        got = rows_by(velocity_features(raw), "transaction_id")
        assert [got[t]["txns_last_1h"] for t in "ABCDEF"] == [0, 2, 2, 2, 0, 0]
        assert [got[t]["spend_last_1h"] for t in "ABCDEF"] == [1.0, 7.0, 7.0, 6.0, 8.0, 0.0]
        assert [got[t]["seconds_since_last_txn"] for t in "ABCDEF"] == [999999, 3600, 0, 1, 999999, 999999]

    def test_view_uses_exact_time(self, spark):
        raw = txns(spark, [("A", "C1", 1.0, at(10, 0, 0, 500_000)), ("B", "C1", 2.0, at(11, 0, 0, 600_000))])
        assert rows_by(velocity_features(raw), "transaction_id")["B"]["txns_last_1h"] == 1
        assert rows_by(transaction_velocity_view(raw), "transaction_id")["B"]["txns_last_1_hour"] == 0

    def test_other_windows(self, spark):
        raw = txns(spark, [(f"T{i}", "C1", 1.5, at(10, 0, 25 * i % 60 if i < 3 else 59)) for i in range(5)])
        out = velocity_features(raw, (("1m", 60), ("5m", 300)), gap=False)
        assert [c for c in out.columns if "last" in c] == ["txns_last_1m", "spend_last_1m", "txns_last_5m", "spend_last_5m"]
        assert rows_by(out, "transaction_id")["T4"]["txns_last_1m"] == 4

    def test_empty(self, spark):
        assert velocity_features(txns(spark, [])).count() == 0


class TestEntities:
    def test_new_device(self, spark):
        """A pair in the usage table is known; another customer's device, none, and an unlisted one are new."""
        rows = spark.createDataFrame(
            [("a", "ann", "phone-1"), ("b", "bob", "phone-1"), ("c", "bob", None), ("d", "ann", "unlisted"), ("e", "cid", "pos-7")],
            "transaction_id string, customer_id string, device_id string",
        )
        devices = spark.createDataFrame(
            [("phone-1", "tablet", "Linux", 40, 10), ("pos-7", "desktop", "macOS", 0, 0)],
            "device_id string, device_type string, operating_system string, transaction_count int, fraud_count int",
        )
        used = [("ann", "phone-1"), ("zoe", "phone-1"), *((f"u{i}", "pos-7") for i in range(4))]
        known = spark.createDataFrame(used, "customer_id string, device_id string")
        got = rows_by(device_features(rows, devices, known), "transaction_id")
        assert [got[t]["is_new_device"] for t in "abcde"] == [False, True, True, True, True]
        assert [got[t]["device_customer_count"] for t in "abcde"] == [2, 2, 1, 1, 4]
        assert [got[t]["device_risk_score"] for t in "abcde"] == [0.40, 0.40, 0.0, 0.0, 0.85]
        assert [got[t]["device_fraud_rate"] for t in "abcde"] == [0.25, 0.25, 0.0, 0.0, 0.0]

    def test_ip_tiers(self, spark):
        """Risk rises with the number of distinct customers on an address; repeated pairs count once."""
        crowd = {"fd00::1": 1, "fd00::2": 3, "fd00::3": 6}
        used = [(f"u{i}", ip) for ip, n in crowd.items() for i in range(n)] + [("u0", "fd00::2")]
        rows = spark.createDataFrame(
            [(ip, "u0", ip) for ip in crowd] + [("other", "u5", "fd00::2")], "transaction_id string, customer_id string, ip_address string"
        )
        ips = spark.createDataFrame(
            [(ip, 8, n, n) for ip, n in crowd.items()], "ip_address string, transaction_count int, fraud_count int, customer_count int"
        )
        known = spark.createDataFrame(used, "customer_id string, ip_address string")
        out = ip_features(rows, ips, known)
        got = rows_by(out, "transaction_id")
        assert out.count() == 4
        assert {t: got[t]["is_new_ip"] for t in got} == {"fd00::1": False, "fd00::2": False, "fd00::3": False, "other": True}
        assert [got[t]["ip_risk_score"] for t in crowd] == [0.05, 0.50, 0.90]
        assert [got[t]["ip_fraud_rate"] for t in crowd] == [0.125, 0.375, 0.75]

    def test_lookup_as_table_function(self, spark):
        """The SQL function and the join give the same answer for every request."""
        known = spark.createDataFrame(
            [("ann", "watch", at(5), at(6), 12), ("bob", "watch", at(7), at(7), 1)],
            "customer_id string, device_id string, first_used timestamp, last_used timestamp, use_count int",
        )
        requests = [("ann", "watch"), ("bob", "watch"), ("cid", "watch"), ("ann", "radio")]
        asked = spark.createDataFrame(requests, "customer_id string, device_id string")
        joined = {(r["customer_id"], r["device_id"]): r for r in check_new_device(asked, known).collect()}
        assert [joined[r]["previous_use_count"] for r in requests] == [12, 1, 0, 0]
        known.createOrReplaceTempView("known_devices")
        register_check_new_device(spark, "known_devices")
        for who, what in requests:
            row = spark.sql(f"SELECT * FROM check_new_device('{who}', '{what}')").first()
            same = joined[who, what]
            for name in ("is_new_device", "previous_use_count", "first_used_timestamp"):
                assert row[name] == same[name]

    def test_first_use(self, spark):
        rows = spark.createDataFrame(
            [
                ("T1", "C1", "D1", at(10)),
                ("T3", "C1", "D2", at(11)),
                ("T2", "C1", "D2", at(11)),
                ("T4", "C1", "D2", at(12)),
                ("T5", "C1", None, at(12)),
            ],
            "transaction_id string, customer_id string, device_id string, timestamp timestamp",
        )
        known = spark.createDataFrame([("C1", "D1")], "customer_id string, device_id string")
        got = rows_by(point_in_time_new(rows, known, DEVICE), "transaction_id")
        assert [got[f"T{i}"]["is_first_use"] for i in range(1, 6)] == [True, True, False, False, False]
        assert [got[f"T{i}"]["is_new_now"] for i in range(1, 6)] == [False, True, False, False, False]

    def test_usage(self, spark):
        rows = spark.createDataFrame(
            [("C1", "D1", at(10), True), ("C1", "D1", at(12), False), ("C2", "D1", at(11), None), ("C2", None, at(11), True)],
            "customer_id string, device_id string, timestamp timestamp, is_fraud boolean",
        )
        stats = refresh_stats(rows, DEVICE).first()
        assert (stats["transaction_count"], stats["fraud_count"], stats["customer_count"]) == (3, 1, 2)
        pairs = rows_by(usage_map(rows, DEVICE), "customer_id")
        assert (pairs["C1"]["first_used"], pairs["C1"]["last_used"], pairs["C1"]["use_count"]) == (at(10), at(12), 2)


class TestBehavior:
    def inputs(self, spark, rows):
        t = spark.createDataFrame(
            rows, "transaction_id string, customer_id string, amount double, timestamp timestamp, merchant_id string, city string"
        )
        c = spark.createDataFrame(
            [("ann", 61, 8200.5, 555, "high", "Oslo"), ("bob", 19, 0.0, 810, "low", None)],
            "customer_id string, age int, income double, credit_score int, risk_profile string, city string",
        )
        m = spark.createDataFrame(
            [("kiosk", "Corner", 0.3)] * 3, "merchant_id string, merchant_name string, merchant_risk_score double"
        )
        return t, c, m

    def test_clock_city_and_defaults(self, spark):
        """Every hour of one day: marked hours, and what unknown cities, customers and merchants give."""
        rows = [(f"h{h:02d}", "ann", 10.0 + h, at(h), "kiosk", "Oslo" if h % 2 else "Bergen") for h in range(24)]
        rows += [("nowhere", "ann", 21.5, at(12), "gone", None), ("bob", "bob", 3.0, at(12), "kiosk", "Oslo"), ("lost", "nobody", 5.0, None, None, "Oslo")]
        out = behavioral_features(*self.inputs(spark, rows))
        got = rows_by(out, "transaction_id")
        assert out.count() == len(rows), "a repeated merchant must not multiply rows"
        assert [h for h in range(24) if got[f"h{h:02d}"]["is_unusual_hour"]] == [2, 3, 4]
        assert [h for h in range(24) if not got[f"h{h:02d}"]["is_off_peak"]] == list(range(7, 22))
        assert [got[f"h{h:02d}"]["is_different_city"] for h in (0, 1)] == [True, False]
        assert not any(got[t]["is_different_city"] for t in ("nowhere", "bob", "lost"))
        assert [got[t]["merchant_risk_score"] for t in ("h00", "nowhere", "lost")] == [0.3, 0.1, 0.1]
        assert got["lost"]["cust_std_amount"] == 1.0 and got["lost"]["amount_z_score"] == 0.0
        assert (got["h05"]["txn_hour"], got["h05"]["txn_day_of_week"], got["h05"]["is_weekend"]) == (5, 4, False)

    def test_constant_amounts(self, spark):
        rows = [(f"k{i}", "bob", 0.75, at(i), "kiosk", None) for i in range(4)]
        got = rows_by(behavioral_features(*self.inputs(spark, rows)), "transaction_id")
        assert {(r["cust_std_amount"], r["amount_z_score"], r["amount_vs_cust_avg"]) for r in got.values()} == {(0.0, 0.0, 1.0)}

    def test_stats_ignore_missing_amounts(self, spark):
        out = customer_amount_stats(txns(spark, [("A", "C1", None, at(1)), ("B", "C1", 3.0, at(2)), ("C", "C1", 5.5, at(3))]))
        row = out.first()
        assert (row["cust_avg_amount"], row["cust_max_amount"], row["cust_total_txns"]) == (4.25, 5.5, 3)


class TestDatasets:
    def empty(self, spark):
        return {n: spark.createDataFrame([], t.schema) for n, t in TABLES.items()}

    def test_fraud_features_of_nothing(self, spark):
        t = self.empty(spark)
        out = fraud_features(
            clean.clean_transactions(t["transactions"]),
            t["devices"],
            t["customer_devices"],
            t["ip_addresses"],
            t["customer_ips"],
            t["customers"],
            t["merchants"],
        )
        assert len(FRAUD_COLUMNS) == 56 and out.columns == list(FRAUD_COLUMNS) and out.count() == 0

    def test_credit_and_customer(self, spark):
        t = self.empty(spark)
        customers = spark.createDataFrame(
            [("C1", 30, "F", 12000.0, "employed", "X", "Y", None, 560, "high"), ("C2", 40, "M", 1.0, "retired", "X", "Y", None, 800, "low")],
            TABLES["customers"].schema,
        )
        loans = spark.createDataFrame(
            [
                ("L1", "C1", 1200.0, 5.0, 12, 1000.0, 0.1, "employed", 0, "active", False, None),
                ("L2", "C2", 1200.0, 5.0, 0, 1000.0, 0.1, "retired", 3, "active", False, None),
                ("L3", "C2", 1200.0, 5.0, 12, 0.0, 0.1, "retired", 1, "active", False, None),
                ("L4", "C7", 1200.0, 5.0, 12, 100.0, 0.1, "retired", None, "active", False, None),
            ],
            TABLES["loans"].schema,
        )
        paid = t["transactions"].unionByName(
            txns(spark, [("T1", "C7", 10.0, at(3))]).withColumn("is_fraud", clean.F.lit(True)), allowMissingColumns=True
        )
        out = credit_features(loans, customers, paid)
        got = rows_by(out, "loan_id")
        assert len(out.columns) == 26
        assert got["L1"]["installment_to_income"] == pytest.approx(0.1) and got["L1"]["delinquency_risk_flag"] is True
        assert got["L2"]["installment_to_income"] is None and got["L2"]["delinquency_risk_flag"] is True
        assert got["L3"]["installment_to_income"] == 0.0 and got["L3"]["delinquency_risk_flag"] is False
        assert got["L4"]["hist_total_txns"] == 1 and got["L4"]["hist_fraud_count"] == 1 and got["L4"]["age"] is None
        profile = customer_features(customers, paid)
        row = rows_by(profile, "customer_id")["C1"]
        assert len(profile.columns) == 14
        assert (row["hist_total_txns"], row["hist_total_spend"], row["hist_avg_txn_amount"]) == (0, 0.0, None)


class TestCleaning:
    def test_text_input_and_duplicates(self, spark):
        raw = spark.createDataFrame(
            [("T1", "12.50", "2024-01-01T10:00:00.250000", "true"), ("T1", "99", "2023-01-01T00:00:00", "false"), ("T2", "oops", "never", None)],
            "transaction_id string, amount string, timestamp string, is_fraud string",
        )
        out = clean.clean_transactions(raw)
        got = rows_by(out, "transaction_id")
        assert out.count() == 2
        assert (got["T1"]["amount"], got["T1"]["is_fraud"]) == (12.5, True), "the latest row survives"
        assert got["T1"]["timestamp_sec"] == 1704103200
        assert got["T2"]["amount"] is None and got["T2"]["timestamp"] is None

    def test_numbers_that_are_not_finite(self, spark):
        """One such amount must neither stop a job nor spoil the sums of its customer."""
        texts = ["NaN", "Infinity", "-Infinity", "1e400", "abc", None, "5.005", "5.005", "7"]
        raw = spark.createDataFrame(
            [(f"n{i}", "ann", t, f"2031-03-05T0{i}:00:00") for i, t in enumerate(texts)],
            "transaction_id string, customer_id string, amount string, timestamp string",
        )
        out = clean.clean_transactions(raw)
        got = rows_by(out, "transaction_id")
        assert [got[f"n{i}"]["amount"] for i in range(9)] == [None] * 6 + [5.005, 5.005, 7.0]
        assert rows_by(velocity_features(out), "transaction_id")["n8"]["spend_last_24h"] == 17.02
        spoilt = raw.withColumn("amount", clean.F.col("amount").try_cast("double")).withColumn("timestamp", clean.F.col("timestamp").cast("timestamp"))
        assert rows_by(velocity_features(spoilt), "transaction_id")["n8"]["spend_last_24h"] == 17.02
        counted = {r["check"]: r["violations"] for r in amount_checks({"transactions": raw}).collect()}
        assert counted == {"unreadable_txn_amounts": 1, "non_finite_txn_amounts": 4, "over_precise_txn_amounts": 2}
        finer = {r["check"]: r["violations"] for r in amount_checks({"transactions": raw}, scale=3).collect()}
        assert finer["over_precise_txn_amounts"] == 0

    def test_survivor_is_independent_of_row_order(self, spark):
        rows = [("T1", float(i % 7), f"c{i % 5}") for i in range(40)]
        schema = "transaction_id string, amount double, city string"
        one = clean.clean_transactions(spark.createDataFrame(rows, schema)).first()
        two = clean.clean_transactions(spark.createDataFrame(rows[::-1], schema).repartition(4)).first()
        assert one == two

    def test_other_tables(self, spark):
        c = spark.createDataFrame([("C1", "30", "5", "700"), ("C1", "30", "5", "700")], "customer_id string, age string, income string, credit_score string")
        assert clean.clean_customers(c).dtypes[1:] == [("age", "int"), ("income", "double"), ("credit_score", "int")]
        assert clean.clean_customers(c).count() == 1

    def test_missing_key_fails_early(self, spark):
        with pytest.raises(ValueError):
            clean.clean_loans(spark.createDataFrame([(1,)], "x int"))

    def test_load_order_respects_references(self):
        for name in LOAD_ORDER:
            for _, parent in TABLES[name].references:
                assert LOAD_ORDER.index(parent) < LOAD_ORDER.index(name)
