"""Rules, credit, decision, graph, volume, evaluation."""

import random
from datetime import date, datetime, timedelta

import pytest
from conftest import rows_by
from pyspark.sql import functions as F

from riskframe.operators import graph, loans, volume
from riskframe.operators.decision import DecisionPolicy, decide, risk_inputs
from riskframe.operators.evaluate import score_histogram, score_metrics
from riskframe.operators.models import split
from riskframe.operators.rules import RULES, RuleConfig, RuleInputs, first_match, fraud_rule_flags, rule_flags, rule_score, scenario_counts
from riskframe.functions.columns import clip, fingerprint, haversine_km, padded_id, rate4
from riskframe.plans.catalog import Bank
from riskframe.sources.schemas import TABLES
from riskframe.sources.testdata import RAW_SCHEMAS

NOON = datetime(2026, 8, 12, 12)


@pytest.fixture(scope="module")
def case(spark):
    """Thirteen customers' worth of trouble in a few rows."""

    def row(i, who, amount, when, device="D1", ip="I1", shop="M1", lat=0.0, lon=0.0, method="credit_card", kind="retail"):
        return (i, who, None, shop, device, ip, amount, when, None, kind, None, None, None, lat, lon, method, None, None)

    s = lambda x: NOON + timedelta(seconds=x)
    rows = [row(f"B{i}", "burst", 10.0, s(i * 10)) for i in range(6)]
    rows += [row("N1", "night", 6000.0, NOON.replace(hour=3)), row("N2", "night", 10.0, NOON.replace(hour=4))]
    rows += [row("V1", "travel", 10.0, s(0), lat=0.0), row("V2", "travel", 10.0, s(1800), lat=10.0), row("V3", "travel", 10.0, s(1800), lat=40.0)]
    rows += [row(f"S{i}", "spender", 10.0, s(i * 4000)) for i in range(30)]
    rows += [row("S99", "spender", 1000.0, s(10**6), device="NEW", shop="RISKY")]
    rows += [row(f"R{i}", f"ring{i}", 10.0, s(60 * i), shop="TARGET", device="SHARED", ip="POPULAR") for i in range(6)]
    rows += [row("O1", "online", 10.0, s(5), method="online", kind="gambling"), row("O2", "online", None, s(6000), device=None)]
    txns = spark.createDataFrame(rows, TABLES["transactions"].schema)
    pairs = [(w, "D1") for w in ("burst", "night")] + [(f"ring{i}", "SHARED") for i in range(6)]
    devices = spark.createDataFrame(pairs, "customer_id string, device_id string")
    ips = spark.createDataFrame([(f"ring{i}", "POPULAR") for i in range(6)], "customer_id string, ip_address string")
    shops = spark.createDataFrame([("RISKY", 0.9), ("M1", 0.1)], "merchant_id string, merchant_risk_score double")
    homes = spark.createDataFrame(
        [(w, 0.0, 0.0) for w in ("travel", "burst")], "customer_id string, home_latitude double, home_longitude double"
    )
    return txns, RuleInputs(devices, ips, shops, homes)


def fired(out, rule):
    return sorted(r["transaction_id"] for r in out.filter(F.col(rule)).collect())


class TestRules:
    def test_each_rule(self, case):
        out = fraud_rule_flags(*case).cache()
        assert fired(out, "velocity_attack") == ["B3", "B4", "B5"]
        assert fired(out, "repeated_failures") == ["B4", "B5"]
        assert fired(out, "unusual_hours") == ["N1"]
        assert fired(out, "impossible_travel") == ["V2"], "a gap of zero is no travel"
        assert fired(out, "geo_anomaly") == ["V3"]
        assert fired(out, "merchant_collusion") == ["S99"]
        assert fired(out, "account_takeover") == ["S99"]
        assert fired(out, "abnormal_spending") == ["S99"]
        assert fired(out, "device_sharing") == fired(out, "ip_sharing") == [f"R{i}" for i in range(6)]
        assert fired(out, "coordinated_network") == [f"R{i}" for i in range(6)]
        assert fired(out, "card_not_present") == ["O1"]
        assert fired(out, "new_device_fraud") == ["O1", "S0", "S99", "V1"], "first use, unknown device, no null"
        assert out.filter(F.greatest(*[F.col(r).isNull().cast("int") for r in RULES]) == 1).count() == 0
        labels = rows_by(out, "transaction_id")
        assert labels["S99"]["first_match"] == "new_device_fraud" and labels["R1"]["first_match"] == "device_sharing"
        counts = rows_by(scenario_counts(out), "scenario")
        assert counts["coordinated_network"]["hit_count"] == 6 and counts["coordinated_network"]["labelled_count"] == 0
        out.unpersist()

    def test_switches(self, case):
        config = RuleConfig(enabled=frozenset({"device_sharing", "coordinated_network"}))
        out = fraud_rule_flags(*case, config=config)
        assert fired(out, "velocity_attack") == [] and len(fired(out, "device_sharing")) == 6
        assert {r["first_match"] for r in out.collect()} == {None, "device_sharing"}

    def test_legacy_chain_never_reaches_later_rules(self, case):
        out = fraud_rule_flags(*case, legacy=True)
        assert {r["first_match"] for r in out.collect()} == {None, "new_device_fraud", "velocity_attack", "coordinated_network"}
        without_burst = RuleConfig(enabled=frozenset(RULES) - {"velocity_attack"})
        labels = rows_by(fraud_rule_flags(*case, config=without_burst, legacy=True), "transaction_id")
        assert labels["N1"]["first_match"] == "unusual_hours", "no earlier transaction, so the search goes on"
        assert labels["R3"]["first_match"] == "device_sharing" and labels["V2"]["first_match"] == "impossible_travel"

    def test_rows_without_time(self, spark, case):
        """They find their merchant's risk, but are no crowd."""
        _, inputs = case
        values = [(f"T{i}", f"C{i % 7}", "RISKY", 10.0 if i < 14 else 500.0, None) for i in range(15)]
        some = spark.createDataFrame(values, "transaction_id string, customer_id string, merchant_id string, amount double, timestamp timestamp")
        out = rule_flags(some, inputs, ["merchant_collusion", "coordinated_network"])
        assert fired(out, "merchant_collusion") == [] and fired(out, "coordinated_network") == []
        usual = some.unionByName(some.filter("transaction_id in ('T0', 'T7')").withColumn("transaction_id", F.concat("transaction_id", F.lit("x"))))
        out = rule_flags(usual, inputs, ["merchant_collusion", "coordinated_network"])
        assert fired(out, "merchant_collusion") == ["T14"] and fired(out, "coordinated_network") == []

    def test_only_needed_lookups_are_planned(self, case):
        plan = rule_flags(*case, only=["unusual_hours"])._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Window" not in plan

    def test_score(self, spark):
        df = spark.range(1).select(*[F.lit(r in ("new_device_fraud", "unusual_hours")).alias(r) for r in RULES])
        assert df.select(rule_score().alias("s")).first()["s"] == pytest.approx(1 - 0.82 * 0.65)
        nothing = spark.range(1).select(*[F.lit(False).alias(r) for r in RULES])
        assert nothing.select(rule_score().alias("s"), first_match().alias("f")).first()[:] == (0.0, None)


class TestColumns:
    def test_distance(self, spark):
        km = spark.range(1).select(haversine_km(F.lit(19.076), F.lit(72.8777), F.lit(28.7041), F.lit(77.1025)).alias("d")).first()["d"]
        assert km == pytest.approx(1153, abs=3)
        antipodes = spark.range(1).select(haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)).alias("d")).first()["d"]
        assert antipodes == pytest.approx(20015.09, abs=0.1)

    def test_ids(self, spark):
        row = spark.range(7, 8).select(padded_id("CUST", F.col("id"), 7).alias("i"), fingerprint(F.lit("x")).alias("f")).first()
        assert row["i"] == "CUST0000007" and len(row["f"]) == 40 and row["f"].startswith("2d711642b726b044")

    def test_unknown_stays_unknown(self, spark):
        nothing = F.lit(None).cast("double")
        row = spark.range(1).select(clip(nothing, 0.1, 0.9).alias("c"), haversine_km(nothing, F.lit(0.0), F.lit(1.0), F.lit(1.0)).alias("d"))
        assert row.first()[:] == (None, None)

    def test_rate_is_rounded_half_up(self, spark):
        cases = [(1, 3, 0.3333), (3, 20000, 0.0002), (1, 20000, 0.0001), (0, 0, 0.0), (2, 3, 0.6667)]
        df = spark.createDataFrame([c[:2] for c in cases], "f int, t int").select(rate4(F.col("f"), F.col("t")).alias("r"))
        assert [r["r"] for r in df.collect()] == [c[2] for c in cases]


class TestCredit:
    def test_instalment(self, spark):
        df = spark.createDataFrame([(1200.0, 0.0, 12), (1000.0, 12.0, 12), (1000.0, 5.0, 0), (1000.0, 0.0, 0)], "p double, r double, n int")
        got = [r[0] for r in df.select(loans.instalment(F.col("p"), F.col("r"), F.col("n"))).collect()]
        assert got[0] == 100.0 and got[1] == pytest.approx(88.8488, abs=1e-4) and got[2:] == [None, None]

    def test_scorecard(self, spark):
        df = spark.createDataFrame(
            [(800, 0.1, "retired", 0), (700, 0.2, "employed", 0), (499, 0.6, "unemployed", 5), (600, 0.4, "gardener", None)],
            "s int, d double, e string, n int",
        )
        got = [r[0] for r in df.select(loans.default_probability(F.col("s"), F.col("d"), F.col("e"), F.col("n"))).collect()]
        assert got == pytest.approx([0.08 * 0.4 * 0.6 * 0.8, 0.08, 0.9, 0.08 * 1.5 * 1.8])

    def test_expected_loss(self, spark):
        df = spark.createDataFrame([(0.1, 1000.0, "active"), (0.1, 1000.0, "paid_off")], "default_probability double, loan_amount double, loan_status string")
        assert [r["expected_loss"] for r in loans.expected_loss(df).collect()] == [45.0, 0.0]

    def test_tiers(self, spark):
        df = spark.createDataFrame([(720,), (719,), (600,), (599,)], "s int")
        assert [r[0] for r in df.select(loans.risk_tier(F.col("s"))).collect()] == ["low", "medium", "medium", "high"]


class TestDecision:
    def flagged(self, spark):
        rows = [("T1", "C1", 0.85, 0.9, 0.9, 9, True), ("T2", "C2", 0.05, 0.05, None, None, False), ("T3", "C3", 0.85, 0.05, None, None, True)]
        df = spark.createDataFrame(
            rows,
            "transaction_id string, customer_id string, device_risk_score double, ip_risk_score double, credit_risk double,"
            " component_size bigint, bad boolean",
        )
        return df.select("*", *[(F.col("bad") if r in ("velocity_attack", "impossible_travel") else F.lit(False)).alias(r) for r in RULES])

    def test_levels_and_reasons(self, spark):
        got = rows_by(decide(self.flagged(spark)), "transaction_id")
        assert [got[t]["decision"] for t in ("T1", "T2", "T3")] == ["BLOCK", "APPROVE", "REVIEW"]
        assert got["T1"]["reason_codes"] == ["velocity_attack", "impossible_travel", "CREDIT_RISK", "DEVICE_RISK", "IP_RISK", "RING"]
        assert got["T2"]["reason_codes"] == [] and got["T3"]["graph_risk"] == 0.0
        assert got["T1"]["risk_score"] == pytest.approx(0.45 * 0.955 + 0.25 * 0.9 + 0.15 * 0.85 + 0.1 * 0.9 + 0.05)

    def test_single_signal_limits(self, spark):
        got = rows_by(decide(self.flagged(spark), DecisionPolicy(fraud_limits=(0.4, 0.8))), "transaction_id")
        assert [got[t]["decision"] for t in ("T1", "T2", "T3")] == ["BLOCK", "APPROVE", "BLOCK"]

    def test_lookups_ride_on_the_rules(self, spark, case):
        txns, inputs = case
        parts = spark.createDataFrame([("burst", 4)], "customer_id string, component_size bigint")
        credit = spark.createDataFrame([("night", 0.5)], "customer_id string, credit_risk double")
        devices = spark.createDataFrame([("SHARED", 0.85)], "device_id string, device_risk_score double")
        ips = spark.createDataFrame([("POPULAR", 0.9)], "ip_address string, ip_risk_score double")
        flagged = rule_flags(txns, inputs, also=risk_inputs(devices, ips, credit, parts))
        got = rows_by(decide(flagged), "transaction_id")
        assert len(got) == txns.count()
        assert (got["B0"]["graph_risk"], got["N1"]["credit_risk"], got["R1"]["device_risk_score"], got["R1"]["ip_risk_score"]) == (0.75, 0.5, 0.85, 0.9)
        assert (got["O2"]["device_risk_score"], got["O2"]["credit_risk"]) == (0.0, 0.0)


class TestGraph:
    @pytest.mark.parametrize("seed,nodes,links", [(1, 40, 25), (2, 60, 80), (3, 30, 0)])
    def test_components_match_union_find(self, spark, seed, nodes, links):
        rng = random.Random(seed)
        edges = [(f"n{rng.randrange(nodes):03d}", f"n{rng.randrange(nodes):03d}") for _ in range(links)]
        parent = {}

        def root(x):
            parent.setdefault(x, x)
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in edges:
            if a != b:
                a, b = sorted((root(a), root(b)))
                parent[b] = a
        got = graph.connected_components(spark.createDataFrame(edges, "a string, b string"))
        assert {r["node"]: r["component"] for r in got.collect()} == {x: root(x) for x in parent}

    def test_long_chain(self, spark):
        edges = spark.range(60).selectExpr("lpad(id, 3, '0') a", "lpad(id + 1, 3, '0') b")
        got = graph.connected_components(edges)
        assert got.count() == 61 and {r["component"] for r in got.collect()} == {"000"}

    def test_popular_entity_stays_linear(self, spark):
        users = spark.range(500).selectExpr("lpad(id, 4, '0') customer_id")
        devices = users.selectExpr("customer_id", "'D' device_id")
        ips = users.filter("customer_id < '0002'").selectExpr("customer_id", "'I' ip_address")
        edges = graph.shared_entity_edges(devices, ips)
        assert edges.count() == 499
        row = rows_by(edges, "customer_id")["0001"]
        assert (row["hub"], row["shared_devices"], row["shared_ips"]) == ("0000", 1, 1)
        degree = rows_by(graph.customer_degrees(devices, ips), "customer_id")
        assert (degree["0001"]["shared_entities"], degree["0001"]["co_users"]) == (2, 500)

    def test_lonely_customer_keeps_a_component(self, spark):
        devices = spark.createDataFrame([("A", "D1"), ("B", "D1"), ("C", "D2")], "customer_id string, device_id string")
        ips = spark.createDataFrame([], "customer_id string, ip_address string")
        got = rows_by(graph.customer_components(devices, ips), "customer_id")
        assert [(got[c]["component_id"], got[c]["component_size"]) for c in "ABC"] == [("A", 2), ("A", 2), ("C", 1)]


class TestVolumeAndScores:
    def test_gaps_are_filled_and_weekdays_repeat(self, spark):
        rows = [(datetime(2024, 1, d, 5), float(d)) for d in (1, 2, 2, 9, 10)]
        daily = volume.daily_volume(spark.createDataFrame(rows, "timestamp timestamp, amount double"))
        got = rows_by(daily, "day")
        assert len(got) == 10 and got[date(2024, 1, 2)]["txn_count"] == 2 and got[date(2024, 1, 5)]["amount"] == 0.0
        ahead = rows_by(volume.volume_forecast(daily, 9), "day")
        assert sorted(ahead) == [date(2024, 1, 11) + timedelta(days=i) for i in range(9)]
        assert ahead[date(2024, 1, 16)]["amount"] == 9.0 and ahead[date(2024, 1, 17)]["txn_count"] == 1
        assert ahead[date(2024, 1, 11)]["txn_count"] == 0

    def test_metrics(self, spark):
        df = spark.createDataFrame([(0.9, True), (0.8, False), (0.8, True), (0.1, False), (None, True), (0.2, None)], "s double, y boolean")
        got = score_metrics(df, F.col("s"), F.col("y")).first()
        assert (got["positives"], got["negatives"]) == (2, 2)
        assert (got["roc_auc"], got["ks"]) == (0.875, 0.5) and got["pr_auc"] == pytest.approx(0.5 + 0.5 * 2 / 3, abs=1e-6)

    def test_metrics_agree_with_spark_ml(self, spark):
        from pyspark.ml.evaluation import BinaryClassificationEvaluator

        df = spark.range(2000).selectExpr("round((id * 37 % 101) / 101.0D, 4) s", "cast(id % 7 = 0 or id * 37 % 101 > 80 as double) y")
        auc = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", numBins=0).evaluate(df)
        assert score_metrics(df, F.col("s"), F.col("y") == 1).first()["roc_auc"] == pytest.approx(auc, abs=1e-6)

    def test_split_is_stable(self, spark):
        df = spark.range(1000).selectExpr("concat('T', id) k")
        train, test = split(df, "k", 0.2, 42)
        again = split(df.repartition(7), "k", 0.2, 42)[1]
        assert train.count() + test.count() == 1000 and test.exceptAll(again).count() == 0 and 150 < test.count() < 250


def test_a_score_is_worked_out_once(spark):
    """A filter on the score below the histogram would hold a second copy of its expression."""
    rows = [(0.0, True), (0.0, False), (None, True), (0.5, None), (0.7, True)]
    found = score_histogram(spark.createDataFrame(rows, "s double, y boolean"), F.exp("s"), F.col("y"))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("EXP(") == 1
    assert {tuple(r) for r in found.collect()} == {(1.0, 1, 1), (2.0138, 1, 0)}


def test_stored_table_is_read_in_place_of_its_sources(spark, tmp_path):
    given = {
        "events": [(1, datetime(2024, 1, 1), 5, "click", 1.0, '{"n": 7}')],
        "customer": [(5, "c", 1, 0.0, "m")],
        "nation": [(1, "n", 1)],
        "region": [(1, "r")],
    }
    for name, rows in given.items():
        spark.createDataFrame(rows, RAW_SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    plain, stored = Bank(spark, str(tmp_path)), Bank(spark, str(tmp_path)).stored("transactions")
    assert plain.transactions.collect() == stored.transactions.collect() and stored.transactions.count() == 1
    assert "events.parquet" not in "".join(stored.customer_devices.inputFiles())
    assert plain.customer_devices.collect() == stored.customer_devices.collect()
