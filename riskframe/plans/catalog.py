"""Every operator as a named query over one folder of test tables.

Sums of floating-point numbers depend on their order in the last digits, so values such as
deviations and ratios are rounded to six digits here, and dates are given as text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators import as_of, behavior, clean, entity, evaluate, graph, incremental, loans, models, quality, rules, sketches, volume
from riskframe.operators.decision import SINGLE_SIGNAL, decide, risk_inputs
from riskframe.operators.percentiles import amount_percentiles
from riskframe.operators.skew import DEFAULT_POLICY, OWNER, with_owner
from riskframe.operators.velocity import DAY, HOUR, WEEK, WINDOWS, velocity_cuts, velocity_features
from riskframe.plans import features, views
from riskframe.session import configure, staged, work_path
from riskframe.sources.quarantine import REJECTS, load_with_rejects
from riskframe.sources.schemas import TABLES
from riskframe.sources.snapshots import Snapshots
from riskframe.sources.tables import files_sink, read_all, write_datasets
from riskframe.sources.testdata import DIRTY, TestBank
from riskframe.streaming import windows
from riskframe.streaming.enrichment import Lookup, enriched_as_of, histories, popular_keys
from riskframe.streaming.gate import Gate
from riskframe.streaming.io import file_stream, run_available
from riskframe.streaming.stateful import stream_new_entity, stream_velocity

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def dates_as_text(df: DataFrame) -> DataFrame:
    dates = [name for name, kind in df.dtypes if kind == "date"]
    return df.withColumns({c: F.col(c).cast("string") for c in dates}) if dates else df


class Bank(TestBank):
    """The test tables plus the intermediate results that several queries share (all lazy)."""

    def __init__(self, spark: SparkSession, sf_dir: str, *, streaming: bool = False) -> None:
        super().__init__(spark, sf_dir, streaming=streaming)
        configure(spark)

    def stored(self, name: str) -> Bank:
        """Work out the rows of a table once, before anything is built on it, for queries that read it many times."""
        self.__dict__[name] = staged(self.table(name), work_path(self.spark, name))
        return self

    @cached_property
    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in TABLES}

    @cached_property
    def cleaned(self) -> DataFrame:
        return clean.clean_transactions(self.transactions_raw)

    @cached_property
    def fraud_features(self) -> DataFrame:
        return features.fraud_features(
            self.cleaned,
            clean.clean_devices(self.devices),
            self.customer_devices,
            clean.clean_ip_addresses(self.ip_addresses),
            self.customer_ips,
            clean.clean_customers(self.customers),
            self.merchants,
            raw=self.transactions_raw,
            # The layout may be chosen on uncleaned rows, whose times are typed here.
            cuts=velocity_cuts(with_owner(self.transactions), OWNER),
        )

    @cached_property
    def detection(self) -> DataFrame:
        return views.build_views(self.tables)["v_new_device_detection"]

    @cached_property
    def rule_inputs(self) -> rules.RuleInputs:
        homes = self.customers.join(
            self.geo.select("city", F.col("lat").alias("home_latitude"), F.col("lon").alias("home_longitude")), "city"
        ).select("customer_id", "home_latitude", "home_longitude")
        return rules.RuleInputs(self.customer_devices, self.customer_ips, self.merchants, homes)

    @cached_property
    def flagged(self) -> DataFrame:
        return rules.fraud_rule_flags(self.transactions, self.rule_inputs)

    @cached_property
    def default_scores(self) -> DataFrame:
        return loans.default_scores(self.loans, self.customers)

    @cached_property
    def components(self) -> DataFrame:
        return graph.customer_components(self.customer_devices, self.customer_ips)


def _velocity(*pairs: tuple[str, int]) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        bank = Bank(spark, folder)
        slim = bank.transactions.select("transaction_id", "customer_id", "amount", "timestamp")
        rolled = velocity_features(slim, pairs, gap=False)
        measures = [f"{m}_last_{suffix}" for suffix, _ in pairs for m in ("txns", "spend")]
        return rolled.select("transaction_id", "customer_id", *measures)

    return query


def _txn_gap(spark, folder):
    bank = Bank(spark, folder)
    slim = bank.transactions.select("transaction_id", "customer_id", "amount", "timestamp")
    rolled = velocity_features(slim, WINDOWS[:1])
    return rolled.select("transaction_id", "customer_id", "seconds_since_last_txn")


def _velocity_features(spark, folder):
    bank = Bank(spark, folder)
    slim = bank.transactions.select("transaction_id", "customer_id", "amount", "timestamp")
    return velocity_features(slim).drop("timestamp")


def _loans_as_delivered(spark, folder):
    bank = Bank(spark, folder)
    raw = bank.loans.withColumn("loan_start_date", F.col("loan_start_date").cast("string"))
    return clean.normalise("loans", raw).withColumns(
        {"start_year": F.year("loan_start_date"), "loan_start_date": F.col("loan_start_date").cast("string")}
    )


def _sink_roundtrip(spark, folder):
    """Write all three feature datasets and count what a reader finds in each, by a key that all have."""
    bank = Bank(spark, folder)
    target = work_path(spark, "features")
    datasets = {
        "fraud_features": bank.fraud_features,
        "credit_features": features.credit_features(bank.loans, bank.customers, bank.transactions),
        "customer_features": features.customer_features(bank.customers, bank.transactions),
    }
    write_datasets(datasets, target)
    parts = []
    for name, built in datasets.items():
        stored = spark.read.parquet(f"{target}/{name}.parquet")
        same = stored.columns == built.columns and [t for _, t in stored.dtypes] == [t for _, t in built.dtypes]
        rows = stored.groupBy("customer_id").agg(F.count(F.lit(1)).alias("row_count"))
        parts.append(rows.select(F.lit(name).alias("dataset"), "customer_id", "row_count", F.lit(same).alias("same_columns")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _csv_credit_features(spark, folder):
    """Credit features from tables that were written and read as CSV, all text."""
    bank = Bank(spark, folder)
    target = work_path(spark, "csv")
    for name in ("loans", "customers", "transactions"):
        files_sink(target, ("csv",))(name, bank.table(name), "overwrite")
    read = read_all(spark, target, ("loans", "customers", "transactions"))
    built = features.credit_features(
        clean.clean_loans(read["loans"]), clean.clean_customers(read["customers"]), clean.clean_transactions(read["transactions"])
    )
    return dates_as_text(rounded(built, "hist_avg_txn_amount", "installment_to_income"))


def _velocity_dirty(spark, folder):
    cleaned = clean.clean_transactions(Bank(spark, folder).dirty("transactions_dirty"))
    slim = cleaned.select("transaction_id", "customer_id", "amount", "timestamp", "timestamp_sec")
    return velocity_features(slim).drop("timestamp", "timestamp_sec")


def _dirty_tables(bank: Bank) -> dict[str, DataFrame]:
    found = {name: bank.dirty(f"{name}_dirty") if f"{name}_dirty" in DIRTY else bank.table(name) for name in TABLES}
    # Checks compare values, so they see declared types; amounts are also checked as delivered.
    typed = {name: clean.enforce_types(df, {c: t for c, t in TABLES[name].types.items() if t != "string"}) for name, df in found.items()}
    return {**typed, "delivered": found["transactions"]}


def _dq_report_dirty(spark, folder):
    tables = _dirty_tables(Bank(spark, folder))
    amounts = lambda t: quality.amount_checks({"transactions": t["delivered"]})
    return quality.quality_report(tables, {**quality.CHECK_GROUPS, "amount_checks": amounts})


def _load_with_rejects(spark, folder):
    """Every row of the dirty tables by key and reasons; those of sound rows are empty."""
    bank = Bank(spark, folder)
    store = Snapshots(spark, work_path(spark, "sound"))
    load_with_rejects(spark, {n: bank.dirty(f"{n}_dirty") if f"{n}_dirty" in DIRTY else bank.table(n) for n in TABLES}, store, "first")
    rows = store.read(REJECTS).select("table_name", "row_key", F.array_join("reasons", ",").alias("reasons"))
    for name, table in TABLES.items():
        rows = rows.unionByName(store.read(name).select(F.lit(name).alias("table_name"), F.concat_ws("|", *table.key).alias("row_key"), F.lit("").alias("reasons")))
    return rows.groupBy("table_name", "row_key", "reasons").agg(F.count(F.lit(1)).alias("row_count"))


# Output name -> counted column.
_COUNTED = {"devices": "device_id", "ips": "ip_address", "merchants": "merchant_id"}
_SPAN_DAYS = 30


def _against_exact(estimates: DataFrame, exact: DataFrame, key: str, *names: str) -> DataFrame:
    """Exact counts, and whether all estimates keep to the error bound."""
    joined = exact.join(estimates.select(key, *[F.col(n).alias(f"_{n}") for n in names]), key, "left")
    close = F.lit(True)
    for n in names:
        close &= F.coalesce(F.abs(F.col(f"_{n}") - F.col(n)) <= sketches.error_bound(F.col(n)), F.lit(False))
    return joined.select(key, *names, close.alias("within_bound"))


def _entity_customers_sketched(spark, folder):
    """Customers per device and IP over the last days, from daily sketches of two loads, against exact counts."""
    txns = Bank(spark, folder).transactions
    last = txns.agg(F.to_date(F.max("timestamp"))).scalar()
    first = F.date_sub(last, _SPAN_DAYS - 1)
    parts = []
    for kind in (entity.DEVICE, entity.IP):
        loads = [txns.filter(F.pmod(F.xxhash64("transaction_id"), F.lit(2)) == load) for load in (0, 1)]
        kept = [sketches.daily_sketches(load, kind.key, {"customers": "customer_id"}) for load in loads]
        daily = sketches.merged(kept[0].unionByName(kept[1]), kind.key)
        recent = txns.filter(F.to_date("timestamp").between(first, last))
        exact = recent.groupBy(kind.key).agg(F.countDistinct("customer_id").alias("customers"))
        both = _against_exact(sketches.distinct_between(daily, kind.key, first, last), exact, kind.key, "customers")
        parts.append(both.select(F.lit(kind.prefix).alias("entity_type"), F.col(kind.key).alias("entity_id"), "customers", "within_bound"))
    return parts[0].unionByName(parts[1])


def _customer_distincts_sketched(spark, folder):
    """Devices, IPs and merchants of each customer over all days, three sketches in one pass, against exact counts."""
    txns = Bank(spark, folder).transactions
    daily = sketches.daily_sketches(txns, "customer_id", _COUNTED)
    exact = txns.groupBy("customer_id").agg(*[F.countDistinct(c).alias(n) for n, c in _COUNTED.items()])
    return _against_exact(sketches.distinct_between(daily, "customer_id"), exact, "customer_id", *_COUNTED)


def _entity_stats(spark, folder):
    txns = Bank(spark, folder).transactions
    parts = [
        entity.refresh_stats(txns, kind).select(
            F.lit(kind.prefix).alias("entity_type"),
            F.col(kind.key).alias("entity_id"),
            "first_seen",
            "last_seen",
            "transaction_count",
            "fraud_count",
            "customer_count",
        )
        for kind in (entity.DEVICE, entity.IP)
    ]
    return parts[0].unionByName(parts[1])


def _entity_stats_incremental(spark, folder):
    """The counters after three deliveries and a repeated one, kept in buckets."""
    txns = Bank(spark, folder).transactions.select("transaction_id", "customer_id", "device_id", "ip_address", "timestamp", "is_fraud")
    store = Snapshots(spark, work_path(spark, "uses"))
    parts = []
    for kind in (entity.DEVICE, entity.IP):
        uses = incremental.EntityUses(store, kind, buckets=16)
        for delivery in (0, 1, 2, 1):
            uses.add(txns.filter(F.pmod(F.xxhash64("transaction_id"), F.lit(3)) == delivery), f"day-{delivery}")
        parts.append(uses.stats().select(F.lit(kind.prefix).alias("entity_type"), F.col(kind.key).alias("entity_id"), "first_seen", "last_seen", "transaction_count", "fraud_count", "customer_count"))
    return parts[0].unionByName(parts[1])


def _check_new_device(spark, folder):
    bank = Bank(spark, folder)
    requests = bank.transactions.select("customer_id", "device_id").distinct()
    return entity.check_new_device(requests, bank.customer_devices)


_AMOUNT_RATIOS = ("cust_avg_amount", "cust_std_amount", "amount_vs_cust_avg", "amount_z_score")


def _behavioral(spark, folder):
    bank = Bank(spark, folder)
    built = behavior.behavioral_features(bank.transactions, bank.customers, bank.merchants)
    return rounded(built.select("transaction_id", "merchant_risk_score", *features.BEHAVIOR_COLUMNS), *_AMOUNT_RATIOS)


def _entity_features(kind: entity.EntityKind, columns: tuple[str, ...]) -> Query:
    def query(spark, folder):
        bank = Bank(spark, folder)
        entities, usage = (
            (bank.devices, bank.customer_devices) if kind is entity.DEVICE else (bank.ip_addresses, bank.customer_ips)
        )
        built = entity.entity_features(bank.transactions, entities, usage, kind)
        return built.select("transaction_id", "customer_id", kind.key, *columns)

    return query


def _credit(spark, folder):
    bank = Bank(spark, folder)
    built = features.credit_features(
        clean.clean_loans(bank.loans), clean.clean_customers(bank.customers), bank.cleaned
    )
    return dates_as_text(rounded(built, "hist_avg_txn_amount", "installment_to_income"))


def _customer(spark, folder):
    bank = Bank(spark, folder)
    built = features.customer_features(clean.clean_customers(bank.customers), bank.cleaned)
    return dates_as_text(rounded(built, "hist_avg_txn_amount"))


def _view(name: str, *inexact: str) -> Query:
    def query(spark, folder):
        bank = Bank(spark, folder)
        as_of = bank.transactions.agg(F.max("timestamp")).scalar()
        return rounded(views.build_views(bank.tables, as_of)[name], *inexact)

    return query


def _quality(check: Callable[[dict[str, DataFrame]], DataFrame], raw: bool = False) -> Query:
    """``raw`` checks the table as delivered, with its repeated rows."""

    def query(spark, folder):
        bank = Bank(spark, folder)
        tables = {**bank.tables, "transactions": bank.transactions_raw} if raw else bank.tables
        return check(tables)

    return query


def _pit(spark, folder):
    bank = Bank(spark, folder)
    built = entity.point_in_time_new(bank.transactions, bank.customer_devices)
    return built.select("transaction_id", "customer_id", "device_id", "is_first_use", "is_new_now")


def _rule(name: str) -> Query:
    def query(spark, folder):
        bank = Bank(spark, folder)
        flagged = rules.rule_flags(bank.transactions, bank.rule_inputs, [name])
        return flagged.select("transaction_id", "customer_id", F.col(name).alias("hit"))

    return query


def _rule_flags(spark, folder):
    return Bank(spark, folder).flagged.select("transaction_id", "customer_id", *rules.RULES, "first_match")


def _rule_score(spark, folder):
    flagged = Bank(spark, folder).flagged
    return flagged.select("transaction_id", "customer_id", rules.rule_score().alias("fraud_score"))


def _risk_tier(spark, folder):
    customers = Bank(spark, folder).customers
    return customers.select("customer_id", "credit_score", loans.risk_tier(F.col("credit_score")).alias("risk_tier"))


def _emi(spark, folder):
    bank = Bank(spark, folder)
    return rounded(loans.loan_emi_dti(bank.loans, bank.customers), "emi", digits=4)


def _default_score(spark, folder):
    scored = Bank(spark, folder).default_scores.select("loan_id", "customer_id", "default_probability")
    return rounded(scored, "default_probability")


def _expected_loss(spark, folder):
    lost = loans.expected_loss(Bank(spark, folder).default_scores)
    columns = ("loan_id", "customer_id", "default_probability", "exposure_at_default", "expected_loss")
    return rounded(lost.select(*columns), "default_probability")


def _decision_inputs(spark, folder) -> DataFrame:
    bank = Bank(spark, folder)
    worst = bank.default_scores.groupBy("customer_id").agg(
        F.round(F.max("default_probability"), 6).alias("credit_risk")
    )
    lookups = risk_inputs(
        entity.entity_profile(bank.devices, bank.customer_devices, entity.DEVICE),
        entity.entity_profile(bank.ip_addresses, bank.customer_ips, entity.IP),
        worst,
        bank.components,
    )
    return rules.rule_flags(bank.transactions, bank.rule_inputs, also=lookups)


def _decision(spark, folder):
    return decide(_decision_inputs(spark, folder)).withColumn("reason_codes", F.concat_ws(",", "reason_codes"))


def _decision_single_signal(spark, folder):
    """Each signal may decide alone, by the configured limits."""
    decided = decide(_decision_inputs(spark, folder), SINGLE_SIGNAL)
    return decided.select("transaction_id", "customer_id", "fraud_score", "credit_risk", "risk_score", "decision")


def _score_metrics(spark, folder):
    flagged = Bank(spark, folder).stored("transactions").flagged
    return evaluate.score_metrics(flagged, rules.rule_score(), F.col("is_fraud"))


def _segments(spark, folder):
    bank = Bank(spark, folder)
    return models.segment_customers(features.customer_features(bank.customers, bank.transactions))


def _fraud_classifier(spark, folder):
    rows = Bank(spark, folder).fraud_features
    return models.train_classifier(rows, models.FRAUD_INPUTS, "is_fraud", "transaction_id", models.FRAUD_TRAINING)[1]


def _default_classifier(spark, folder):
    bank = Bank(spark, folder)
    rows = features.credit_features(bank.loans, bank.customers, bank.transactions)
    return models.train_classifier(rows, models.DEFAULT_INPUTS, "default_flag", "loan_id", models.CREDIT_TRAINING)[1]


def _stream(build: Callable[[Bank, Bank], DataFrame], label: str) -> Query:
    """``build`` gets the streaming and the static bank; the result is what the stream has written."""

    def query(spark, folder):
        return run_available(build(Bank(spark, folder, streaming=True), Bank(spark, folder)), label)

    return query


def _stream_dedup(live: Bank, _: Bank) -> DataFrame:
    typed = clean.enforce_types(live.transactions_raw, {"timestamp": "timestamp"})
    return windows.deduplicated(typed).select("transaction_id", "customer_id", "amount", "timestamp")


def _stream_enrich(live: Bank, static: Bank) -> DataFrame:
    known = views.build_views(static.tables)
    slim = live.transactions.select("transaction_id", "customer_id", "device_id", "ip_address", "amount")
    return windows.enriched(slim, known["v_device_intelligence"], known["v_ip_intelligence"])


_VERSIONS = 3


def _risk_versions(txns: DataFrame, kind: entity.EntityKind) -> DataFrame:
    """Risk of each entity from its customers so far, as published after each third of the time but the last."""
    micros = F.unix_micros("timestamp")
    low, high = (txns.agg(f(micros)).scalar() for f in (F.min, F.max))
    versions = []
    for number in range(1, _VERSIONS):
        since = F.timestamp_micros(low + F.call_function("div", (high - low) * number, F.lit(_VERSIONS)))
        counts = entity.customer_count(txns.filter(F.col("timestamp") < since), kind)
        risk = kind.risk(F.col(f"{kind.prefix}_customer_count"))
        versions.append(counts.select(kind.key, risk.alias("score"), since.alias("valid_from")))
    return versions[0].unionByName(versions[1])


def _stream_enrich_versions(spark, folder):
    """Device and IP risk of each transaction by the version that held at its time."""
    live, txns = Bank(spark, folder, streaming=True).transactions, Bank(spark, folder).transactions
    lookups = []
    for kind in (entity.DEVICE, entity.IP):
        held = staged(histories(_risk_versions(txns, kind), kind.key, "score"), work_path(spark, "histories"))
        popular = staged(popular_keys(txns, kind.key, DEFAULT_POLICY.hot_rows), work_path(spark, "popular"))
        lookups.append(Lookup(held, kind.key, f"{kind.prefix}_risk_score", popular))
    slim = live.select("transaction_id", "customer_id", "device_id", "ip_address", "timestamp")
    return run_available(enriched_as_of(slim, lookups).drop("timestamp"), "versions")


_DELIVERIES = 4


def _deliveries(bank: Bank) -> DataFrame:
    """Transactions with the ``delivery`` that brings them: quarters of the time they span, every 17th row one delivery
    later than its time, every 29th two, and every 31st without its time."""
    txns = bank.transactions.select("transaction_id", "customer_id", "device_id", "amount", "timestamp")
    micros, number = F.unix_micros("timestamp"), F.substr("transaction_id", F.lit(4)).cast("bigint")
    low, high = (txns.agg(f(micros)).scalar() for f in (F.min, F.max))
    quarter = F.call_function("div", (micros - low) * _DELIVERIES, high - low + 1)
    behind = F.when(number % 29 == 0, 2).when(number % 17 == 0, 1).otherwise(0)
    return txns.withColumn("delivery", F.least(quarter + behind, F.lit(_DELIVERIES - 1)).cast("int")).withColumn(
        "timestamp", F.when(number % 31 != 0, F.col("timestamp"))
    )


def _gated(spark: SparkSession, folder: str) -> Gate:
    """One micro-batch for each delivery, through a gate."""
    rows, arrivals = _deliveries(Bank(spark, folder)), work_path(spark, "arrivals")
    schema = rows.drop("delivery").schema
    gate = Gate(spark, work_path(spark, "gate"), schema)
    for delivery in range(_DELIVERIES):
        rows.filter(F.col("delivery") == delivery).drop("delivery").write.mode("append").parquet(arrivals)
        gate.run_available(file_stream(spark, arrivals, schema))
    return gate


def _stream_late_rows(spark, folder):
    """Every row of four deliveries with its micro-batch and the side it went to."""
    gate = _gated(spark, folder)
    return gate.passed().unionByName(gate.aside()).select("transaction_id", "batch", "reason")


def _stream_late_velocity(spark, folder):
    """Rolling velocity over what the gate lets through."""
    return run_available(stream_velocity(_gated(spark, folder).live()), "gated-velocity")


QUERIES: dict[str, Query] = {
    # velocity
    "velocity_1h": _velocity(HOUR),
    "velocity_24h": _velocity(DAY),
    "velocity_7d": _velocity(WEEK),
    "velocity_1m_5m": _velocity(("1m", 60), ("5m", 300)),
    "velocity_dirty": _velocity_dirty,
    "txn_gap": _txn_gap,
    "velocity_features": _velocity_features,
    # cleaning, sources, sinks
    "clean_transactions": lambda s, d: Bank(s, d).cleaned,
    "clean_transactions_dirty": lambda s, d: clean.clean_transactions(Bank(s, d).dirty("transactions_dirty")),
    "csv_credit_features": _csv_credit_features,
    "clean_customers": lambda s, d: dates_as_text(clean.clean_customers(Bank(s, d).customers)),
    "clean_devices": lambda s, d: clean.clean_devices(Bank(s, d).devices),
    "clean_ips": lambda s, d: clean.clean_ip_addresses(Bank(s, d).ip_addresses),
    "clean_loans": lambda s, d: dates_as_text(clean.clean_loans(Bank(s, d).loans)),
    "load_normalise_loans": _loans_as_delivered,
    "sink_roundtrip": _sink_roundtrip,
    "pseudonymise_device": lambda s, d: clean.pseudonymise(Bank(s, d).devices, "device_id"),
    # devices and IP addresses
    "device_customer_count": lambda s, d: entity.customer_count(Bank(s, d).customer_devices, entity.DEVICE),
    "ip_customer_count": lambda s, d: entity.customer_count(Bank(s, d).customer_ips, entity.IP),
    "device_features": _entity_features(entity.DEVICE, features.DEVICE_COLUMNS),
    "ip_features": _entity_features(entity.IP, features.IP_COLUMNS),
    "entity_stats_refresh": _entity_stats,
    "entity_stats_incremental": _entity_stats_incremental,
    "customer_device_map": lambda s, d: entity.usage_map(Bank(s, d).transactions, entity.DEVICE),
    "customer_ip_map": lambda s, d: entity.usage_map(Bank(s, d).transactions, entity.IP),
    "entity_customers_sketched": _entity_customers_sketched,
    "customer_distincts_sketched": _customer_distincts_sketched,
    "check_new_device": _check_new_device,
    # behaviour and feature datasets
    "customer_amount_percentiles": lambda s, d: rounded(
        amount_percentiles(Bank(s, d).transactions), "p25", "p50", "p75", "p90", "p99"
    ),
    "customer_amount_stats": lambda s, d: rounded(
        behavior.customer_amount_stats(Bank(s, d).transactions), "cust_avg_amount", "cust_std_amount"
    ),
    "customer_txn_summary": lambda s, d: rounded(
        behavior.customer_txn_summary(Bank(s, d).transactions), "hist_avg_txn_amount"
    ),
    "behavioral_features": _behavioral,
    "fraud_features": lambda s, d: rounded(Bank(s, d).fraud_features, *_AMOUNT_RATIOS),
    "fraud_features_as_of": lambda s, d: rounded(
        as_of.fraud_features_as_of(Bank(s, d).transactions), "cust_avg_before", "cust_std_before", "amount_vs_avg_before", "z_score_before"
    ),
    "credit_features": _credit,
    "customer_features": _customer,
    "feature_summary": lambda s, d: rounded(
        features.feature_summary(Bank(s, d).fraud_features), "new_device_pct", "new_ip_pct", "fraud_pct"
    ),
    "new_entity_sample": lambda s, d: rounded(features.new_entity_sample(Bank(s, d).fraud_features), "amount_z_score"),
    # views
    "v_customer_features": _view("v_customer_features", "avg_transaction_amount", "stddev_transaction_amount"),
    "v_device_intelligence": _view("v_device_intelligence"),
    "v_ip_intelligence": _view("v_ip_intelligence"),
    "v_new_device_detection": _view("v_new_device_detection"),
    "v_transaction_velocity": _view("v_transaction_velocity"),
    "v_customer_transaction_summary": _view(
        "v_customer_transaction_summary", "avg_transaction_amount", "stddev_amount"
    ),
    "v_device_risk": _view("v_device_risk", "device_age_days"),
    "v_high_risk_customers": _view("v_high_risk_customers"),
    "new_device_summary": lambda s, d: views.new_device_summary(Bank(s, d).detection),
    "new_device_sample": lambda s, d: views.new_device_sample(Bank(s, d).detection),
    # data quality
    "table_row_counts": _quality(quality.table_row_counts),
    "dq_orphans": _quality(quality.orphan_checks),
    "dq_nulls": _quality(quality.null_checks),
    "dq_ranges": _quality(quality.range_checks),
    "dq_duplicates": _quality(quality.duplicate_checks, raw=True),
    "dq_report": _quality(quality.quality_report, raw=True),
    "dq_report_dirty": _dq_report_dirty,
    "load_with_rejects": _load_with_rejects,
    "dq_constraints": lambda s, d: quality.constraint_checks(_dirty_tables(Bank(s, d))),
    # rules and loan scoring
    "pit_new_device": _pit,
    "rule_new_device": _rule("new_device_fraud"),
    **{
        f"rule_{name}": _rule(name)
        for name in rules.RULES
        if name != "new_device_fraud"
    },
    "fraud_rule_flags": _rule_flags,
    "fraud_rule_flags_legacy": lambda s, d: rules.fraud_rule_flags(
        Bank(s, d).transactions, Bank(s, d).rule_inputs, legacy=True
    ).select("transaction_id", "customer_id", "first_match"),
    "fraud_scenario_counts": lambda s, d: rules.scenario_counts(Bank(s, d).flagged),
    "customer_risk_tier": _risk_tier,
    "loan_emi_dti": _emi,
    "loan_default_score": _default_score,
    # streams
    "stream_tumbling_1h": _stream(lambda live, _: windows.tumbling(live.transactions), "tumbling"),
    "stream_sliding_1h_5m": _stream(lambda live, _: windows.sliding(live.transactions), "sliding"),
    "stream_sessions": _stream(lambda live, _: windows.sessions(live.transactions), "sessions"),
    "stream_velocity": _stream(lambda live, _: stream_velocity(live.transactions), "velocity"),
    "stream_new_device": _stream(lambda live, _: stream_new_entity(live.transactions), "entities"),
    "stream_new_ip": _stream(lambda live, _: stream_new_entity(live.transactions, entity.IP), "addresses"),
    "stream_enrich_versions": _stream_enrich_versions,
    "stream_late_rows": _stream_late_rows,
    "stream_late_velocity": _stream_late_velocity,
    "stream_enrich": _stream(_stream_enrich, "enrich"),
    "stream_dedup": _stream(_stream_dedup, "dedup"),
    # scores, decisions, graph, volume, models
    "fraud_rule_score": _rule_score,
    "expected_loss": _expected_loss,
    "decision_engine": _decision,
    "decision_single_signal": _decision_single_signal,
    "shared_entity_edges": lambda s, d: graph.shared_entity_edges(Bank(s, d).customer_devices, Bank(s, d).customer_ips),
    "shared_entity_pairs": lambda s, d: graph.shared_entity_pairs(Bank(s, d).customer_devices, Bank(s, d).customer_ips),
    "customer_neighbours": lambda s, d: graph.customer_neighbours(Bank(s, d).customer_devices, Bank(s, d).customer_ips),
    "customer_degrees": lambda s, d: graph.customer_degrees(Bank(s, d).customer_devices, Bank(s, d).customer_ips),
    "customer_components": lambda s, d: Bank(s, d).components,
    "daily_volume": lambda s, d: dates_as_text(volume.daily_volume(Bank(s, d).transactions)),
    "volume_forecast": lambda s, d: dates_as_text(volume.volume_forecast(volume.daily_volume(Bank(s, d).transactions))),
    "score_ks_auc": _score_metrics,
    "customer_segments": _segments,
    "fraud_classifier": _fraud_classifier,
    "default_classifier": _default_classifier,
}
