"""The expected result of each query, as DuckDB SQL over the same test tables."""

from __future__ import annotations

import re

from riskframe.sources.schemas import TABLES
from riskframe.sources.testdata import duckdb_ctes

_TABLES = duckdb_ctes()


def _sql(final: str, **ctes: str) -> str:
    return _TABLES + "".join(f",\n{name} AS ({text})" for name, text in ctes.items()) + "\n" + final


_SEC = "(epoch_us(timestamp) // 1000000)"
_MONEY = "cast(amount as decimal(12,2))"
_SUM = f"cast(sum({_MONEY}) as double)"
_MEAN = f"({_SUM} / count(amount))"


def _rate(part: str, whole: str) -> str:
    return f"case when {whole} > 0 then cast((20000*({part}) + ({whole})) // (2*({whole})) as bigint) / 1e4 else 0e0 end"


def _frames(*pairs: tuple[str, int]) -> tuple[str, str]:
    columns = ", ".join(
        f"count(transaction_id) over w{s} - 1 AS txns_last_{s},"
        f" cast(coalesce(sum({_MONEY}) over w{s}, 0) as double) AS spend_last_{s}"
        for s, _ in pairs
    )
    windows = ", ".join(
        f"w{s} AS (PARTITION BY customer_id ORDER BY {_SEC} RANGE BETWEEN {n} PRECEDING AND CURRENT ROW)"
        for s, n in pairs
    )
    return columns, windows


_W = (("1h", 3600), ("24h", 86400), ("7d", 604800))
_GAP = (
    f"coalesce({_SEC} - lag({_SEC}) over (PARTITION BY customer_id ORDER BY {_SEC}, transaction_id), 999999)"
    " AS seconds_since_last_txn"
)
_ALL_COLUMNS, _ALL_WINDOWS = _frames(*_W)
_VELOCITY = f"SELECT *, {_SEC} AS timestamp_sec, {_ALL_COLUMNS}, {_GAP} FROM transactions WINDOW {_ALL_WINDOWS}"


def _velocity(pair: tuple[str, int]) -> str:
    columns, windows = _frames(pair)
    return _sql(f"SELECT transaction_id, customer_id, {columns} FROM transactions WINDOW {windows}")


def _customers_per(usage: str, key: str) -> str:
    return f"SELECT {key}, count(distinct customer_id) AS c FROM {usage} GROUP BY {key}"


_DEV_RISK = "case when {} > 3 then 0.85e0 when {} > 1 then 0.40e0 else 0.05e0 end"
_IP_RISK = "case when {} > 5 then 0.90e0 when {} > 2 then 0.50e0 else 0.05e0 end"


def _profile(entities: str, usage: str, key: str, p: str, risk: str, carry: str = "") -> str:
    c = "coalesce(u.c, 1)"
    return f"""SELECT e.{key}, {carry} {c} AS {p}_customer_count, coalesce(transaction_count, 0) AS {p}_txn_count,
      case when transaction_count > 0 then coalesce(fraud_count, 0) / transaction_count else 0e0 end AS {p}_fraud_rate,
      {risk.format(c, c)} AS {p}_risk_score
      FROM {entities} e LEFT JOIN ({_customers_per(usage, key)}) u ON e.{key} = u.{key}"""


_DEVICE_PROFILE = _profile("devices", "customer_devices", "device_id", "device", _DEV_RISK, "device_type, operating_system,")
_IP_PROFILE = _profile("ip_addresses", "customer_ips", "ip_address", "ip", _IP_RISK)


def _filled(p: str, alias: str) -> str:
    return (
        f"coalesce({alias}.{p}_customer_count, 1) AS {p}_customer_count, coalesce({alias}.{p}_txn_count, 1) AS {p}_txn_count,"
        f" coalesce({alias}.{p}_fraud_rate, 0e0) AS {p}_fraud_rate, coalesce({alias}.{p}_risk_score, 0e0) AS {p}_risk_score"
    )


_DEVICE_COLS = f"dp.device_type, dp.operating_system, {_filled('device', 'dp')}, kd.customer_id IS NULL AS is_new_device"
_IP_COLS = f"{_filled('ip', 'ipp')}, ki.customer_id IS NULL AS is_new_ip"
_DEVICE_JOIN = """LEFT JOIN device_profile dp ON t.device_id = dp.device_id
  LEFT JOIN customer_devices kd ON t.customer_id = kd.customer_id AND t.device_id = kd.device_id"""
_IP_JOIN = """LEFT JOIN ip_profile ipp ON t.ip_address = ipp.ip_address
  LEFT JOIN customer_ips ki ON t.customer_id = ki.customer_id AND t.ip_address = ki.ip_address"""

_STATS = f"""SELECT customer_id, {_MEAN} AS cust_avg_amount, coalesce(stddev_samp(amount), 1e0) AS cust_std_amount,
  max(amount) AS cust_max_amount, count(transaction_id) AS cust_total_txns FROM transactions GROUP BY customer_id"""
_SUMMARY = f"""SELECT customer_id, count(transaction_id) AS hist_total_txns, {_MEAN} AS hist_avg_txn_amount,
  {_SUM} AS hist_total_spend, cast(sum(case when is_fraud then 1 else 0 end) as bigint) AS hist_fraud_count
  FROM transactions GROUP BY customer_id"""
_BEHAVIOR = """round(st.cust_avg_amount, 6) AS cust_avg_amount, round(st.cust_std_amount, 6) AS cust_std_amount,
  st.cust_max_amount, st.cust_total_txns, c.age, c.income, c.credit_score, c.risk_profile, c.city AS home_city, m.merchant_name,
  round(case when st.cust_avg_amount > 0 then t.amount / st.cust_avg_amount else 1 end, 6) AS amount_vs_cust_avg,
  round(case when st.cust_std_amount > 0 then (t.amount - st.cust_avg_amount) / st.cust_std_amount else 0 end, 6) AS amount_z_score,
  cast(hour(t.timestamp) as int) AS txn_hour, cast(dayofweek(t.timestamp) + 1 as int) AS txn_day_of_week,
  dayofweek(t.timestamp) in (0, 6) AS is_weekend, hour(t.timestamp) in (2, 3, 4) AS is_unusual_hour,
  hour(t.timestamp) in (0, 1, 2, 3, 4, 5, 6, 22, 23) AS is_off_peak,
  coalesce(t.city <> c.city, false) AS is_different_city"""
_MERCHANT_RISK = "coalesce(m.merchant_risk_score, t.merchant_risk_score, 0.1e0) AS merchant_risk_score"
_BEHAVIOR_JOIN = """LEFT JOIN stats st ON t.customer_id = st.customer_id LEFT JOIN customers c ON t.customer_id = c.customer_id
  LEFT JOIN merchants m ON t.merchant_id = m.merchant_id"""

_FRAUD = f"""SELECT t.* EXCLUDE (merchant_risk_score), {_MERCHANT_RISK}, {_DEVICE_COLS}, {_IP_COLS}, {_BEHAVIOR}
  FROM velocity t {_DEVICE_JOIN} {_IP_JOIN} {_BEHAVIOR_JOIN}"""
_FRAUD_CTES = {"velocity": _VELOCITY, "device_profile": _DEVICE_PROFILE, "ip_profile": _IP_PROFILE, "stats": _STATS}

_EARLIER = "(PARTITION BY {} ORDER BY epoch_us(timestamp) RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


def _entity_before(key: str, p: str, risk: str) -> str:
    known = f"{key} IS NOT NULL AND timestamp IS NOT NULL"
    n, c = f"(case when {known} then coalesce({p}_n, 0) else 0 end)", f"(case when {known} then coalesce({p}_c, 0) else 0 end)"
    return f"""cast({c} AS bigint) AS {p}_customers_before, cast({n} AS bigint) AS {p}_txns_before,
      case when {n} > 0 then {p}_f / {n} else 0e0 end AS {p}_fraud_rate_before,
      case when {n} > 0 then {risk.format(c, c)} else 0e0 end AS {p}_risk_before,
      NOT coalesce({p}_first < timestamp, false) AS is_new_{p}_then"""


def _entity_sums(key: str, p: str) -> str:
    w = _EARLIER.format(key)
    return f"""count(*) over {w} AS {p}_n, sum(case when is_fraud then 1 else 0 end) over {w} AS {p}_f, sum({p}_new) over {w} AS {p}_c,
      case when customer_id is not null and {key} is not null then min(timestamp) over (PARTITION BY customer_id, {key}) end AS {p}_first"""


_FIRST_USES = ", ".join(
    f"""case when customer_id is not null and {key} is not null and timestamp is not null
      and row_number() over (PARTITION BY customer_id, {key} ORDER BY timestamp NULLS LAST, transaction_id) = 1 then 1 else 0 end AS {p}_new"""
    for key, p in (("device_id", "device"), ("ip_address", "ip"))
)
_CUST_W = _EARLIER.format("customer_id")
_AS_OF_CTES = {
    "uses": f"SELECT transaction_id, customer_id, device_id, ip_address, timestamp, amount, is_fraud, {_FIRST_USES} FROM transactions",
    "sums": f"""SELECT *, {_entity_sums("device_id", "device")}, {_entity_sums("ip_address", "ip")},
      count(*) over {_CUST_W} AS n, count(amount) over {_CUST_W} AS k, max(amount) over {_CUST_W} AS most,
      sum(cast({_MONEY} * 100 AS bigint)) over {_CUST_W} AS s1, sum(cast({_MONEY} * 100 AS hugeint) * cast({_MONEY} * 100 AS hugeint)) over {_CUST_W} AS s2
      FROM uses""",
    "seen": """SELECT * REPLACE (case when ok then n else 0 end AS n, case when ok then k else 0 end AS k, case when ok then most end AS most)
      FROM (SELECT *, customer_id IS NOT NULL AND timestamp IS NOT NULL AS ok FROM sums)""",
    "moments": """SELECT *, case when k > 0 then cast(s1 AS double) / 100 / k end AS mean,
      coalesce(case when k > 1 then sqrt(cast(cast(k AS hugeint) * cast(s2 AS hugeint) - cast(s1 AS hugeint) * cast(s1 AS hugeint) AS double)
        / (cast(k AS double) * cast(k - 1 AS double))) / 100 end, 1e0) AS dev FROM seen""",
}
_AS_OF = f"""SELECT transaction_id, customer_id, device_id, ip_address, timestamp, amount,
  {_entity_before("device_id", "device", _DEV_RISK)}, {_entity_before("ip_address", "ip", _IP_RISK)},
  cast(n AS bigint) AS cust_txns_before, round(mean, 6) AS cust_avg_before, round(dev, 6) AS cust_std_before, most AS cust_max_before,
  round(case when mean > 0 then amount / mean else 1 end, 6) AS amount_vs_avg_before,
  round(case when mean is not null and dev > 0 then (amount - mean) / dev else 0 end, 6) AS z_score_before FROM moments"""

_CREDIT = """SELECT l.* EXCLUDE (loan_start_date), cast(l.loan_start_date as varchar) AS loan_start_date,
  c.age, c.gender, c.income, c.city, c.state, cast(c.customer_since as varchar) AS customer_since, c.credit_score, c.risk_profile,
  s.hist_total_txns, round(s.hist_avg_txn_amount, 6) AS hist_avg_txn_amount, s.hist_total_spend, s.hist_fraud_count,
  round(case when l.monthly_income > 0 then (l.loan_amount / l.tenure_months) / l.monthly_income else 0 end, 6) AS installment_to_income,
  coalesce(l.delinquency_history > 2 OR c.credit_score < 580, false) AS delinquency_risk_flag
  FROM loans l LEFT JOIN customers c ON l.customer_id = c.customer_id LEFT JOIN summary s ON l.customer_id = s.customer_id"""
_CUSTOMER = """SELECT c.* EXCLUDE (customer_since), cast(c.customer_since as varchar) AS customer_since,
  coalesce(hist_total_txns, 0) AS hist_total_txns, round(hist_avg_txn_amount, 6) AS hist_avg_txn_amount,
  coalesce(hist_total_spend, 0e0) AS hist_total_spend, coalesce(hist_fraud_count, 0) AS hist_fraud_count
  FROM customers c LEFT JOIN summary s ON c.customer_id = s.customer_id"""

# Views, written as the joins they are defined by.
_V_ACTIVITY = f"""SELECT c.customer_id, count(t.transaction_id) AS n, {_SUM.replace('amount', 't.amount')} AS total,
  {_MEAN.replace('amount', 't.amount')} AS mean, stddev_samp(t.amount) AS dev, max(t.amount) AS largest,
  max(t.timestamp) AS last_at, min(t.timestamp) AS first_at, count(distinct t.device_id) AS devices_used,
  count(distinct t.ip_address) AS ips_used, count(distinct t.merchant_id) AS merchants_used,
  cast(sum(case when t.is_fraud then 1 else 0 end) as bigint) AS frauds
  FROM customers c LEFT JOIN transactions t ON c.customer_id = t.customer_id GROUP BY c.customer_id"""


def _intelligence(entities: str, usage: str, key: str, p: str, risk: str, carry: str) -> str:
    c = f"count(distinct u.customer_id)"
    return f"""SELECT e.{key}, {carry} {c} AS shared_customer_count, e.transaction_count AS global_transaction_count,
      e.fraud_count AS global_fraud_count, {_rate('e.fraud_count', 'e.transaction_count')} AS {p}_fraud_rate,
      {risk.format(c, c)} AS {p}_risk_score FROM {entities} e LEFT JOIN {usage} u ON e.{key} = u.{key}
      GROUP BY e.{key}, {carry} e.transaction_count, e.fraud_count"""


_V_DEVICE = _intelligence("devices", "customer_devices", "device_id", "device", _DEV_RISK, "e.device_type, e.operating_system,")
_V_IP = _intelligence("ip_addresses", "customer_ips", "ip_address", "ip", _IP_RISK, "")
_V_DETECTION = """SELECT t.transaction_id, t.customer_id, t.account_id, t.device_id, t.ip_address, t.amount, t.timestamp,
  t.merchant_id, t.merchant_category, t.is_fraud, t.fraud_scenario, cd.customer_id IS NULL AS is_new_device,
  coalesce(cd.use_count, 0) AS customer_device_use_count, coalesce(di.device_risk_score, 0.05e0) AS device_risk_score,
  coalesce(ii.ip_risk_score, 0.05e0) AS ip_risk_score
  FROM transactions t LEFT JOIN customer_devices cd ON t.customer_id = cd.customer_id AND t.device_id = cd.device_id
  LEFT JOIN v_dev di ON t.device_id = di.device_id LEFT JOIN v_ip ii ON t.ip_address = ii.ip_address"""
_DETECTION_CTES = {"v_dev": _V_DEVICE, "v_ip": _V_IP, "detection": _V_DETECTION}
_EXACT = "(PARTITION BY customer_id ORDER BY timestamp RANGE BETWEEN INTERVAL '{}' PRECEDING AND CURRENT ROW)"

# Data quality.
_ORPHANS = {
    "orphaned_accounts_customer": ("accounts", "customer_id", "customers", "customer_id"),
    "orphaned_txns_customer": ("transactions", "customer_id", "customers", "customer_id"),
    "orphaned_txns_account": ("transactions", "account_id", "accounts", "account_id"),
    "orphaned_txns_merchant": ("transactions", "merchant_id", "merchants", "merchant_id"),
    "orphaned_txns_device": ("transactions", "device_id", "devices", "device_id"),
    "orphaned_loans_customer": ("loans", "customer_id", "customers", "customer_id"),
    "orphaned_customer_devices": ("customer_devices", "customer_id", "customers", "customer_id"),
}


_TYPED_DIRTY = f"""SELECT * REPLACE (case when isfinite(try_cast(amount as double)) then try_cast(amount as double) end AS amount,
  try_cast(timestamp as timestamp) AS timestamp, cast(is_fraud as boolean) AS is_fraud, cast(latitude as double) AS latitude)
  FROM transactions_dirty"""
_CLEAN_DIRTY = f"""SELECT *, {_SEC} AS timestamp_sec FROM typed_dirty
  QUALIFY row_number() over (PARTITION BY transaction_id ORDER BY timestamp DESC NULLS LAST) = 1"""
_DIRTY_CTES = {"typed_dirty": _TYPED_DIRTY, "clean_dirty": _CLEAN_DIRTY}
# The checks see declared types, not yet without what is not finite.
_CHECKED = "(SELECT * REPLACE (try_cast(amount as double) AS amount, try_cast(timestamp as timestamp) AS timestamp) FROM transactions_dirty)"


def _checks(rows: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS \"check\", ({query}) AS violations" for name, query in rows.items())


def _orphan_sql(txns: str = "transactions") -> str:
    return _checks(
        {
            name: f"SELECT count(*) FROM {txns if a == 'transactions' else a} a LEFT JOIN {b} b ON a.{fk} = b.{pk}"
            f" WHERE a.{fk} IS NOT NULL AND b.{pk} IS NULL"
            for name, (a, fk, b, pk) in _ORPHANS.items()
        }
    )


def _null_sql(txns: str = "transactions") -> str:
    columns = {
        "null_customer_ids": ("customers", "customer_id"),
        "null_transaction_ids": (txns, "transaction_id"),
        "null_transaction_amounts": (txns, "amount"),
        "null_transaction_timestamps": (txns, "timestamp"),
        "null_device_ids": (txns, "device_id"),
        "null_ip_addresses": (txns, "ip_address"),
    }
    return _checks({n: f"SELECT count(*) FROM {t} WHERE {c} IS NULL" for n, (t, c) in columns.items()})


def _range_sql(txns: str = "transactions") -> str:
    return _checks(
        {
            "invalid_credit_scores": "SELECT count(*) FROM customers WHERE credit_score < 300 OR credit_score > 850",
            "negative_txn_amounts": f"SELECT count(*) FROM {txns} WHERE amount <= 0",
            "invalid_merchant_risk": "SELECT count(*) FROM merchants WHERE merchant_risk_score < 0 OR merchant_risk_score > 1",
            "negative_loan_amounts": "SELECT count(*) FROM loans WHERE loan_amount <= 0",
        }
    )


def _unique_sql(txns: str) -> str:
    keys = {
        "duplicate_customers": ("customers", "customer_id"),
        "duplicate_accounts": ("accounts", "account_id"),
        "duplicate_transactions": (txns, "transaction_id"),
        "duplicate_merchants": ("merchants", "merchant_id"),
        "duplicate_devices": ("devices", "device_id"),
    }
    return _checks({n: f"SELECT count({k}) - count(DISTINCT {k}) FROM {t}" for n, (t, k) in keys.items()})


def _report() -> str:
    groups = {
        "orphan_checks": _orphan_sql("transactions_raw"),
        "null_checks": _null_sql("transactions_raw"),
        "range_checks": _range_sql("transactions_raw"),
        "unique_checks": _unique_sql("transactions_raw"),
    }
    return " UNION ALL ".join(
        f"SELECT '{g}' AS check_group, \"check\", violations, violations = 0 AS passed FROM ({q})" for g, q in groups.items()
    )


def _dirty_report() -> str:
    delivered = "SELECT count(*) FROM transactions_dirty WHERE"
    number = "try_cast(amount as double)"
    amounts = {
        "unreadable_txn_amounts": f"{delivered} amount IS NOT NULL AND {number} IS NULL",
        "non_finite_txn_amounts": f"{delivered} NOT isfinite({number})",
        "over_precise_txn_amounts": f"{delivered} isfinite({number}) AND round({number}, 2) <> {number}",
    }
    groups = {
        "orphan_checks": _orphan_sql(_CHECKED),
        "null_checks": _null_sql(_CHECKED),
        "range_checks": _range_sql(_CHECKED),
        "unique_checks": _unique_sql(_CHECKED),
    }
    for table in ("customers", "accounts", "merchants", "devices", "loans", "customer_devices"):
        groups = {g: re.sub(rf"\b(FROM|JOIN) {table}\b", rf"\1 {table}_dirty", q) for g, q in groups.items()}
    groups["amount_checks"] = _checks(amounts)
    return " UNION ALL ".join(
        f"SELECT '{g}' AS check_group, \"check\", violations, violations = 0 AS passed FROM ({q})" for g, q in groups.items()
    )


_DIRTY_NAMES = {"customers", "accounts", "merchants", "devices", "loans", "customer_devices", "transactions"}


def _constraints() -> str:
    source = lambda n: _CHECKED if n == "transactions" else f"{n}_dirty" if n in _DIRTY_NAMES else n
    rows = []
    for name, t in TABLES.items():
        row = f"SELECT '{name}' AS table_name, '{{}}' AS \"constraint\", '{{}}' AS columns, ({{}}) AS violations".format
        for c in dict.fromkeys((*t.key, *t.required)):
            rows.append(row("not null", c, f"SELECT count(*) FROM {source(name)} s WHERE {c} IS NULL"))
        whole = " AND ".join(f"{c} IS NOT NULL" for c in t.key)
        rows.append(row("unique", ", ".join(t.key), f"SELECT count(*) - count(DISTINCT ({', '.join(t.key)},)) FROM {source(name)} s WHERE {whole}"))
        for c, parent in t.references:
            rows.append(row("foreign key", c, f"SELECT count(*) FROM {source(name)} s WHERE {c} IS NOT NULL AND {c} NOT IN"
                            f" (SELECT {TABLES[parent].key[0]} FROM {source(parent)} p WHERE {TABLES[parent].key[0]} IS NOT NULL)"))
    return " UNION ALL ".join(rows)


def _rejects() -> str:
    """Each table's rows with their reasons, referring to the sound rows of the tables before it."""
    ctes, parts = {}, []
    for name, t in TABLES.items():
        reasons = []
        if name == "transactions":
            reasons.append("case when amount is not null and not coalesce(isfinite(try_cast(amount as double)), false) then 'type amount' end")
            reasons.append("case when timestamp is not null and try_cast(timestamp as timestamp) is null then 'type timestamp' end")
        reasons += [f"case when {c} is null then 'null {c}' end" for c in dict.fromkeys((*t.key, *t.required))]
        for c, parent in t.references:
            reasons.append(f"case when {c} is not null and {c} not in (select {TABLES[parent].key[0]} from {parent}_judged where reasons = '') then 'foreign key {c}' end")
        key = f"concat_ws('|', {', '.join(t.key)})"
        source = f"{name}_dirty" if name in _DIRTY_NAMES else name
        ctes[f"{name}_judged"] = (
            f"SELECT {', '.join(t.key)}, {key} AS row_key,"
            f" array_to_string(list_sort([r for r in [{', '.join(reasons)}] if r is not null]), ',') AS reasons FROM {source}"
        )
        ctes[f"{name}_counted"] = f"SELECT '{name}' AS table_name, row_key, reasons, count(*) AS n FROM {name}_judged GROUP BY ALL"
        parts.append(f"SELECT table_name, row_key, reasons, case when reasons = '' then 1 else n end AS row_count FROM {name}_counted")
        parts.append(f"SELECT table_name, row_key, 'duplicate key', n - 1 FROM {name}_counted WHERE reasons = '' AND n > 1")
    return _sql(" UNION ALL ".join(parts), **ctes)


_NAMES = (
    "customers", "accounts", "merchants", "devices", "ip_addresses",
    "transactions", "customer_devices", "customer_ips", "loans",
)
_ROW_COUNTS = " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in _NAMES)

# Rules.
def _km(a1: str, o1: str, a2: str, o2: str) -> str:
    return (
        f"2*6371.0*asin(sqrt(least(1, pow(sin(radians({a2}-{a1})/2), 2)"
        f" + cos(radians({a1}))*cos(radians({a2}))*pow(sin(radians({o2}-{o1})/2), 2))))"
    )


_ORDER = "PARTITION BY customer_id ORDER BY timestamp, transaction_id"
_US = "epoch_us(timestamp)"
_SEQ = f"""SELECT *, row_number() over (PARTITION BY customer_id, device_id ORDER BY timestamp, transaction_id) AS use_no,
  lag({_US}, 3) over ({_ORDER}) AS us3, lag({_US}, 4) over ({_ORDER}) AS us4, lag({_US}) over ({_ORDER}) AS us1,
  lag(latitude) over ({_ORDER}) AS lat1, lag(longitude) over ({_ORDER}) AS lon1 FROM transactions"""
_BASE = f"""SELECT customer_id, {_MEAN} AS mean_amount, case when count(amount) > 1 then stddev_pop(amount) else 1 end AS std_amount
  FROM transactions GROUP BY customer_id"""
_RING = """SELECT merchant_id, epoch_us(timestamp) // 3600000000 AS bucket FROM transactions
  GROUP BY ALL HAVING count(distinct customer_id) >= 5"""
_FLAGS = f"""SELECT t.*, kd.customer_id IS NULL AND use_no = 1 AS new_device_fraud,
  coalesce(epoch_us(t.timestamp) - us3 < 60000000, false) AS velocity_attack,
  coalesce(epoch_us(t.timestamp) > us1 AND {_km('lat1', 'lon1', 't.latitude', 't.longitude')}
    / ((epoch_us(t.timestamp) - us1) / 3.6e9) > 900, false) AS impossible_travel,
  hour(t.timestamp) in (2, 3, 4) AND t.amount > 5000 AS unusual_hours,
  coalesce(coalesce(m.merchant_risk_score, t.merchant_risk_score) > 0.65 AND t.amount > 3*b.mean_amount, false) AS merchant_collusion,
  kd.customer_id IS NULL AND use_no = 1 AND t.amount > 5*b.mean_amount AS account_takeover,
  coalesce(dc.c, 1) > 3 AS device_sharing, coalesce(ic.c, 1) > 5 AS ip_sharing,
  b.std_amount > 0 AND (t.amount - b.mean_amount) / b.std_amount > 5 AS abnormal_spending,
  coalesce(epoch_us(t.timestamp) - us4 < 300000000, false) AS repeated_failures,
  t.payment_method = 'online' AND t.merchant_category in ('electronics', 'gambling', 'cryptocurrency') AS card_not_present,
  {_km('g.lat', 'g.lon', 't.latitude', 't.longitude')} > 3000 AS geo_anomaly,
  r.merchant_id IS NOT NULL AS coordinated_network
  FROM seq t LEFT JOIN customer_devices kd ON t.customer_id = kd.customer_id AND t.device_id = kd.device_id
  LEFT JOIN merchants m ON t.merchant_id = m.merchant_id LEFT JOIN base b ON t.customer_id = b.customer_id
  LEFT JOIN ({_customers_per('customer_devices', 'device_id')}) dc ON t.device_id = dc.device_id
  LEFT JOIN ({_customers_per('customer_ips', 'ip_address')}) ic ON t.ip_address = ic.ip_address
  LEFT JOIN customers cu ON t.customer_id = cu.customer_id LEFT JOIN geo g ON cu.city = g.city
  LEFT JOIN ring r ON t.merchant_id = r.merchant_id AND epoch_us(t.timestamp) // 3600000000 = r.bucket"""
_RULE_CTES = {"seq": _SEQ, "base": _BASE, "ring": _RING, "flags": _FLAGS}
# Rule order and probabilities.
_P = {
    "new_device_fraud": 0.18, "velocity_attack": 0.70, "impossible_travel": 0.85, "unusual_hours": 0.35,
    "merchant_collusion": 0.55, "account_takeover": 0.60, "device_sharing": 0.30, "ip_sharing": 0.25,
    "abnormal_spending": 0.45, "repeated_failures": 0.40, "card_not_present": 0.12, "geo_anomaly": 0.28,
    "coordinated_network": 0.30,
}
_FIRST = "case " + " ".join(f"when {r} then '{r}'" for r in _P) + " end AS first_match"
_NOISY_OR = "round(1 - " + "*".join(f"(1 - case when {r} then {p}e0 else 0e0 end)" for r, p in _P.items()) + ", 6)"

# Credit.
_PD = """least(greatest(0.08e0 * case when c.credit_score < 500 then 4e0 when c.credit_score < 580 then 2.5e0
    when c.credit_score < 670 then 1.5e0 when c.credit_score >= 750 then 0.4e0 else 1e0 end
  * case when l.debt_to_income > 0.5 then 3e0 when l.debt_to_income > 0.35 then 1.8e0 when l.debt_to_income < 0.15 then 0.6e0 else 1e0 end
  * case l.employment_status when 'unemployed' then 3.5e0 when 'student' then 2e0 when 'self-employed' then 1.4e0
    when 'retired' then 0.8e0 else 1e0 end * (1 + 0.5e0 * l.delinquency_history), 0.005e0), 0.9e0)"""
_SCORED = f"SELECT l.*, {_PD} AS pd FROM loans l LEFT JOIN customers c ON l.customer_id = c.customer_id"
_RATE = "(interest_rate / 12 / 100)"
_EMI = f"loan_amount * {_RATE} * pow(1 + {_RATE}, tenure_months) / (pow(1 + {_RATE}, tenure_months) - 1)"

# Graph: label propagation to the least customer reachable over shared entities.
_USAGE = """SELECT DISTINCT customer_id, 'device' AS kind, device_id AS entity FROM customer_devices
  UNION ALL SELECT DISTINCT customer_id, 'ip', ip_address FROM customer_ips"""
_EDGES = """SELECT hub, customer_id, count(*) FILTER (kind = 'device') AS shared_devices, count(*) FILTER (kind = 'ip') AS shared_ips
  FROM (SELECT *, min(customer_id) over (PARTITION BY kind, entity) AS hub FROM usage) WHERE hub <> customer_id GROUP BY ALL"""
_REACH = """SELECT DISTINCT customer_id, customer_id AS label FROM usage
  UNION SELECT e.b, r.label FROM reach r JOIN links e ON e.a = r.customer_id WHERE r.label < e.b"""
_LINKS = "SELECT hub AS a, customer_id AS b FROM edges UNION ALL SELECT customer_id, hub FROM edges"
_COMPONENTS = """SELECT customer_id, component_id, count(*) over (PARTITION BY component_id) AS component_size
  FROM (SELECT customer_id, min(label) AS component_id FROM reach GROUP BY customer_id)"""
_GRAPH_CTES = {"usage": _USAGE, "edges": _EDGES, "links": _LINKS, "reach": _REACH, "components": _COMPONENTS}

_SCORE_INPUT = f"""SELECT f.*, {_NOISY_OR} AS fraud_score, coalesce(w.credit_risk, 0e0) AS credit_risk,
  coalesce(dp.device_risk_score, 0e0) AS device_risk_score, coalesce(ipp.ip_risk_score, 0e0) AS ip_risk_score,
  coalesce(k.component_size, 1) AS size
  FROM flags f LEFT JOIN (SELECT customer_id, round(max(pd), 6) AS credit_risk FROM scored GROUP BY customer_id) w
    ON f.customer_id = w.customer_id
  LEFT JOIN device_profile dp ON f.device_id = dp.device_id LEFT JOIN ip_profile ipp ON f.ip_address = ipp.ip_address
  LEFT JOIN components k ON f.customer_id = k.customer_id"""
_RISK = """SELECT *, least(1e0, (size - 1) / 4e0) AS graph_risk,
  round(0.45e0*fraud_score + 0.25e0*credit_risk + 0.15e0*device_risk_score + 0.1e0*ip_risk_score
    + 0.05e0*least(1e0, (size - 1) / 4e0), 6) AS risk_score FROM score_input"""
_DECIDED = "SELECT *, case when risk_score >= 0.8 then 'BLOCK' when risk_score >= 0.4 then 'REVIEW' else 'APPROVE' end AS decision FROM risk"
_REASONS = (
    ", ".join(f"case when {r} then '{r}' end" for r in _P)
    + ", case when credit_risk >= 0.4 then 'CREDIT_RISK' end, case when device_risk_score >= 0.4 then 'DEVICE_RISK' end"
    + ", case when ip_risk_score >= 0.5 then 'IP_RISK' end, case when size >= 3 then 'RING' end"
)

# Volume and evaluation.
_DAILY = f"""SELECT d.day, coalesce(n, 0) AS txn_count, coalesce(total, 0e0) AS amount FROM
  (SELECT cast(unnest(generate_series(min(cast(timestamp as date)), max(cast(timestamp as date)), interval 1 day)) as date) AS day
   FROM transactions) d
  LEFT JOIN (SELECT cast(timestamp as date) AS day, count(*) AS n, {_SUM} AS total FROM transactions GROUP BY 1) v ON d.day = v.day"""
_FORECAST = """SELECT cast(l.d + h as varchar) AS day, y.txn_count, y.amount
  FROM (SELECT max(day) AS d FROM daily) l, (SELECT unnest(range(1, 31))::int AS h) s
  JOIN daily y ON y.day = l.d + s.h - 7 * ((s.h + 6) // 7)"""
_HIST = f"""SELECT round({_NOISY_OR}, 4) AS score, count(*) FILTER (is_fraud) AS pos, count(*) FILTER (NOT is_fraud) AS neg
  FROM flags GROUP BY 1"""
_CURVE = """SELECT *, sum(pos) over () AS p, sum(neg) over () AS n,
  coalesce(sum(neg) over (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below,
  sum(pos) over (ORDER BY score) AS pos_up, sum(neg) over (ORDER BY score) AS neg_up,
  sum(pos) over (ORDER BY score DESC) AS tp, sum(neg) over (ORDER BY score DESC) AS fp FROM hist"""
_METRICS = """SELECT cast(max(p) as bigint) AS positives, cast(max(n) as bigint) AS negatives,
  round(sum(pos * (neg_below + neg / 2e0)) / (max(p) * max(n)), 6) AS roc_auc,
  round(sum(cast(pos as double) / p * (cast(tp as double) / (tp + fp))), 6) AS pr_auc,
  round(max(abs(cast(pos_up as double) / p - cast(neg_up as double) / n)), 6) AS ks FROM curve"""

# Streams: one batch, so the final watermark is the latest event less one hour; windows, sessions
# and buffered rows that it has not passed stay in state.
_MARK = "(SELECT epoch_us(max(timestamp)) // 1000 - 3600000 FROM transactions)"
_STREAM_COLUMNS = f"count(*) AS txn_count, {_SUM} AS spend"
_TUMBLING = f"""SELECT window_start, window_start + interval 1 hour AS window_end, customer_id, {_STREAM_COLUMNS}
  FROM (SELECT *, time_bucket(interval 1 hour, timestamp) AS window_start FROM transactions)
  GROUP BY ALL HAVING epoch_us(window_end) // 1000 <= {_MARK}"""
_SLIDING = f"""SELECT window_start, window_start + interval 1 hour AS window_end, customer_id, {_STREAM_COLUMNS}
  FROM (SELECT *, time_bucket(interval 5 minutes, timestamp) - s * interval 5 minutes AS window_start
        FROM transactions, (SELECT unnest(range(0, 12)) AS s)) GROUP BY ALL HAVING epoch_us(window_end) // 1000 <= {_MARK}"""
_SESSIONS = f"""SELECT min(timestamp) AS window_start, max(timestamp) + interval 30 minutes AS window_end, customer_id, {_STREAM_COLUMNS}
  FROM (SELECT *, sum(opens) over ({_ORDER}) AS session_no FROM
    (SELECT *, case when timestamp - lag(timestamp) over ({_ORDER}) < interval 30 minutes then 0 else 1 end AS opens FROM transactions))
  GROUP BY customer_id, session_no HAVING epoch_us(max(timestamp) + interval 30 minutes) // 1000 <= {_MARK}"""
_PASSED = f"({_SEC} + 1) * 1000 <= {_MARK}"


def _stream_new(column: str) -> str:
    return f"row_number() over (PARTITION BY customer_id, {column} ORDER BY timestamp, transaction_id) = 1"


def _rule(name: str) -> str:
    return _sql(f"SELECT transaction_id, customer_id, {name} AS hit FROM flags", **_RULE_CTES)


def _usage_stats(key: str, kind: str) -> str:
    return f"""SELECT '{kind}' AS entity_type, {key} AS entity_id, min(timestamp) AS first_seen, max(timestamp) AS last_seen,
      count(*) AS transaction_count, count(*) FILTER (is_fraud) AS fraud_count, count(distinct customer_id) AS customer_count
      FROM transactions GROUP BY {key}"""


_NUMBER = "cast(substr(transaction_id, 4) as bigint)"
_DELIVERED = f"""SELECT transaction_id, customer_id, amount, case when {_NUMBER} % 31 <> 0 then timestamp end AS timestamp,
  least((epoch_us(timestamp) - low) * 4 // (high - low + 1) + case when {_NUMBER} % 29 = 0 then 2 when {_NUMBER} % 17 = 0 then 1 else 0 end, 3) AS batch
  FROM transactions, (SELECT min(epoch_us(timestamp)) AS low, max(epoch_us(timestamp)) AS high FROM transactions)"""
_JUDGED = """SELECT d.*, case when d.timestamp is null then 'no time' when d.timestamp < (SELECT max(e.timestamp) FROM
  (SELECT batch, max(timestamp) AS timestamp FROM delivered GROUP BY batch) e WHERE e.batch < d.batch) - interval 1 hour then 'late' else 'in time' end AS reason
  FROM delivered d"""
_ADMITTED = "SELECT * FROM judged WHERE reason = 'in time'"
_GATE_CTES = {"delivered": _DELIVERED, "judged": _JUDGED, "admitted": _ADMITTED}

def _risk_as_of(key: str, risk: str) -> str:
    """The latest published version before the row decides; an entity that it lacks keeps the one before."""
    counted = f"SELECT {key}, since, count(distinct customer_id) AS customers FROM transactions, since WHERE timestamp < since GROUP BY {key}, since"
    return (
        f"SELECT transaction_id, {risk.replace('{}', 'customers')} AS risk FROM transactions t JOIN ({counted}) v"
        f" ON v.{key} = t.{key} AND v.since <= t.timestamp QUALIFY row_number() over (PARTITION BY transaction_id ORDER BY since DESC) = 1"
    )


ORACLE: dict[str, str] = {
    "velocity_1h": _velocity(_W[0]),
    "velocity_24h": _velocity(_W[1]),
    "velocity_7d": _velocity(_W[2]),
    "velocity_1m_5m": _sql(
        f"SELECT transaction_id, customer_id, {_frames(('1m', 60), ('5m', 300))[0]} FROM transactions WINDOW {_frames(('1m', 60), ('5m', 300))[1]}"
    ),
    "velocity_dirty": _sql(
        f"SELECT transaction_id, customer_id, amount, {_ALL_COLUMNS}, {_GAP} FROM clean_dirty WINDOW {_ALL_WINDOWS}", **_DIRTY_CTES
    ),
    "clean_transactions_dirty": _sql("SELECT * FROM clean_dirty", **_DIRTY_CTES),
    "csv_credit_features": _sql(_CREDIT, summary=_SUMMARY),
    "customer_ip_map": _sql(
        "SELECT customer_id, ip_address, min(timestamp) AS first_used, max(timestamp) AS last_used, count(*) AS use_count"
        " FROM transactions GROUP BY customer_id, ip_address"
    ),
    "dq_report_dirty": _sql(_dirty_report()),
    "dq_constraints": _sql(_constraints()),
    "load_with_rejects": _rejects(),
    "fraud_rule_flags_legacy": _sql(
        "SELECT transaction_id, customer_id, case when new_device_fraud then 'new_device_fraud' when velocity_attack then"
        " 'velocity_attack' when coordinated_network then 'coordinated_network' end AS first_match FROM flags",
        **_RULE_CTES,
    ),
    "stream_new_ip": _sql(
        f"""SELECT * FROM (SELECT customer_id, transaction_id, ip_address, {_stream_new('ip_address')} AS is_new_ip
        FROM transactions WHERE {_PASSED})"""
    ),
    "decision_single_signal": _sql(
        """SELECT transaction_id, customer_id, fraud_score, credit_risk, risk_score,
        case when risk_score >= 0.8 OR fraud_score >= 0.8 OR credit_risk >= 0.7 then 'BLOCK'
          when risk_score >= 0.4 OR fraud_score >= 0.4 OR credit_risk >= 0.4 then 'REVIEW' else 'APPROVE' end AS decision FROM risk""",
        **_RULE_CTES,
        **_GRAPH_CTES,
        scored=_SCORED,
        device_profile=_DEVICE_PROFILE,
        ip_profile=_IP_PROFILE,
        score_input=_SCORE_INPUT,
        risk=_RISK,
    ),
    "shared_entity_pairs": _sql(
        """SELECT a.customer_id AS a, b.customer_id AS b, count(*) FILTER (a.kind = 'device') AS shared_devices,
          count(*) FILTER (a.kind = 'ip') AS shared_ips
        FROM sized a JOIN sized b ON a.kind = b.kind AND a.entity = b.entity AND a.customer_id < b.customer_id AND a.n <= 50 GROUP BY ALL""",
        usage=_USAGE,
        sized="SELECT *, count(*) over (PARTITION BY kind, entity) AS n FROM usage",
    ),
    # No entity of the test tables has more customers than are counted exactly.
    "customer_neighbours": _sql(
        """SELECT a.customer_id, count(DISTINCT b.customer_id) - 1 AS neighbours, true AS is_exact
        FROM usage a JOIN usage b ON a.kind = b.kind AND a.entity = b.entity GROUP BY a.customer_id""",
        usage=_USAGE,
    ),
    "customer_degrees": _sql(
        """SELECT customer_id, count(*) FILTER (n > 1) AS shared_entities, cast(sum(n - 1) as bigint) AS co_users
        FROM (SELECT *, count(*) over (PARTITION BY kind, entity) AS n FROM usage) GROUP BY customer_id""",
        usage=_USAGE,
    ),
    "txn_gap": _sql(f"SELECT transaction_id, customer_id, {_GAP} FROM transactions"),
    "velocity_features": _sql(
        f"SELECT transaction_id, customer_id, amount, timestamp_sec, seconds_since_last_txn,"
        " txns_last_1h, spend_last_1h, txns_last_24h, spend_last_24h, txns_last_7d, spend_last_7d FROM velocity",
        velocity=_VELOCITY,
    ),
    "clean_transactions": _sql(f"SELECT *, {_SEC} AS timestamp_sec FROM transactions"),
    "clean_customers": _sql("SELECT * REPLACE (cast(customer_since as varchar) AS customer_since) FROM customers"),
    "clean_devices": _sql("SELECT * FROM devices"),
    "clean_ips": _sql("SELECT * FROM ip_addresses"),
    "clean_loans": _sql("SELECT * REPLACE (cast(loan_start_date as varchar) AS loan_start_date) FROM loans"),
    "load_normalise_loans": _sql(
        "SELECT * REPLACE (cast(loan_start_date as varchar) AS loan_start_date),"
        " cast(year(loan_start_date) as int) AS start_year FROM loans"
    ),
    "sink_roundtrip": _sql(
        " UNION ALL ".join(
            f"SELECT '{n}_features' AS dataset, customer_id, count(*) AS row_count, true AS same_columns FROM {t} GROUP BY customer_id"
            for n, t in (("fraud", "transactions"), ("credit", "loans"), ("customer", "customers"))
        )
    ),
    "pseudonymise_device": _sql("SELECT * REPLACE (left(sha256(device_id), 40) AS device_id) FROM devices"),
    "device_customer_count": _sql(
        "SELECT device_id, count(distinct customer_id) AS device_customer_count FROM customer_devices GROUP BY device_id"
    ),
    "ip_customer_count": _sql(
        "SELECT ip_address, count(distinct customer_id) AS ip_customer_count FROM customer_ips GROUP BY ip_address"
    ),
    "device_features": _sql(
        f"SELECT t.transaction_id, t.customer_id, t.device_id, {_DEVICE_COLS} FROM transactions t {_DEVICE_JOIN}",
        device_profile=_DEVICE_PROFILE,
    ),
    "ip_features": _sql(
        f"SELECT t.transaction_id, t.customer_id, t.ip_address, {_IP_COLS} FROM transactions t {_IP_JOIN}",
        ip_profile=_IP_PROFILE,
    ),
    "entity_stats_refresh": _sql(_usage_stats("device_id", "device") + " UNION ALL " + _usage_stats("ip_address", "ip")),
    "entity_stats_incremental": _sql(_usage_stats("device_id", "device") + " UNION ALL " + _usage_stats("ip_address", "ip")),
    "customer_device_map": _sql(
        "SELECT customer_id, device_id, min(timestamp) AS first_used, max(timestamp) AS last_used, count(*) AS use_count"
        " FROM transactions GROUP BY customer_id, device_id"
    ),
    "check_new_device": _sql(
        "SELECT r.customer_id, r.device_id, cd.customer_id IS NULL AS is_new_device,"
        " coalesce(cd.use_count, 0) AS previous_use_count, cd.first_used AS first_used_timestamp"
        " FROM (SELECT DISTINCT customer_id, device_id FROM transactions) r"
        " LEFT JOIN customer_devices cd ON r.customer_id = cd.customer_id AND r.device_id = cd.device_id"
    ),
    "customer_amount_percentiles": _sql(
        "SELECT customer_id, count(c) AS amounts, "
        + ", ".join(f"round(quantile_cont(c, {p / 100}) / 100, 6) AS p{p}" for p in (25, 50, 75, 90, 99))
        + " FROM (SELECT customer_id, cast(round(amount * 100) as bigint) AS c FROM transactions) WHERE c IS NOT NULL GROUP BY customer_id"
    ),
    "customer_amount_stats": _sql(
        "SELECT * REPLACE (round(cust_avg_amount, 6) AS cust_avg_amount, round(cust_std_amount, 6) AS cust_std_amount) FROM stats",
        stats=_STATS,
    ),
    "customer_txn_summary": _sql(
        "SELECT * REPLACE (round(hist_avg_txn_amount, 6) AS hist_avg_txn_amount) FROM summary", summary=_SUMMARY
    ),
    "behavioral_features": _sql(
        f"SELECT t.transaction_id, {_MERCHANT_RISK}, {_BEHAVIOR} FROM transactions t {_BEHAVIOR_JOIN}", stats=_STATS
    ),
    "fraud_features": _sql(_FRAUD, **_FRAUD_CTES),
    "fraud_features_as_of": _sql(_AS_OF, **_AS_OF_CTES),
    "credit_features": _sql(_CREDIT, summary=_SUMMARY),
    "customer_features": _sql(_CUSTOMER, summary=_SUMMARY),
    "feature_summary": _sql(
        """SELECT count(*) AS total_txns, count(*) FILTER (is_new_device) AS new_device_txns,
        round(count(*) FILTER (is_new_device) * 100e0 / count(*), 6) AS new_device_pct,
        count(*) FILTER (is_new_ip) AS new_ip_txns, round(count(*) FILTER (is_new_ip) * 100e0 / count(*), 6) AS new_ip_pct,
        count(*) FILTER (is_fraud) AS fraud_txns, round(count(*) FILTER (is_fraud) * 100e0 / count(*), 6) AS fraud_pct FROM fraud""",
        **_FRAUD_CTES,
        fraud=_FRAUD,
    ),
    "new_entity_sample": _sql(
        """SELECT transaction_id, customer_id, device_id, ip_address, is_new_device, device_risk_score, is_new_ip, ip_risk_score,
        txns_last_1h, spend_last_24h, amount_z_score, is_fraud FROM fraud
        WHERE is_new_device OR is_new_ip ORDER BY transaction_id LIMIT 8""",
        **_FRAUD_CTES,
        fraud=_FRAUD,
    ),
    "v_customer_features": _sql(
        f"""SELECT c.customer_id, c.age, c.gender, c.income, c.employment_status, c.city, c.state, c.credit_score, c.risk_profile,
        n AS total_transactions, coalesce(total, 0e0) AS total_spend, round(coalesce(mean, 0e0), 6) AS avg_transaction_amount,
        round(coalesce(dev, 0e0), 6) AS stddev_transaction_amount, coalesce(largest, 0e0) AS max_transaction_amount,
        last_at AS last_transaction_timestamp, devices_used AS unique_devices_used, ips_used AS unique_ips_used,
        merchants_used AS unique_merchants_visited, frauds AS fraud_transaction_count, {_rate('frauds', 'n')} AS customer_fraud_rate
        FROM customers c JOIN activity a ON c.customer_id = a.customer_id""",
        activity=_V_ACTIVITY,
    ),
    "v_device_intelligence": _sql(_V_DEVICE),
    "v_ip_intelligence": _sql(_V_IP),
    "v_new_device_detection": _sql("SELECT * FROM detection", **_DETECTION_CTES),
    "v_transaction_velocity": _sql(
        f"""SELECT transaction_id, customer_id, timestamp, amount, count(*) over h - 1 AS txns_last_1_hour,
        cast(sum({_MONEY}) over h as double) AS spend_last_1_hour, count(*) over d - 1 AS txns_last_24_hours,
        cast(sum({_MONEY}) over d as double) AS spend_last_24_hours FROM transactions
        WINDOW h AS {_EXACT.format('1 hour')}, d AS {_EXACT.format('24 hours')}"""
    ),
    "v_customer_transaction_summary": _sql(
        """SELECT customer_id, n AS total_transactions, total AS total_spend, round(mean, 6) AS avg_transaction_amount,
        round(dev, 6) AS stddev_amount, last_at AS last_transaction_date, first_at AS first_transaction_date,
        devices_used AS unique_devices, ips_used AS unique_ips, merchants_used AS unique_merchants,
        frauds AS fraud_transaction_count FROM activity""",
        activity=_V_ACTIVITY,
    ),
    "v_device_risk": _sql(
        f"""SELECT d.device_id, d.device_type, d.operating_system, count(distinct cd.customer_id) AS customer_count,
        d.transaction_count, d.fraud_count, {_rate('d.fraud_count', 'd.transaction_count')} AS fraud_rate,
        round((epoch_us((SELECT max(timestamp) FROM transactions)) - epoch_us(d.first_seen)) / 86400e6, 6) AS device_age_days
        FROM devices d LEFT JOIN customer_devices cd ON d.device_id = cd.device_id
        GROUP BY d.device_id, d.device_type, d.operating_system, d.transaction_count, d.fraud_count, d.first_seen"""
    ),
    "v_high_risk_customers": _sql(
        f"""SELECT c.customer_id, c.risk_profile, c.credit_score, n AS total_transactions, frauds AS fraud_transaction_count,
        devices_used AS unique_devices, {_rate('frauds', 'n')} AS fraud_rate
        FROM customers c JOIN activity a ON c.customer_id = a.customer_id
        WHERE c.risk_profile = 'high' OR frauds > 0 OR c.credit_score < 550""",
        activity=_V_ACTIVITY,
    ),
    "new_device_summary": _sql(
        """SELECT count(*) AS total_transactions, count(*) FILTER (is_new_device) AS new_device_count,
        (20000*count(*) FILTER (is_new_device) + count(*)) // (2*count(*)) / 1e2 AS new_device_pct,
        count(*) FILTER (is_new_device AND is_fraud) AS new_device_fraud_count FROM detection""",
        **_DETECTION_CTES,
    ),
    "new_device_sample": _sql(
        """SELECT transaction_id, customer_id, device_id, is_new_device, customer_device_use_count, device_risk_score, is_fraud,
        fraud_scenario FROM detection WHERE is_new_device ORDER BY transaction_id LIMIT 10""",
        **_DETECTION_CTES,
    ),
    "table_row_counts": _sql(_ROW_COUNTS),
    "dq_orphans": _sql(_orphan_sql()),
    "dq_nulls": _sql(_null_sql()),
    "dq_ranges": _sql(_range_sql()),
    "dq_duplicates": _sql(_unique_sql("transactions_raw")),
    "dq_report": _sql(_report()),
    "pit_new_device": _sql(
        """SELECT t.transaction_id, t.customer_id, t.device_id, use_no = 1 AS is_first_use,
        use_no = 1 AND kd.customer_id IS NULL AS is_new_now FROM seq t
        LEFT JOIN customer_devices kd ON t.customer_id = kd.customer_id AND t.device_id = kd.device_id""",
        seq=_SEQ,
    ),
    "rule_new_device": _rule("new_device_fraud"),
    **{f"rule_{name}": _rule(name) for name in _P if name != "new_device_fraud"},
    "fraud_rule_flags": _sql(
        f"SELECT transaction_id, customer_id, {', '.join(_P)}, {_FIRST} FROM flags", **_RULE_CTES
    ),
    "fraud_scenario_counts": _sql(
        " UNION ALL ".join(
            f"SELECT '{r}' AS scenario, count(*) FILTER ({r}) AS hit_count,"
            f" count(*) FILTER (first_match = '{r}') AS labelled_count FROM labelled"
            for r in _P
        ),
        **_RULE_CTES,
        labelled=f"SELECT *, {_FIRST} FROM flags",
    ),
    "customer_risk_tier": _sql(
        "SELECT customer_id, credit_score, case when credit_score >= 720 then 'low' when credit_score >= 600 then 'medium'"
        " else 'high' end AS risk_tier FROM customers"
    ),
    "loan_emi_dti": _sql(
        f"""SELECT l.loan_id, l.customer_id, round({_EMI}, 4) AS emi, round(c.income / 12, 2) AS monthly_income,
        round({_EMI} / greatest(round(c.income / 12, 2), 1), 4) AS debt_to_income
        FROM loans l LEFT JOIN customers c ON l.customer_id = c.customer_id"""
    ),
    "loan_default_score": _sql("SELECT loan_id, customer_id, round(pd, 6) AS default_probability FROM scored", scored=_SCORED),
    "stream_tumbling_1h": _sql(_TUMBLING),
    "stream_sliding_1h_5m": _sql(_SLIDING),
    "stream_sessions": _sql(_SESSIONS),
    "stream_velocity": _sql(
        f"""SELECT customer_id, transaction_id, txns_last_1h, spend_last_1h, txns_last_24h, spend_last_24h, txns_last_7d, spend_last_7d,
        seconds_since_last_txn FROM velocity WHERE {_PASSED}""",
        velocity=_VELOCITY,
    ),
    "stream_new_device": _sql(
        f"""SELECT * FROM (SELECT customer_id, transaction_id, device_id, {_stream_new('device_id')} AS is_new_device
        FROM transactions WHERE {_PASSED})"""
    ),
    "entity_customers_sketched": _sql(
        " UNION ALL ".join(
            f"SELECT '{kind}' AS entity_type, {key} AS entity_id, count(distinct customer_id) AS customers, true AS within_bound FROM transactions"
            f" WHERE cast(timestamp as date) >= (SELECT cast(max(timestamp) as date) - 29 FROM transactions) GROUP BY {key}"
            for kind, key in (("device", "device_id"), ("ip", "ip_address"))
        )
    ),
    "customer_distincts_sketched": _sql(
        "SELECT customer_id, count(distinct device_id) AS devices, count(distinct ip_address) AS ips, count(distinct merchant_id) AS merchants,"
        " true AS within_bound FROM transactions GROUP BY customer_id"
    ),
    "stream_enrich_versions": _sql(
        """SELECT transaction_id, customer_id, device_id, ip_address, coalesce(d.risk, 0.05e0) AS device_risk_score, coalesce(i.risk, 0.05e0) AS ip_risk_score
        FROM transactions LEFT JOIN device_then d USING (transaction_id) LEFT JOIN ip_then i USING (transaction_id)""",
        since="""SELECT make_timestamp(low + (high - low) * k // 3) AS since FROM
        (SELECT min(epoch_us(timestamp)) AS low, max(epoch_us(timestamp)) AS high FROM transactions), (SELECT unnest([1, 2]) AS k)""",
        device_then=_risk_as_of("device_id", _DEV_RISK),
        ip_then=_risk_as_of("ip_address", _IP_RISK),
    ),
    "stream_late_rows": _sql("SELECT transaction_id, cast(batch as bigint) AS batch, reason FROM judged", **_GATE_CTES),
    "stream_late_velocity": _sql(
        f"""SELECT customer_id, transaction_id, txns_last_1h, spend_last_1h, txns_last_24h, spend_last_24h, txns_last_7d, spend_last_7d,
        seconds_since_last_txn FROM velocity WHERE ({_SEC} + 1) * 1000 <= (SELECT epoch_us(max(timestamp)) // 1000 - 3600000 FROM admitted)""",
        **_GATE_CTES,
        velocity=_VELOCITY.replace("FROM transactions", "FROM admitted"),
    ),
    "stream_enrich": _sql(
        "SELECT transaction_id, customer_id, device_id, ip_address, amount, device_risk_score, ip_risk_score FROM detection",
        **_DETECTION_CTES,
    ),
    "stream_dedup": _sql("SELECT transaction_id, customer_id, amount, timestamp FROM transactions"),
    "fraud_rule_score": _sql(f"SELECT transaction_id, customer_id, {_NOISY_OR} AS fraud_score FROM flags", **_RULE_CTES),
    "expected_loss": _sql(
        """SELECT loan_id, customer_id, round(pd, 6) AS default_probability,
        case when loan_status = 'paid_off' then 0e0 else loan_amount end AS exposure_at_default,
        cast(round(cast(pd * 0.45e0 * case when loan_status = 'paid_off' then 0e0 else loan_amount end as decimal(28,8)), 2) as double)
        AS expected_loss FROM scored""",
        scored=_SCORED,
    ),
    "decision_engine": _sql(
        f"""SELECT transaction_id, customer_id, fraud_score, credit_risk, device_risk_score, ip_risk_score, graph_risk, risk_score,
        decision, case when decision = 'APPROVE' then '' else concat_ws(',', {_REASONS}) end AS reason_codes FROM decided""",
        **_RULE_CTES,
        **_GRAPH_CTES,
        scored=_SCORED,
        device_profile=_DEVICE_PROFILE,
        ip_profile=_IP_PROFILE,
        score_input=_SCORE_INPUT,
        risk=_RISK,
        decided=_DECIDED,
    ),
    "shared_entity_edges": _sql("SELECT hub, customer_id, shared_devices, shared_ips FROM edges", usage=_USAGE, edges=_EDGES),
    "customer_components": _sql("SELECT * FROM components", **_GRAPH_CTES),
    "daily_volume": _sql("SELECT * REPLACE (cast(day as varchar) AS day) FROM daily", daily=_DAILY),
    "volume_forecast": _sql(_FORECAST, daily=_DAILY),
    "score_ks_auc": _sql(_METRICS, **_RULE_CTES, hist=_HIST, curve=_CURVE),
}
