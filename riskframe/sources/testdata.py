"""Banking tables as projections of the supplied star schema and event log.

One column list serves both engines: :class:`TestBank` turns it into DataFrames, and
:func:`duckdb_ctes` into the CTE prefix of the check queries. ``US(x)`` (timestamp to
microseconds) and ``TS(x)`` (back) are the only spellings that differ.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.streaming.io import file_stream

# Declared, so that building a plan reads no file footers.
RAW_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
}

_CATEGORIES = (
    "bakery,books,cinema,garden,hardware,music,parking,electronics,pharmacy,shoes,"
    "gambling,cryptocurrency,toys,water"
)
_CUSTOMER_ID = "concat('CUST', lpad(cast({} as string), 7, '0'))"
_SCORE = "300 + (c_custkey*131)%551"
_USAGE = {"first_used": "min(timestamp)", "last_used": "max(timestamp)", "use_count": "cast(count(*) as int)"}
_ACTIVITY = {
    "first_seen": "min(timestamp)",
    "last_seen": "max(timestamp)",
    "transaction_count": "cast(count(*) as int)",
    "fraud_count": "cast(sum(case when is_fraud then 1 else 0 end) as int)",
}


@dataclass(frozen=True)
class Projection:
    source: str
    columns: dict[str, str]
    where: str | None = None
    group_by: tuple[str, ...] = ()


SPEC: dict[str, Projection] = {
    "geo": Projection(
        "nation join region on n_regionkey = r_regionkey",
        {
            "k": "n_nationkey",
            "city": "n_name",
            "state": "r_name",
            "lat": "cast(-60 + 5*n_nationkey as double)",
            "lon": "cast(-170 + 14*n_nationkey as double)",
        },
    ),
    "customers": Projection(
        "customer join geo on c_nationkey = k",
        {
            "customer_id": _CUSTOMER_ID.format("c_custkey"),
            "age": "cast(18 + (c_custkey*37)%63 as int)",
            "gender": "case when c_custkey%50=0 then 'Other' when c_custkey%2=0 then 'M' else 'F' end",
            "income": "cast(15000 + (c_custkey*7919)%485000 as double)",
            "employment_status": "split_part('employed,self-employed,unemployed,retired,student', ',',"
            " cast(c_custkey%5 as int)+1)",
            "city": "city",
            "state": "state",
            "customer_since": "date '2005-01-01' + cast((c_custkey*13)%7000 as int)",
            "credit_score": f"cast({_SCORE} as int)",
            "risk_profile": f"case when {_SCORE} >= 720 then 'low' when {_SCORE} >= 600 then 'medium' else 'high' end",
        },
    ),
    "accounts": Projection(
        "PAIRED",
        {
            "account_id": "concat('ACC', lpad(cast(c_custkey*2+j as string), 8, '0'))",
            "customer_id": _CUSTOMER_ID.format("c_custkey"),
            "account_type": "split_part('savings,current,credit,fixed_deposit,loan', ',',"
            " cast((c_custkey+j)%5 as int)+1)",
            "balance": "c_acctbal",
            "account_open_date": "date '2010-01-01' + cast((c_custkey*17)%5000 as int)",
            "status": "split_part('active,active,active,active,inactive,frozen,closed', ',',"
            " cast(c_custkey%7 as int)+1)",
        },
    ),
    "merchants": Projection(
        "supplier join geo on s_nationkey = k",
        {
            "merchant_id": "concat('MERCH', lpad(cast(s_suppkey as string), 6, '0'))",
            "merchant_name": "s_name",
            "merchant_category": f"split_part('{_CATEGORIES}', ',', cast(s_suppkey%14 as int)+1)",
            "city": "city",
            "state": "state",
            "latitude": "lat",
            "longitude": "lon",
            "merchant_risk_score": "cast((s_suppkey*7919)%9900+100 as double)/1e4",
        },
    ),
    # One user in seven has time compressed 600-fold, so the minute-level rules fire.
    "ev": Projection(
        "events join customer on user_id = c_custkey",
        {
            "event_id": "event_id",
            "user_id": "user_id",
            "event_type": "event_type",
            "value": "value",
            "n": "cast(regexp_extract(props, '([0-9]+)', 1) as bigint)",
            "us": "case when user_id%7=3 then 1704067200000000 +"
            " cast(floor((US(ts)-1704067200000000)/600) as bigint) else US(ts) end",
            "own_dev": "user_id - user_id%(1+cast(floor(user_id/10) as bigint)%5)",
            "own_ip": "(user_id - user_id%(1+cast(floor(user_id/8) as bigint)%8))*2 + event_id%2",
            "home": "c_nationkey",
        },
    ),
    "transactions": Projection(
        "ev join geo on k = case when n%20=0 then event_id%25 else home end",
        {
            "transaction_id": "concat('TXN', lpad(cast(event_id as string), 9, '0'))",
            "customer_id": _CUSTOMER_ID.format("user_id"),
            "account_id": "concat('ACC', lpad(cast(user_id*2+event_id%2 as string), 8, '0'))",
            "merchant_id": "concat('MERCH', lpad(cast((event_id*31+n)%105 as string), 6, '0'))",
            "device_id": "concat('DEV', lpad(cast(case when n<90 then own_dev*3+n%3 else 9000000+event_id%20 end"
            " as string), 7, '0'))",
            "ip_address": "case when n between 80 and 84 then concat('203.0.113.', cast(event_id%40 as string))"
            " else concat('10.', cast(cast(floor(own_ip/65536) as bigint) as string), '.',"
            " cast(cast(floor(own_ip/256) as bigint)%256 as string), '.', cast(own_ip%256 as string)) end",
            "amount": "round(value*100, 2)",
            "timestamp": "TS(us)",
            "transaction_type": "split_part('sale,cash,giro,bill,return', ',',"
            " cast(event_id%5 as int)+1)",
            "merchant_category": f"split_part('{_CATEGORIES}', ',', cast(((event_id*31+n)%105)%14 as int)+1)",
            "merchant_risk_score": "case when event_id%2=0 then 2e-1 end",
            "city": "case when n=99 then null else city end",
            "state": "state",
            "latitude": "lat",
            "longitude": "lon",
            "payment_method": "case event_type when 'click' then 'online' when 'view' then 'mobile_payment'"
            " when 'purchase' then 'credit_card' when 'signup' then 'debit_card' else 'bank_transfer' end",
            "is_fraud": "event_type='error' and value>100",
            "fraud_scenario": "case when event_type='error' and value>100 then 'error_high_value' end",
        },
    ),
    "customer_devices": Projection(
        "transactions",
        {"customer_id": "customer_id", "device_id": "device_id", **_USAGE},
        where="device_id < 'DEV9000000'",
        group_by=("customer_id", "device_id"),
    ),
    "devices": Projection(
        "transactions",
        {
            "device_id": "device_id",
            "device_type": "split_part('mobile,desktop,tablet', ',', cast(substr(device_id,4) as int)%3+1)",
            "operating_system": "split_part('iOS,Android,Windows,macOS,Linux', ',',"
            " cast(substr(device_id,4) as int)%5+1)",
            **_ACTIVITY,
        },
        where="device_id < 'DEV9000015'",
        group_by=("device_id",),
    ),
    "customer_ips": Projection(
        "transactions",
        {"customer_id": "customer_id", "ip_address": "ip_address", **_USAGE},
        where="ip_address not like '203.%'",
        group_by=("customer_id", "ip_address"),
    ),
    "ip_addresses": Projection(
        "transactions",
        {
            "ip_address": "ip_address",
            **_ACTIVITY,
            "customer_count": "cast(count(distinct customer_id) as int)",
        },
        where="ip_address not like '203.0.113.3_'",
        group_by=("ip_address",),
    ),
    "loans": Projection(
        "orders join customers on customer_id = concat('CUST', lpad(cast(o_custkey as string), 7, '0'))",
        {
            "loan_id": "concat('LOAN', lpad(cast(o_orderkey as string), 8, '0'))",
            "customer_id": "customer_id",
            "loan_amount": "o_totalprice",
            "interest_rate": "cast(35 + o_orderkey%246 as double)/1e1",
            "tenure_months": "cast(split_part('12,24,36,48,60,84,120', ',', cast(o_orderkey%7 as int)+1) as int)",
            "monthly_income": "case when o_orderkey%97=0 then 0e0 else round(income/12, 2) end",
            "debt_to_income": "round(o_totalprice/(income*5), 4)",
            "employment_status": "employment_status",
            "delinquency_history": "cast((o_orderkey*7)%6 as int)",
            "loan_status": "case o_orderstatus when 'F' then 'defaulted' when 'O' then 'active' else 'paid_off' end",
            "default_flag": "o_orderstatus='F'",
            "loan_start_date": "cast(o_orderdate as date)",
        },
    ),
}

# Dirty variants: number in the id, changed columns (``ISO`` stands for time as text), rows kept, rows repeated.
@dataclass(frozen=True)
class Dirt:
    table: str
    number: str
    changed: dict[str, str]
    kept: str = "true"
    repeated: str | None = None
    copy: dict[str, str] | None = None


def _number(column: str, skipped: int) -> str:
    return f"cast(substr({column}, {skipped + 1}) as bigint)"


DIRTY: dict[str, Dirt] = {
    "customers_dirty": Dirt(
        "customers",
        _number("customer_id", 4),
        {
            "customer_id": "case when x%97=0 then null else customer_id end",
            "credit_score": "case when x%89=0 then 200 else credit_score end",
            "age": "case when x%71=0 then null else age end",
        },
        kept="x%83<>0",
        repeated="x%50=0",
    ),
    "accounts_dirty": Dirt("accounts", _number("account_id", 3), {}, kept="x%79<>0", repeated="x%50=0"),
    "merchants_dirty": Dirt(
        "merchants",
        _number("merchant_id", 5),
        {"merchant_risk_score": "case when x%7=0 then 15e-1 else merchant_risk_score end"},
        repeated="x%50=0",
    ),
    "devices_dirty": Dirt("devices", _number("device_id", 3), {}, kept="x%73<>0", repeated="x%50=0"),
    "loans_dirty": Dirt(
        "loans",
        _number("loan_id", 4),
        {"loan_amount": "case when x%71=0 then -loan_amount else loan_amount end"},
        repeated="x%50=0",
    ),
    "customer_devices_dirty": Dirt("customer_devices", _number("device_id", 3), {}, repeated="x%50=0"),
    # All as text; copies differ from the row that survives, which is the later one.
    "transactions_dirty": Dirt(
        "transactions",
        _number("transaction_id", 3),
        {
            "customer_id": "case when x%41=0 then null else customer_id end",
            "device_id": "case when x%29=0 then null else device_id end",
            "ip_address": "case when x%23=0 then null else ip_address end",
            "amount": "case when x%37=0 then 'NaN' when x%53=0 then 'Infinity' when x%59=0 then 'abc' when x%61=0 then null"
            " when x%43=0 then '-5.0' when x%47=0 then '12.345' else cast(amount as string) end",
            "timestamp": "case when x%31=0 then null when x%67=0 then 'not a time' else ISO end",
            "is_fraud": "cast(is_fraud as string)",
            "latitude": "cast(latitude as string)",
        },
        repeated="x%50=0 and x%31<>0 and x%67<>0",
        copy={"amount": "'1.25'", "timestamp": "'2001-02-03T04:05:06.000000'"},
    ),
}

_ISO_SPARK = "date_format(timestamp, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")"
_ISO_DUCKDB = "strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f')"
_REPEATED = "cast(substr(transaction_id, 4) as bigint) % 50 = 0"


def _spark_text(expression: str) -> str:
    expression = re.sub(r"\bUS\((\w+)\)", r"unix_micros(cast(\1 as timestamp))", expression)
    return re.sub(r"\bTS\((\w+)\)", r"timestamp_micros(\1)", expression)


def _duckdb_text(expression: str) -> str:
    expression = re.sub(r"\bUS\((\w+)\)", r"epoch_us(\1)", expression)
    return re.sub(r"\bTS\((\w+)\)", r"make_timestamp(\1)", expression)


class TestBank:
    """Lazy banking tables over one test-data folder; ``bank.transactions`` and so on."""

    __test__ = False

    def __init__(self, spark: SparkSession, sf_dir: str, *, streaming: bool = False) -> None:
        """With ``streaming`` the event log, and with it the transactions, is a stream."""
        self.spark, self.sf_dir, self.streaming = spark, sf_dir.rstrip("/"), streaming
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def raw(self, name: str) -> DataFrame:
        if self.streaming and name == "events":
            return file_stream(self.spark, self.sf_dir, RAW_SCHEMAS[name], glob="events.parquet")
        return self.spark.read.schema(RAW_SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def _relation(self, name: str) -> DataFrame:
        return self.table(name) if name in SPEC else self.raw(name)

    def table(self, name: str) -> DataFrame:
        if name not in self.__dict__:
            self.__dict__[name] = self._build(SPEC[name])
        return self.__dict__[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in SPEC:
            return self.table(name)
        raise AttributeError(name)

    def _build(self, spec: Projection) -> DataFrame:
        if spec.source == "PAIRED":
            source = self.raw("customer").withColumn("j", F.explode(F.array(F.lit(0), F.lit(1))))
        elif " join " in spec.source:
            left, rest = spec.source.split(" join ", 1)
            right, condition = rest.split(" on ", 1)
            source = self._relation(left).join(self._relation(right), F.expr(condition))
        else:
            source = self._relation(spec.source)
        if spec.where:
            source = source.filter(spec.where)
        exprs = {name: F.expr(_spark_text(text)).alias(name) for name, text in spec.columns.items()}
        if not spec.group_by:
            return source.select(*exprs.values())
        aggregates = {n: e for n, e in exprs.items() if re.match(r"(min|max|cast\((count|sum))\(", spec.columns[n])}
        grouped = source.groupBy(*spec.group_by).agg(*aggregates.values())
        return grouped.select(*[F.col(n) if n in aggregates else exprs[n] for n in spec.columns])

    def dirty(self, name: str) -> DataFrame:
        """A table of ``DIRTY``: text types, differing copies, nulls and values out of range."""
        spec = DIRTY[name]
        text = lambda t: F.expr(t.replace("ISO", _ISO_SPARK))
        rows = self.table(spec.table).withColumn("x", F.expr(spec.number)).filter(spec.kept)
        changed = rows.withColumns({c: text(t) for c, t in spec.changed.items()}) if spec.changed else rows
        if spec.repeated:
            again = F.when(F.expr(spec.repeated), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
            changed = changed.withColumn("_again", F.explode(again))
            for c, t in (spec.copy or {}).items():
                changed = changed.withColumn(c, F.when(F.col("_again"), text(t)).otherwise(F.col(c)))
            changed = changed.drop("_again")
        return changed.drop("x")

    @cached_property
    def transactions_raw(self) -> DataFrame:
        """Transactions as delivered: ISO strings for time, and every fiftieth row twice."""
        copies = F.when(F.expr(_REPEATED), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        return (
            self.transactions.withColumn("timestamp", F.expr(_ISO_SPARK))
            .withColumn("_copy", F.explode(copies))
            .drop("_copy")
        )


def duckdb_ctes() -> str:
    """The same tables as a ``WITH`` prefix for DuckDB."""
    parts = []
    for name, spec in SPEC.items():
        source = "customer cross join (values (0),(1)) t(j)" if spec.source == "PAIRED" else spec.source
        columns = ", ".join(f"{_duckdb_text(text)} AS {column}" for column, text in spec.columns.items())
        where = f" WHERE {spec.where}" if spec.where else ""
        group = f" GROUP BY {', '.join(spec.group_by)}" if spec.group_by else ""
        parts.append(f"{name} AS (SELECT {columns} FROM {source}{where}{group})")
    iso = f"SELECT * REPLACE ({_ISO_DUCKDB} AS timestamp) FROM transactions"
    parts.append(f"transactions_raw AS ({iso} UNION ALL {iso} WHERE {_REPEATED})")
    for name, dirt in DIRTY.items():
        text = lambda changes: ", ".join(f"{t.replace('ISO', _ISO_DUCKDB)} AS {c}" for c, t in changes.items())
        rows = f"(SELECT *, {dirt.number} AS x FROM {dirt.table}) WHERE {dirt.kept}"
        replaced = f"REPLACE ({text(dirt.changed)})" if dirt.changed else ""
        parts.append(f"{name}_rows AS (SELECT * {replaced} FROM {rows})")
        copies = f" UNION ALL SELECT * EXCLUDE (x) {f'REPLACE ({text(dirt.copy)})' if dirt.copy else ''} FROM {name}_rows WHERE {dirt.repeated}"
        parts.append(f"{name} AS (SELECT * EXCLUDE (x) FROM {name}_rows{copies if dirt.repeated else ''})")
    return "WITH RECURSIVE " + ",\n".join(parts)
