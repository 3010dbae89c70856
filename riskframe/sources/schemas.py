"""The nine banking tables: columns, keys, references and required columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class TableDef:
    """Declared shape of a table. Spark enforces no keys; the quality checks read them from here."""

    name: str
    ddl: str
    key: tuple[str, ...]
    references: tuple[tuple[str, str], ...] = ()
    required: tuple[str, ...] = ()
    generated: tuple[str, ...] = ()

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def types(self) -> dict[str, str]:
        """Column name to type name, in declared order; needs no session."""
        return dict(column.split() for column in self.ddl.split(","))

    @property
    def columns(self) -> list[str]:
        return list(self.types)


# Listed in load order: a table follows every table it refers to.
TABLES: dict[str, TableDef] = {
    t.name: t
    for t in (
        TableDef(
            "customers",
            "customer_id string, age int, gender string, income double, employment_status string, city string,"
            " state string, customer_since date, credit_score int, risk_profile string",
            key=("customer_id",),
            required=("age",),
        ),
        TableDef(
            "accounts",
            "account_id string, customer_id string, account_type string, balance double,"
            " account_open_date date, status string",
            key=("account_id",),
            references=(("customer_id", "customers"),),
            required=("customer_id",),
        ),
        TableDef(
            "merchants",
            "merchant_id string, merchant_name string, merchant_category string, city string, state string,"
            " latitude double, longitude double, merchant_risk_score double",
            key=("merchant_id",),
        ),
        TableDef(
            "devices",
            "device_id string, device_type string, operating_system string, first_seen timestamp,"
            " last_seen timestamp, transaction_count int, fraud_count int",
            key=("device_id",),
        ),
        TableDef(
            "ip_addresses",
            "ip_address string, first_seen timestamp, last_seen timestamp, transaction_count int,"
            " fraud_count int, customer_count int",
            key=("ip_address",),
            generated=("ip_id",),
        ),
        TableDef(
            "transactions",
            "transaction_id string, customer_id string, account_id string, merchant_id string, device_id string,"
            " ip_address string, amount double, timestamp timestamp, transaction_type string,"
            " merchant_category string, merchant_risk_score double, city string, state string, latitude double,"
            " longitude double, payment_method string, is_fraud boolean, fraud_scenario string",
            key=("transaction_id",),
            references=(
                ("customer_id", "customers"),
                ("account_id", "accounts"),
                ("merchant_id", "merchants"),
                ("device_id", "devices"),
            ),
            required=("timestamp",),
        ),
        TableDef(
            "customer_devices",
            "customer_id string, device_id string, first_used timestamp, last_used timestamp, use_count int",
            key=("customer_id", "device_id"),
            references=(("customer_id", "customers"), ("device_id", "devices")),
            generated=("id",),
        ),
        TableDef(
            "customer_ips",
            "customer_id string, ip_address string, first_used timestamp, last_used timestamp, use_count int",
            key=("customer_id", "ip_address"),
            references=(("customer_id", "customers"),),
            generated=("id",),
        ),
        TableDef(
            "loans",
            "loan_id string, customer_id string, loan_amount double, interest_rate double, tenure_months int,"
            " monthly_income double, debt_to_income double, employment_status string, delinquency_history int,"
            " loan_status string, default_flag boolean, loan_start_date date",
            key=("loan_id",),
            references=(("customer_id", "customers"),),
        ),
    )
}

LOAD_ORDER: tuple[str, ...] = tuple(TABLES)


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Fail while the plan is built, not in a task, when an input column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; got {df.columns}")
    return df
