"""Data-quality checks. Every check yields one row (check, violations); 0 means passed."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import MONEY_SCALE, is_finite
from riskframe.sources.schemas import LOAD_ORDER, TABLES

Tables = Mapping[str, DataFrame]


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _counts(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """All aggregates of one table in a single pass, turned into rows."""
    totals = df.agg(*[total.cast("bigint").alias(name) for name, total in checks.items()])
    rows = [F.struct(F.lit(name).alias("check"), F.col(name).alias("violations")) for name in checks]
    return totals.select(F.inline(F.array(*rows)))


def table_row_counts(tables: Tables) -> DataFrame:
    names = [n for n in LOAD_ORDER if n in tables]
    return _stack(
        [tables[n].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n in names]
    )


# Check name -> (table, foreign key, referenced table).
ORPHAN_CHECKS = {
    "orphaned_accounts_customer": ("accounts", "customer_id", "customers"),
    "orphaned_txns_customer": ("transactions", "customer_id", "customers"),
    "orphaned_txns_account": ("transactions", "account_id", "accounts"),
    "orphaned_txns_merchant": ("transactions", "merchant_id", "merchants"),
    "orphaned_txns_device": ("transactions", "device_id", "devices"),
    "orphaned_loans_customer": ("loans", "customer_id", "customers"),
    "orphaned_customer_devices": ("customer_devices", "customer_id", "customers"),
}


def orphan_checks(tables: Tables) -> DataFrame:
    """Rows whose foreign key has no partner.

    Each table is read once and its keys are counted before anything is joined, so a popular key
    reaches the join as one row; one anti join then serves all checks.
    """
    by_table: dict[str, list[tuple[str, str]]] = {}
    for check, (table, key, _) in ORPHAN_CHECKS.items():
        by_table.setdefault(table, []).append((check, key))
    used = _stack(
        [
            tables[table]
            .select(F.inline(F.array(*[F.struct(F.lit(c).alias("check"), F.col(k).alias("id")) for c, k in checks])))
            .filter(F.col("id").isNotNull())
            .groupBy("check", "id")
            .agg(F.count(F.lit(1)).alias("n"))
            for table, checks in by_table.items()
        ]
    )
    # Which checks look at which referenced table, as a table-name column on both sides.
    target = F.create_map(*[F.lit(x) for check, (_, _, parent) in ORPHAN_CHECKS.items() for x in (check, parent)])
    parents = sorted({parent for _, _, parent in ORPHAN_CHECKS.values()})
    keys = {"customers": "customer_id", "accounts": "account_id", "merchants": "merchant_id", "devices": "device_id"}
    present = _stack([tables[p].select(F.lit(p).alias("target"), F.col(keys[p]).alias("id")) for p in parents])
    missing = used.withColumn("target", target[F.col("check")]).join(present, ["target", "id"], "left_anti")
    orphans = missing.groupBy("check").agg(F.sum("n").alias("violations"))
    every = used.sparkSession.createDataFrame([(c,) for c in ORPHAN_CHECKS], "check string")
    return every.join(orphans, "check", "left").select("check", F.coalesce("violations", F.lit(0)).alias("violations"))


def _is_null(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


# The names of the null and range checks.
def null_checks(tables: Tables) -> DataFrame:
    return _stack(
        [
            _counts(tables["customers"], {"null_customer_ids": _is_null("customer_id")}),
            _counts(
                tables["transactions"],
                {
                    "null_transaction_ids": _is_null("transaction_id"),
                    "null_transaction_amounts": _is_null("amount"),
                    "null_transaction_timestamps": _is_null("timestamp"),
                    "null_device_ids": _is_null("device_id"),
                    "null_ip_addresses": _is_null("ip_address"),
                },
            ),
        ]
    )


def range_checks(tables: Tables) -> DataFrame:
    """Values out of bounds; null counts as no violation."""
    outside = lambda c, low, high: F.count_if((F.col(c) < low) | (F.col(c) > high))
    not_positive = lambda c: F.count_if(F.col(c) <= 0)
    return _stack(
        [
            _counts(tables["customers"], {"invalid_credit_scores": outside("credit_score", 300, 850)}),
            _counts(tables["transactions"], {"negative_txn_amounts": not_positive("amount")}),
            _counts(tables["merchants"], {"invalid_merchant_risk": outside("merchant_risk_score", 0, 1)}),
            _counts(tables["loans"], {"negative_loan_amounts": not_positive("loan_amount")}),
        ]
    )


# Check name -> (table, key that must be unique).
UNIQUE_CHECKS = {
    "duplicate_customers": ("customers", "customer_id"),
    "duplicate_accounts": ("accounts", "account_id"),
    "duplicate_transactions": ("transactions", "transaction_id"),
    "duplicate_merchants": ("merchants", "merchant_id"),
    "duplicate_devices": ("devices", "device_id"),
}


def duplicate_checks(tables: Tables) -> DataFrame:
    """Keys beyond the first of their kind: non-null keys minus distinct keys."""
    return _stack(
        [
            _counts(tables[table], {check: F.count(key) - F.countDistinct(key)})
            for check, (table, key) in UNIQUE_CHECKS.items()
        ]
    )


def amount_checks(tables: Tables, scale: int = MONEY_SCALE) -> DataFrame:
    """Amounts that are no number, not finite, or have more than ``scale`` decimals; sums leave the first
    two out and round the last."""
    amount = F.col("amount").try_cast("double")
    checks = {
        "unreadable_txn_amounts": F.count_if(F.col("amount").isNotNull() & amount.isNull()),
        "non_finite_txn_amounts": F.count_if(~is_finite(amount)),
        "over_precise_txn_amounts": F.count_if(is_finite(amount) & (F.round(amount, scale) != amount)),
    }
    return _counts(tables["transactions"], checks)


def constraint_checks(tables: Tables) -> DataFrame:
    """(table_name, constraint, columns, violations) of what the table definitions declare.

    Per table one pass counts nulls in key and required columns and rows beyond the first of their key;
    each foreign key counts rows whose value is missing in the table it refers to.
    """
    found = []
    for name in (n for n in LOAD_ORDER if n in tables):
        table, df = TABLES[name], tables[name]
        whole = reduce(Column.__and__, [F.col(c).isNotNull() for c in table.key])
        checks = {("not null", c): _is_null(c) for c in dict.fromkeys((*table.key, *table.required))}
        keys = F.when(whole, F.struct(*table.key))
        checks["unique", ", ".join(table.key)] = F.count(keys) - F.countDistinct(keys)
        totals = df.agg(*[total.cast("bigint").alias(f"c{i}") for i, total in enumerate(checks.values())])
        rows = [
            F.struct(F.lit(name).alias("table_name"), F.lit(kind).alias("constraint"), F.lit(on).alias("columns"), F.col(f"c{i}").alias("violations"))
            for i, (kind, on) in enumerate(checks)
        ]
        found.append(totals.select(F.inline(F.array(*rows))))
        for column, parent in table.references:
            # Counted before the join: a popular value is one row there.
            used = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("id")).agg(F.count(F.lit(1)).alias("n"))
            missing = used.join(tables[parent].select(F.col(TABLES[parent].key[0]).alias("id")), "id", "left_anti")
            found.append(
                missing.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("violations")).select(
                    F.lit(name).alias("table_name"), F.lit("foreign key").alias("constraint"), F.lit(column).alias("columns"), "violations"
                )
            )
    return _stack(found)


CHECK_GROUPS = {
    "orphan_checks": orphan_checks,
    "null_checks": null_checks,
    "range_checks": range_checks,
    "unique_checks": duplicate_checks,
}
# With the amounts as delivered.
ALL_GROUPS = {**CHECK_GROUPS, "amount_checks": amount_checks}


def quality_report(tables: Tables, groups: Mapping[str, Callable[[Tables], DataFrame]] = CHECK_GROUPS) -> DataFrame:
    """The checks of ``groups``: (check_group, check, violations, passed)."""
    return _stack(
        [
            run(tables).select(
                F.lit(group).alias("check_group"), "check", "violations", (F.col("violations") == 0).alias("passed")
            )
            for group, run in groups.items()
        ]
    )


def all_passed(report: DataFrame) -> DataFrame:
    """One row: did every check pass, and how many rows violate any."""
    return report.agg(F.min("passed").alias("passed"), F.sum("violations").alias("violations"))
