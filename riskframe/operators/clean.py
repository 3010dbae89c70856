"""Type enforcement and de-duplication of the raw tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.functions.columns import fingerprint, is_finite
from riskframe.sources.schemas import TABLES, require


def enforce_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the listed columns that are present; values that do not parse become null."""
    present = {c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns}
    return df.withColumns(present) if present else df


def declared(name: str, df: DataFrame) -> DataFrame:
    """Declared types of the columns of table ``name`` that are present, text columns as they are; numbers
    that are not finite become null, so that one of them cannot spoil a sum."""
    types = {c: t for c, t in TABLES[name].types.items() if t != "string" and c in df.columns}
    typed = enforce_types(df, types)
    doubles = [c for c, t in typed.dtypes if t == "double"]
    return typed.withColumns({c: F.when(is_finite(F.col(c)), F.col(c)) for c in doubles}) if doubles else typed


def deduplicate(df: DataFrame, key: str, *preferred: Column) -> DataFrame:
    """One row per key: the first by ``preferred``, then by a hash of the whole row.

    The survivor does not depend on task order, so a recomputed partition yields the same row; and
    a plan that needs few columns shuffles only those and the hash. The rank limit is applied before
    the shuffle as well, hence copies of one key never pile up.
    """
    others = [f"`{c}`" for c in df.columns if c != key]
    # The hash skips nulls, so their positions are hashed too.
    content = F.expr(f"xxhash64({', '.join(others + [f'isnull({c})' for c in others])})") if others else F.lit(0)
    order = Window.partitionBy(key).orderBy(*preferred, content)
    return df.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") == 1).drop("_rank")


def clean_transactions(df: DataFrame) -> DataFrame:
    """Typed transactions with ``timestamp_sec`` (floored epoch seconds), latest row per id.

    Only ``transaction_id`` is mandatory; other declared columns are cast where present.
    """
    typed = declared("transactions", require(df, "transaction_id"))
    if "timestamp" not in typed.columns:
        return deduplicate(typed, "transaction_id")
    typed = typed.withColumn("timestamp_sec", F.col("timestamp").cast("bigint"))
    return deduplicate(typed, "transaction_id", F.col("timestamp").desc_nulls_last())


def clean_customers(df: DataFrame) -> DataFrame:
    return deduplicate(declared("customers", require(df, "customer_id")), "customer_id")


def clean_devices(df: DataFrame) -> DataFrame:
    return deduplicate(declared("devices", require(df, "device_id")), "device_id")


def clean_ip_addresses(df: DataFrame) -> DataFrame:
    return deduplicate(declared("ip_addresses", require(df, "ip_address")), "ip_address")


def clean_loans(df: DataFrame) -> DataFrame:
    return deduplicate(declared("loans", require(df, "loan_id")), "loan_id")


def clean_merchants(df: DataFrame) -> DataFrame:
    """Unique merchants, so that enrichment never multiplies transactions."""
    return deduplicate(declared("merchants", require(df, "merchant_id")), "merchant_id")


def normalise(name: str, df: DataFrame) -> DataFrame:
    """Load-time types: strings to dates and timestamps as declared, surrogate ids dropped."""
    table = TABLES[name]
    temporal = {c: t for c, t in table.types.items() if t in ("date", "timestamp")}
    return enforce_types(df.drop(*table.generated), temporal)


def pseudonymise(df: DataFrame, column: str, length: int = 40) -> DataFrame:
    """Replace an identifier by the leading hex digits of its SHA-256 digest."""
    return df.withColumn(column, fingerprint(F.col(column), length))
