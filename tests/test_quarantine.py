"""Rows that break a declared rule are set aside with every reason; the others are published."""

import pytest
from pyspark.sql import functions as F

from riskframe.session import work_path
from riskframe.sources import quarantine
from riskframe.sources.quarantine import REJECTS, KeyFilter, load_with_rejects, sift
from riskframe.sources.schemas import TABLES
from riskframe.sources.snapshots import Snapshots


def rows_of(spark, name, *rows):
    """Rows of a table given by some of their columns, all as text."""
    columns = TABLES[name].columns
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], ", ".join(f"{c} string" for c in columns))


@pytest.fixture()
def store(spark, tmp_path):
    return Snapshots(spark, str(tmp_path / "store"))


def customers(spark, *ids):
    return rows_of(spark, "customers", *[{"customer_id": i, "age": "30"} for i in ids])


@pytest.mark.parametrize("bits", [64, quarantine.FILTER_BITS])
def test_reasons(spark, store, bits):
    """A filter of one word is full at once and denies little; the result is the same."""
    people = rows_of(
        spark,
        "customers",
        *[{"customer_id": f"C{i}", "age": "30"} for i in range(60)],
        {"customer_id": None, "age": "x"},
        {"customer_id": "young", "age": None, "income": "Infinity"},
    )
    accounts = rows_of(
        spark,
        "accounts",
        {"account_id": "A1", "customer_id": "C1", "balance": "1.5"},
        {"account_id": "A2", "customer_id": "young"},
        {"account_id": "A3", "customer_id": "nobody", "balance": "NaN"},
        {"account_id": "A4", "customer_id": None},
        {"account_id": None, "customer_id": "C1", "balance": "many"},
    )
    load_with_rejects(spark, {"customers": people, "accounts": accounts}, store, "b1", bits)
    found = {(r["table_name"], r["row_key"]): (r["reasons"], r["row"]) for r in store.read(REJECTS).collect()}
    assert {k: v[0] for k, v in found.items()} == {
        ("customers", ""): ["null customer_id", "type age"],
        ("customers", "young"): ["null age", "type income"],
        ("accounts", "A2"): ["foreign key customer_id"],
        ("accounts", "A3"): ["foreign key customer_id", "type balance"],
        ("accounts", "A4"): ["null customer_id"],
        ("accounts", ""): ["null account_id", "type balance"],
    }
    assert '"balance":"many"' in found["accounts", ""][1]
    assert [r["account_id"] for r in store.read("accounts").collect()] == ["A1"]
    assert store.read("customers").count() == 60 and dict(store.read("accounts").dtypes)["balance"] == "double"


def test_copies(spark, store):
    """One of a thousand equal rows stays, of differing ones the latest; an unsound copy does not take the key."""
    txn = lambda i, at, amount="1.0": {"transaction_id": i, "timestamp": at, "amount": amount, "is_fraud": "false"}
    times = ["2024-01-01 00:00:00", "2024-01-03 00:00:00", "2024-01-02 00:00:00"]
    rows = [txn("same", times[0])] * 1000 + [txn("T", t, a) for t, a in zip(times, ("1.0", "2.0", "3.0"))]
    rows += [txn("U", times[1], "bad"), txn("U", times[0])]
    load_with_rejects(spark, {"transactions": rows_of(spark, "transactions", *rows)}, store, "b1")
    kept = {r["transaction_id"]: r["amount"] for r in store.read("transactions").collect()}
    assert kept == {"same": 1.0, "T": 2.0, "U": 1.0} and store.read("transactions").count() == 3
    counts = {(r["row_key"], *r["reasons"]): r["count"] for r in store.read(REJECTS).groupBy("row_key", "reasons").count().collect()}
    assert counts == {("same", "duplicate key"): 999, ("T", "duplicate key"): 2, ("U", "type amount"): 1}


def test_earlier_parents_batches_and_empty_tables(spark, store):
    load_with_rejects(spark, {"customers": customers(spark, "C1"), "accounts": rows_of(spark, "accounts")}, store, "b1")
    assert store.read("accounts").count() == 0 and store.read(REJECTS).count() == 0
    new = {"accounts": rows_of(spark, "accounts", {"account_id": "A", "customer_id": "C1"}, {"account_id": "B", "customer_id": "C2"})}
    second = load_with_rejects(spark, new, store, "b2")
    assert [r["account_id"] for r in store.read("accounts").collect()] == ["A"]
    assert [r["row_key"] for r in store.read(REJECTS).collect()] == ["B"]
    assert load_with_rejects(spark, new, store, "b2") == second
    # Nothing sound, and more columns than are declared.
    orphans = rows_of(spark, "accounts", {"account_id": "A", "customer_id": "C9"}).withColumn("sound", F.lit(1))
    load_with_rejects(spark, {"accounts": orphans}, store, "b3")
    assert store.read("accounts").count() == 0 and store.read("customers").count() == 1
    with pytest.raises(ValueError, match="missing columns"):
        load_with_rejects(spark, {"accounts": orphans.drop("status")}, store, "b4")


def test_source_is_read_once(spark, tmp_path):
    """The rows handed in are scanned by the first pass alone; the rest reads what it stored."""
    rows_of(spark, "accounts", {"account_id": "A", "customer_id": "C1"}).write.parquet(str(tmp_path / "in"))
    given = spark.read.parquet(str(tmp_path / "in"))
    sifted = sift("accounts", given, {"customers": customers(spark, "C1")}, work_path(spark, "typed"))
    assert str(tmp_path / "in") not in sifted._jdf.queryExecution().toString()
    assert sifted.count() == 1


def test_filter_denies_most_strangers_and_no_member(spark):
    held = KeyFilter(spark.range(1000).select(F.col("id").cast("string")), 1 << 14)
    asked = spark.range(3000).select(F.col("id"), held.denies(F.col("id").cast("string")).alias("denied"))
    counts = {r["member"]: r["n"] for r in asked.groupBy((F.col("id") < 1000).alias("member")).agg(F.count_if("denied").alias("n")).collect()}
    assert counts[True] == 0 and counts[False] > 1900


def test_sound_rows_are_not_moved(spark, tmp_path):
    """Rows are looked up in small stored tables; only likely copies go through a shuffle, as the keys do."""
    people = spark.range(200).select(F.concat(F.lit("C"), "id").alias("customer_id"))
    rows = people.select("customer_id", F.concat(F.lit("A"), "customer_id").alias("account_id"))
    rows = rows.unionByName(rows.filter("customer_id = 'C7'")).unionByName(rows.limit(0))
    rows = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in TABLES["accounts"].columns])
    sifted = sift("accounts", rows, {"customers": people.filter("customer_id <> 'C9'")}, str(tmp_path / "between"))
    found = {(r["account_id"], *r["_reasons"]): r["count"] for r in sifted.groupBy("account_id", "_reasons").count().collect()}
    assert len(found) == 201 and found["AC7",] == found["AC7", "duplicate key"] == found["AC9", "foreign key customer_id"] == 1
    assert (tmp_path / "between" / "repeated").is_dir() and (tmp_path / "between" / "absent-customer_id").is_dir()
    assert spark.read.parquet(str(tmp_path / "between" / "repeated")).count() == 1
