"""Versioned tables, and entity counters that take batches."""

import random
from datetime import datetime, timedelta

import pytest

from riskframe.operators import entity, incremental
from riskframe.sources.snapshots import Conflict, Snapshots

SCHEMA = "transaction_id string, customer_id string, device_id string, ip_address string, timestamp timestamp, is_fraud boolean"
START = datetime(2024, 1, 1)


def batches(n, seed=1):
    rng = random.Random(seed)
    made = []
    for k in range(n):
        rows = []
        for i in range(150):
            at = None if rng.random() < 0.05 else START + timedelta(seconds=rng.randrange(10**6))
            device = rng.choice(["hot"] * 5 + [f"d{k}-{rng.randrange(9)}", f"d{rng.randrange(30)}", None])
            rows.append((f"t{k}-{i}", rng.choice(["a", "b", "c", None]), device, "ip", at, rng.choice([True, False, None])))
        made.append(rows)
    return made


def ordered(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_batches_equal_one_full_run(spark, tmp_path):
    made = batches(3)
    uses = incremental.EntityUses(Snapshots(spark, str(tmp_path)), entity.DEVICE, buckets=8)
    for k in (0, 1, 0, 2, 1):  # two are delivered twice
        uses.add(spark.createDataFrame(made[k], SCHEMA), f"day-{k}")
    whole = spark.createDataFrame([r for rows in made for r in rows], SCHEMA)
    assert ordered(uses.stats()) == ordered(entity.refresh_stats(whole, entity.DEVICE))
    assert ordered(uses.usage()) == ordered(entity.usage_map(whole, entity.DEVICE))
    assert uses.store.latest().number == 3
    uses.store.forget()
    assert ordered(uses.stats()) == ordered(entity.refresh_stats(whole, entity.DEVICE))


def test_only_touched_buckets_are_written(spark, tmp_path):
    (rows,) = batches(1)
    store = Snapshots(spark, str(tmp_path))
    uses = incremental.EntityUses(store, entity.DEVICE, buckets=64)
    first = uses.add(spark.createDataFrame(rows, SCHEMA), "one")
    second = uses.add(spark.createDataFrame([("x", "a", "hot", "ip", START, True)], SCHEMA), "two")
    before, after = first.tables[uses.table], second.tables[uses.table]
    assert set(before) == set(after) and len(before) > 10
    assert sum(before[b] != after[b] for b in before) == 1
    assert uses.add(spark.createDataFrame([], SCHEMA), "three").tables[uses.table] == after


def test_a_dead_job_leaves_the_old_tables(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path))
    old = {"a": spark.range(3), "b": spark.range(5)}
    store.publish(old, "load-1")
    fails = spark.range(9).selectExpr("raise_error('lost') AS id", "id AS b")
    with pytest.raises(Exception, match="lost"):
        store.publish({"a": spark.range(100), "b": fails}, "load-2")  # the first table is written, the second is not
    assert store.read("a").count() == 3 and store.read("b").count() == 5
    store.publish({"a": spark.range(100), "b": spark.range(50)}, "load-2")
    store.publish({"a": spark.range(100), "b": spark.range(50)}, "load-2")  # a retry adds nothing
    assert store.read("a").count() == 100 and store.read("b").count() == 50 and store.latest().number == 2
    store.forget()
    assert store.read("b").count() == 50


def test_two_writers_cannot_take_one_number(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path))
    before = store.latest()
    store.publish({"a": spark.range(1)})
    with pytest.raises(Conflict):
        store.commit(before, {}, {})
