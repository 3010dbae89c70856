"""A stream must give what the batch operators give for rows the watermark has passed."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskframe.operators.entity import DEVICE, IP, first_use
from riskframe.operators.velocity import velocity_features
from riskframe.streaming import windows
from riskframe.streaming.io import file_stream, run_available
from riskframe.streaming.stateful import stream_new_entity, stream_velocity

START = datetime(2024, 1, 1)
SCHEMA = "transaction_id string, customer_id string, device_id string, ip_address string, amount double, timestamp timestamp"


@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory):
    """Three files, each later than the one before but out of order inside; then one very late row
    and a sentinel that moves the watermark past everything."""
    rng = random.Random(7)
    folder = tmp_path_factory.mktemp("feed")
    batches = []
    for b in range(3):
        rows = []
        for i in range(60):
            when = START + timedelta(days=3 * b, seconds=rng.randrange(3 * 86400), milliseconds=rng.randrange(1000))
            if i % 5 == 0:
                when = START + timedelta(days=3 * b, hours=5, seconds=i // 10)
            rows.append((f"T{b}{i:02d}", f"C{rng.randrange(3)}", f"D{rng.randrange(4)}" if i % 9 else None, f"I{rng.randrange(3)}", rng.randrange(1, 9999) / 100, when))
        batches.append(rows)
    end = START + timedelta(days=30)
    batches.append([("LATE", "C0", "D0", "I0", 1.0, START + timedelta(days=1)), ("END", "sentinel", "D", "I", 1.0, end)])
    for b, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(folder / f"day={b}" / "part"))
    kept = [r for rows in batches for r in rows if r[0] not in ("LATE", "END")]
    return folder, spark.createDataFrame(kept, SCHEMA)


def live(spark, folder):
    from pathlib import Path
    import os
    import shutil

    # One flat folder with increasing modification times makes the arrival order certain.
    flat = Path(str(folder) + "-flat")
    if not flat.exists():
        flat.mkdir()
        for b, part in enumerate(sorted(Path(folder).glob("day=*/part"))):
            for n, file in enumerate(sorted(part.glob("*.parquet"))):
                copy = flat / f"{b}-{n}.parquet"
                shutil.copy(file, copy)
                os.utime(copy, (1_700_000_000 + 100 * b, 1_700_000_000 + 100 * b))
    return file_stream(spark, str(flat), SCHEMA, files_per_trigger=1)


def test_velocity_equals_batch(spark, feed):
    folder, kept = feed
    got = run_available(stream_velocity(live(spark, folder)), "test-velocity").filter("customer_id <> 'sentinel'")
    batch = velocity_features(kept.select("transaction_id", "customer_id", "amount", "timestamp"))
    batch = batch.select(*got.columns)
    assert got.count() == 180
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0


@pytest.mark.parametrize("kind", [DEVICE, IP])
def test_new_entities_equal_batch(spark, feed, kind):
    folder, kept = feed
    got = run_available(stream_new_entity(live(spark, folder), kind), "test-entities").filter("customer_id <> 'sentinel'")
    firsts = {r["_first_id"] for r in first_use(kept, kind).collect()}
    rows = got.collect()
    assert len(rows) == 180
    for r in rows:
        assert r[f"is_new_{kind.prefix}"] == (r[kind.key] is None or r["transaction_id"] in firsts), r


def test_known_entities_seed_the_state(spark, feed):
    folder, _ = feed
    known = spark.createDataFrame([("C0", f"D{i}") for i in range(4)], "customer_id string, device_id string")
    got = run_available(stream_new_entity(live(spark, folder), known=known), "test-known")
    mine = got.filter("customer_id = 'C0' and device_id is not null")
    assert mine.count() > 0 and mine.filter("is_new_device").count() == 0
    assert got.filter("customer_id = 'C1' and device_id is not null and is_new_device").count() > 0


def test_windows_and_dedup(spark, feed):
    folder, kept = feed
    got = run_available(windows.tumbling(live(spark, folder)), "test-tumbling").filter("customer_id <> 'sentinel'")
    assert got.agg(F.sum("txn_count")).first()[0] == 180
    assert got.agg(F.round(F.sum("spend"), 2)).first()[0] == kept.agg(F.round(F.sum("amount"), 2)).first()[0]
    sessions = run_available(windows.sessions(live(spark, folder)), "test-sessions")
    assert sessions.filter("customer_id <> 'sentinel'").agg(F.sum("txn_count")).first()[0] == 180
    unique = run_available(windows.deduplicated(live(spark, folder)), "test-dedup")
    assert unique.filter("transaction_id like 'T%'").count() == 180


def test_state_stores_do_not_count_their_keys(spark):
    """Counting costs a read before every write; the tests' session has the library's options."""
    assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", None) == "false"
