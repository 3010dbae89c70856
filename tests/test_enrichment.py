"""Each row meets the version of its time, popular keys and rows without a key are spread."""

import random
from datetime import datetime, timedelta

import pytest

from riskframe.streaming.enrichment import Lookup, enriched_as_of, histories, popular_keys
from riskframe.streaming.io import file_stream, run_available

START = datetime(2024, 1, 1)
ROWS = "transaction_id string, device_id string, timestamp timestamp, _other int"
VERSIONS = "device_id string, risk double, valid_from timestamp"


def at(hours):
    return None if hours is None else START + timedelta(hours=hours)


@pytest.fixture(scope="module")
def case(spark):
    rng = random.Random(3)
    versions = [(f"D{d}", rng.choice([0.1, 0.4, 0.9, None]), at(rng.randrange(0, 40))) for d in range(12) for _ in range(4)]
    # Two scores for one time, one of them null; no key; no time.
    versions += [("D0", None, at(41)), ("D0", 0.7, at(41)), ("D0", 0.6, at(41)), (None, 0.8, at(0)), ("D1", 0.8, None)]
    rows = []
    for i in range(900):
        device = "D0" if i % 3 == 0 else None if i % 3 == 1 else f"D{rng.randrange(15)}"
        rows.append((f"T{i}", device, at(None if i % 50 == 0 else rng.randrange(0, 60)), i))
    rows.append(rows[5])
    want = []
    for name, device, when, other in rows:
        held = [(v[2], v[1] if v[1] is not None else -1.0) for v in versions if device and v[0] == device and v[2] is not None and when and v[2] <= when]
        score = max(held)[1] if held else -1.0
        want.append((name, device, when, other, 0.05 if score < 0 else score))
    return spark.createDataFrame(rows, ROWS), spark.createDataFrame(versions, VERSIONS), sorted(want, key=repr)


@pytest.mark.parametrize("salted", [False, True])
def test_versions_in_batch_and_stream(spark, case, tmp_path, salted):
    rows, versions, want = case
    popular = popular_keys(rows, "device_id", 200) if salted else None
    if salted:
        assert [r[0] for r in popular.collect()] == ["D0"]
    lookup = Lookup(histories(versions, "device_id", "risk"), "device_id", "risk_then", popular)
    batch = enriched_as_of(rows, [lookup], salts=8)
    assert sorted(map(tuple, batch.collect()), key=repr) == want
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = file_stream(spark, str(tmp_path / "in"), rows.schema, files_per_trigger=1)
    got = run_available(enriched_as_of(stream, [lookup], salts=8), "test-versions")
    assert sorted(map(tuple, got.collect()), key=repr) == want


def test_two_lookups_and_empty_ones(spark, case):
    rows, versions, want = case
    full, none = histories(versions, "device_id", "risk"), histories(versions.limit(0), "device_id", "risk")
    got = enriched_as_of(rows, [Lookup(full, "device_id", "a"), Lookup(none, "device_id", "b", default=0.2)])
    assert sorted([tuple(r)[:-1] for r in got.collect()], key=repr) == want
    assert {r["b"] for r in got.collect()} == {0.2}
    assert enriched_as_of(rows.limit(0), [Lookup(full, "device_id", "a")]).count() == 0
