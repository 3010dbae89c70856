"""Slicing a hot customer's timeline must not change any result."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskframe.operators.skew import SLICE, SkewPolicy
from riskframe.operators.timeline import look_back, rolling_cuts
from riskframe.operators.velocity import NO_PREVIOUS_SECONDS, transaction_velocity_view, velocity_features

START = datetime(2024, 1, 1)
SLICED = SkewPolicy(hot_rows=5)
SCHEMA = "transaction_id string, customer_id string, amount double, timestamp timestamp, latitude double"


def expected(rows):
    """Brute force over pairs of rows."""
    out = {}
    second = lambda r: int((r[3] - START).total_seconds()) if r[3] else 0
    for r in rows:
        # Rows without time are peers of each other in sums; nothing precedes them, and they precede nothing.
        mine = [x for x in rows if x[1] == r[1] and (x[3] is None) == (r[3] is None)]
        entry = {}
        for name, width in (("1h", 3600), ("24h", 86400), ("7d", 604800)):
            inside = [x for x in mine if 0 <= second(r) - second(x) <= width]
            entry[f"txns_last_{name}"] = len(inside) - 1
            entry[f"spend_last_{name}"] = sum(round((x[2] or 0) * 100) for x in inside) / 100
        if r[3] is None:
            out[r[0]] = entry | {"gap": NO_PREVIOUS_SECONDS, "prev_latitude": None, "burst": False}
            continue
        before = sorted((x for x in mine if (x[3], x[0]) < (r[3], r[0])), key=lambda x: (x[3], x[0]))
        before_s = sorted((x for x in mine if (second(x), x[0]) < (second(r), r[0])), key=lambda x: (second(x), x[0]))
        entry["gap"] = second(r) - second(before_s[-1]) if before_s else NO_PREVIOUS_SECONDS
        entry["prev_latitude"] = before[-1][4] if before else None
        entry["burst"] = len(before) >= 3 and (r[3] - before[-3][3]).total_seconds() < 60
        out[r[0]] = entry
    return out


def compare(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = expected(rows)
    for policy in (SkewPolicy(hot_rows=1), SLICED, SkewPolicy(hot_rows=10**9)):
        rolled = {r["transaction_id"]: r for r in velocity_features(df, policy=policy).collect()}
        both = look_back(df, ["latitude", "timestamp"], {"burst": (3, 60)}, policy=policy)
        lagged = {r["transaction_id"]: r for r in both.collect()}
        alone = {r["transaction_id"]: r for r in look_back(df, ["latitude"], policy=policy).collect()}
        assert rolled.keys() == lagged.keys() == alone.keys() == want.keys()
        for key, entry in want.items():
            for column in ("txns_last_1h", "txns_last_24h", "txns_last_7d", "spend_last_1h", "spend_last_24h", "spend_last_7d"):
                assert rolled[key][column] == entry[column], (key, column, policy)
            assert rolled[key]["seconds_since_last_txn"] == entry["gap"], (key, policy)
            assert lagged[key]["prev_latitude"] == entry["prev_latitude"], (key, policy)
            assert alone[key]["prev_latitude"] == entry["prev_latitude"], (key, policy)
            assert lagged[key]["burst"] == entry["burst"], (key, policy)


moments = st.one_of(st.none(), st.integers(0, 40 * 3_600_000), st.sampled_from([0, 3_599_999, 3_600_000, 7_200_000]), st.integers(0, 300_000))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "cold", None]), moments, st.one_of(st.none(), st.integers(1, 9999))), min_size=1, max_size=40))
def test_random_timelines(spark, drawn):
    rows = [
        (f"T{i:03d}", who, cents and cents / 100, None if ms is None else START + timedelta(milliseconds=ms), float(i))
        for i, (who, ms, cents) in enumerate(drawn)
    ]
    compare(spark, rows)


def test_rows_without_time_are_the_same_for_any_size(spark):
    rows = [("a", "hot", 1.0, None, 9.0), ("b", "hot", 2.0, START, 1.0), ("c", "hot", None, None, 3.0), ("d", "hot", 4.0, START + timedelta(seconds=1), 2.0)]
    compare(spark, rows)


def test_hot_rows_without_time_are_dealt_out(spark):
    rows = [(f"T{i}", "hot", 1.0, None if i % 2 else START + timedelta(seconds=i), float(i)) for i in range(400)]
    sliced = look_back(spark.createDataFrame(rows, SCHEMA), ["latitude"], keep_slice=True, policy=SLICED)
    sizes = [r["count"] for r in sliced.filter("timestamp is null").groupBy("_slice").count().collect()]
    assert sum(sizes) == 200 and max(sizes) < 10


def test_a_whole_customer_in_one_second(spark):
    compare(spark, [(f"T{i:02d}", "hot", 0.5, START + timedelta(milliseconds=i % 7), float(i)) for i in range(25)])


def test_bursts_across_slice_borders(spark):
    rows = [
        (f"T{i:03d}", "hot", 1.0, START + timedelta(seconds=3600 * h + s), float(i))
        for i, (h, s) in enumerate((h, s) for h in range(1, 5) for s in (-40, -20, -5, 0, 10, 55))
    ]
    compare(spark, rows)


def test_hot_customer_without_id(spark):
    rows = [(f"T{i}", None, 1.0, START + timedelta(minutes=30 * i), 0.0) for i in range(12)]
    df = spark.createDataFrame(rows, SCHEMA)
    counts = {r["transaction_id"]: r["txns_last_1h"] for r in velocity_features(df, policy=SLICED).collect()}
    assert [counts[f"T{i}"] for i in range(12)] == [0, 1] + [2] * 10


def test_exact_view_is_sliced_too(spark):
    rows = [(f"T{i}", "hot", 0.1, START + timedelta(minutes=7 * i, microseconds=i), 0.0) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    one = sorted(transaction_velocity_view(df, policy=SLICED).collect())
    two = sorted(transaction_velocity_view(df, policy=SkewPolicy(hot_rows=10**9)).collect())
    assert one == two and max(r["txns_last_1_hour"] for r in one) == 8


def test_one_customer_holding_a_third_of_the_rows_is_spread(spark):
    df = spark.range(30_000).selectExpr(
        "concat('T', id) transaction_id",
        "case when id % 3 = 0 then 'hot' else concat('C', id % 1000) end customer_id",
        "cast(id % 100 as double) amount",
        "timestamp_seconds(1704067200 + id * 60) timestamp",
    )
    policy = SkewPolicy(hot_rows=5_000)
    cuts = rolling_cuts(df, [3600], tick=F.unix_seconds("timestamp"), key="customer_id", policy=policy)
    assert [r["_hot_key"] for r in cuts.collect()] == ["hot"]
    plain = velocity_features(df, policy=SkewPolicy(hot_rows=10**9)).drop("timestamp")
    sliced = velocity_features(df, policy=policy).drop("timestamp")
    assert sliced.exceptAll(plain).count() == 0 and sliced.count() == 30_000


def test_long_bursts_need_no_long_slices(spark):
    rows = [(f"T{i:02d}", "hot", 1.0, START + timedelta(minutes=50 * i), float(i)) for i in range(20)]
    df = spark.createDataFrame(rows, SCHEMA)
    one = look_back(df, bursts={"b": (2, 7200)}, policy=SkewPolicy(hot_rows=1))
    assert sorted(r["transaction_id"] for r in one.filter("b").collect()) == [f"T{i:02d}" for i in range(2, 20)]


def bursts(spark, n):
    """A customer with ``n`` rows within one second and ``n`` within ten minutes, among others and rows without time."""
    return spark.range(2 * n + 900).selectExpr(
        "concat('T', lpad(id, 9, '0')) transaction_id",
        f"case when id < {2 * n} or id % 3 = 0 then 'hot' else concat('C', id % 100) end customer_id",
        "cast(id % 100 as double) amount",
        f"case when id < {n} then timestamp_seconds(1704067200) when id < {2 * n} then timestamp_millis(1704067300000 + (id * 7919) % 600000)"
        f" when id % 9 = 0 then null else timestamp_seconds(1704067000 + (id - {2 * n}) * 60) end timestamp",
        "cast(id as double) latitude",
    )


def test_dense_seconds_are_cut_like_any_other_stretch(spark):
    """No task's slice grows with a burst, be it of one second, of ten minutes or of rows without time."""
    n, policy = 30_000, SkewPolicy(hot_rows=2_000)
    df = bursts(spark, n)
    plain, sliced = (velocity_features(df, keep_slice=True, policy=p) for p in (SkewPolicy(hot_rows=10**9), policy))
    assert sliced.drop(SLICE).exceptAll(plain.drop(SLICE)).count() == 0 and sliced.count() == df.count()
    sizes = [r["count"] for r in sliced.filter("customer_id = 'hot'").groupBy(SLICE).count().collect()]
    assert len(sizes) >= 25 and max(sizes) <= 2 * policy.hot_rows

    flags = {"burst": (5, 300)}
    plain, sliced = (look_back(df, ["latitude"], flags, keep_slice=True, policy=p) for p in (SkewPolicy(hot_rows=10**9), policy))
    assert sliced.drop(SLICE).exceptAll(plain.drop(SLICE)).count() == 0 and sliced.count() == df.count()
    sizes = [r["count"] for r in sliced.filter("customer_id = 'hot'").groupBy(SLICE).count().collect()]
    assert len(sizes) >= 25 and max(sizes) <= 2 * policy.hot_rows


def test_expiries_of_a_burst_are_cut_too(spark):
    df = bursts(spark, 8_000)
    cuts = rolling_cuts(df, [3600], tick=F.unix_seconds("timestamp"), key="customer_id", policy=SkewPolicy(hot_rows=1_000))
    (hot,) = cuts.collect()
    borders = [b for chunk in hot["_cuts"] for b in chunk]
    order = [(b["at"] is not None, b["at"] or 0, b["id"]) for b in borders]
    assert order == sorted(order) and sum(b["at"] == 1704067200 + 3601 for b in borders) >= 5
    assert all(len(chunk) <= hot["_width"] for chunk in hot["_cuts"]) and len(hot["_cuts"]) <= hot["_width"] + 1
