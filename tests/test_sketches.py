"""Sketches of days unite to those of a span, within the stated error."""

from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from riskframe.operators.sketches import DAY, daily_sketches, distinct_between, error_bound, merged

START = datetime(2024, 1, 1)


def test_spans_of_large_keys(spark):
    """200,000 rows of one key, half of the values shared with the day before."""
    rows = spark.range(200_000).select(
        F.lit("D").alias("k"),
        (F.col("id") % 20_000 + 10_000 * F.floor(F.col("id") / 20_000)).cast("string").alias("v"),
        F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, cast(floor(id / 20000) as int))").alias("timestamp"),
    )
    daily = daily_sketches(rows, "k", {"values": "v"})
    assert daily.count() == 10
    for first, last, exact in ((0, 0, 20_000), (2, 4, 40_000), (0, 9, 110_000)):
        bounds = [F.lit(date(2024, 1, 1 + d)) for d in (first, last)]
        row = distinct_between(daily, "k", *bounds).withColumn("bound", error_bound(F.lit(exact))).first()
        assert row["row_count"] == 20_000 * (last - first + 1) and abs(row["values"] - exact) <= row["bound"] < 0.09 * exact
    assert "Expand" not in daily._jdf.queryExecution().toString()


def test_loads_merge_and_nulls(spark):
    ddl = "k string, v string, w int, timestamp timestamp"
    day = lambda d: START + timedelta(days=d)
    rows = [("A", "x", 1, day(0)), ("A", "y", 1, day(0)), ("A", "x", None, day(1)), ("B", None, None, day(0)), ("C", "x", 2, None), (None, "x", 1, day(0))]
    loads = [spark.createDataFrame(r, ddl) for r in (rows[:3], rows[2:])]
    daily = merged(daily_sketches(loads[0], "k", {"vs": "v", "ws": "w"}).unionByName(daily_sketches(loads[1], "k", {"vs": "v", "ws": "w"})), "k")
    assert daily.groupBy("k", DAY).count().filter("count > 1").count() == 0
    found = {r["k"]: tuple(r)[1:] for r in distinct_between(daily, "k").collect()}
    assert found == {"A": (4, 2, 1), "B": (1, 0, 0), "C": (1, 1, 1)}
    late = {r["k"]: tuple(r)[1:] for r in distinct_between(daily, "k", F.lit(date(2024, 1, 2))).collect()}
    assert late == {"A": (2, 1, 0)}
    assert distinct_between(daily.limit(0), "k").count() == 0
