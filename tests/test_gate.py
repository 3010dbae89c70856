"""Rows that a watermark would drop are kept aside, and nothing behind the gate is dropped."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskframe.streaming.gate import IN_TIME, LATE, TIMELESS, Gate
from riskframe.streaming.io import file_stream, run_available
from riskframe.streaming.windows import tumbling

START = datetime(2024, 1, 1)
SCHEMA = StructType().add("transaction_id", "string").add("customer_id", "string").add("amount", "double").add("timestamp", "timestamp")


def row(name, hours):
    return (name, "C", 1.0, None if hours is None else START + timedelta(hours=hours))


BATCHES = [
    [row("a", 0), row("b", 5), row("c", None), row("d", 0.5)],
    # 4 hours is the border with a delay of one hour: still in time.
    [row("e", 4), row("f", 3.99), row("g", 9), row("h", 4.5)],
    [row("i", None)],
    [row("j", 7.9), row("k", 8), row("l", 20)],
]
EXPECTED = {
    "a": (0, IN_TIME), "b": (0, IN_TIME), "c": (0, TIMELESS), "d": (0, IN_TIME),
    "e": (1, IN_TIME), "f": (1, LATE), "g": (1, IN_TIME), "h": (1, IN_TIME),
    "i": (2, TIMELESS), "j": (3, LATE), "k": (3, IN_TIME), "l": (3, IN_TIME),
}


def deliver(spark, gate, folder, batches):
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(folder)
        gate.run_available(file_stream(spark, folder, SCHEMA))


def sides(gate):
    return {r["transaction_id"]: (r["batch"], r["reason"]) for side in (gate.passed(), gate.aside()) for r in side.collect()}


def test_sides_marks_and_what_follows(spark, tmp_path):
    gate = Gate(spark, str(tmp_path / "gate"), SCHEMA)
    deliver(spark, gate, str(tmp_path / "in"), BATCHES)
    assert sides(gate) == EXPECTED
    assert gate.passed().count() + gate.aside().count() == sum(map(len, BATCHES))
    marks = [(r["in_time"], r["late"], r["no_time"], r["latest"]) for r in gate.marks().orderBy("batch").collect()]
    hours = lambda h: START + timedelta(hours=h)
    assert marks == [(3, 0, 1, hours(5)), (3, 1, 0, hours(9)), (0, 0, 1, hours(9)), (2, 1, 0, hours(20))]
    # Windows up to 19 o'clock are closed; no row in time is lost in them.
    counted = run_available(tumbling(gate.live()), "test-gated")
    assert counted.agg(F.sum("txn_count")).first()[0] == len([v for v in EXPECTED.values() if v[1] == IN_TIME]) - 1


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    gate = Gate(spark, str(tmp_path / "gate"), SCHEMA)
    frames = [spark.createDataFrame(rows, SCHEMA) for rows in BATCHES]
    gate.admit(frames[0], 0)
    gate.admit(frames[0], 0)
    gate.admit(frames[1], 1)
    # Died after the rows, before the mark.
    gate._fs.delete(gate._path(f"{gate.folder}/marks/number=1"), True)
    gate.admit(frames[1], 1)
    gate.admit(frames[2], 2)
    gate.admit(frames[3], 3)
    assert sides(gate) == EXPECTED and gate.marks().count() == 4
    assert gate.passed().count() + gate.aside().count() == 12


def test_empty_and_clashing(spark, tmp_path):
    gate = Gate(spark, str(tmp_path / "gate"), SCHEMA)
    assert gate.passed().count() == gate.aside().count() == gate.marks().count() == 0
    gate.admit(spark.createDataFrame([], SCHEMA), 0)
    gate.admit(spark.createDataFrame([row("a", 1)], SCHEMA), 1)
    assert sides(gate) == {"a": (1, IN_TIME)}
    with pytest.raises(ValueError, match="reason"):
        Gate(spark, str(tmp_path / "other"), StructType([*SCHEMA.fields]).add("reason", "string"))
