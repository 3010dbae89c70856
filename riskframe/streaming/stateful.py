"""Exact rolling velocity and new-entity flags over a stream, with keyed state.

Both follow one pattern. Rows are first aggregated per key and second, with map-side combine; Spark
emits a second once, when the watermark has passed it. A small state per key turns those totals into
answers per second, and a stream-stream join on (key, second) brings the answers back to the rows. No
task ever gathers the rows of a customer: what reaches a state is at most one row per second. Most keys bring few
seconds, so the states take plain rows: a data frame for each key would cost more than the work on it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from riskframe.functions.columns import cents, epoch_micros
from riskframe.operators.entity import DEVICE, EntityKind
from riskframe.operators.skew import OWNER, with_owner
from riskframe.operators.velocity import NO_PREVIOUS_SECONDS, WINDOWS
from riskframe.streaming.windows import WATERMARK

ENTITY = "_entity"
MEASURES = [f"{m}_last_{s}" for s, _ in WINDOWS for m in ("txns", "spend")]


class VelocityProcessor(StatefulProcessor):
    """Turns closed seconds of a customer (count, cents, first id) into window totals.

    Seconds arrive in rounds of increasing time, since the aggregation before emits a second once,
    when the watermark passes it. So each round can be handled at once. What a later second can still look back to is
    one value, read and written once a round, since each call to the state costs more than the few seconds of a usual
    customer. A timer drops the seconds of a customer who has been silent for the longest window; the time of the last
    transaction stays, for the gap.
    """

    reach = max(seconds for _, seconds in WINDOWS)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # 64-bit integers side by side: at most one of each for every second of the longest window.
        self.recent = handle.getValueState("recent", "seconds binary, counts binary, cents binary, last bigint")

    def _timer(self, last: int) -> int:
        return (last + self.reach + 1) * 1000

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        fresh = sorted(rows, key=lambda r: r["second"])
        stored = self.recent.get() or (b"", b"", b"", None)
        held, last = [np.frombuffer(x, np.int64) for x in stored[:3]], stored[3]
        now, counts, cents_ = (np.array([r[c] for r in fresh], np.int64) for c in ("second", "counts", "cents"))
        parts = [np.concatenate(pair) for pair in zip(held, (now, counts, cents_), strict=True)]
        at = parts[0]
        running_n = np.concatenate([[0], np.cumsum(parts[1])])
        running_c = np.concatenate([[0], np.cumsum(parts[2])])

        upto = np.searchsorted(at, now, side="right")
        measures = []
        for _, length in WINDOWS:
            since = np.searchsorted(at, now - length, side="left")
            measures.append((running_n[upto] - running_n[since] - 1).tolist())
            measures.append(((running_c[upto] - running_c[since]) / 100.0).tolist())
        gap = np.diff(now, prepend=now[0])
        gap[0] = NO_PREVIOUS_SECONDS if last is None else now[0] - last
        measures.append(gap.tolist())

        if len(held[0]):
            self.handle.deleteTimer(self._timer(last))
        last = int(now[-1])
        kept = np.searchsorted(at, last + 1 - self.reach, side="left")
        self.recent.update((*(x[kept:].tobytes() for x in parts), last))
        self.handle.registerTimer(self._timer(last))
        answer = Row(OWNER, "event_time", "first_id", *MEASURES, "seconds_since_last_txn")
        for r, *values in zip(fresh, *measures, strict=True):
            yield answer(key[0], r["event_time"], r["first_id"], *values)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """Only the latest timer is kept, so no stored second can matter any more."""
        self.recent.update((b"", b"", b"", self.recent.get()[3]))
        yield from ()


class FirstUseProcessor(StatefulProcessor):
    """Remembers that a pair has been seen; per second, the id of the row that was first ever."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean")

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self.seen.update((True,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        seconds = sorted(rows, key=lambda r: r["event_time"])
        new = not self.seen.exists()
        if new:
            self.seen.update((True,))
        answer = Row(OWNER, ENTITY, "event_time", "first_id")
        for n, r in enumerate(seconds):
            yield answer(key[0], key[1], r["event_time"], r["first_id"] if new and not n else None)


def _timed(stream: DataFrame) -> DataFrame:
    """Rows with an owner and the event time of their second, which is its last microsecond, as
    ``window_time`` has it."""
    last_micro = F.floor(epoch_micros(F.col("timestamp")) / F.lit(1_000_000)) * 1_000_000 + 999_999
    timed = stream.filter(F.col("timestamp").isNotNull())
    return with_owner(timed).withColumn("event_time", F.timestamp_micros(last_micro))


def stream_velocity(stream: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """The seven velocity columns per transaction, emitted once the watermark has passed its second.

    State per customer: one (count, cents) per second of the last seven days.
    """
    windows = ", ".join(f"txns_last_{s} bigint, spend_last_{s} double" for s, _ in WINDOWS)
    timed = _timed(stream)
    totals = (
        timed.withWatermark("timestamp", watermark)
        .groupBy(F.window("timestamp", "1 second"), OWNER)
        .agg(
            F.count("transaction_id").alias("counts"),
            F.coalesce(F.sum(cents(F.col("amount"))), F.lit(0).cast("bigint")).alias("cents"),
            F.min("transaction_id").alias("first_id"),
        )
        .select(
            OWNER,
            F.window_time("window").alias("event_time"),
            F.unix_seconds("window.start").alias("second"),
            "counts",
            "cents",
            "first_id",
        )
        .groupBy(OWNER)
        .transformWithState(
            statefulProcessor=VelocityProcessor(),
            outputStructType=f"{OWNER} string, event_time timestamp, first_id string, {windows}, seconds_since_last_txn bigint",
            outputMode="Append",
            timeMode="EventTime",
            eventTimeColumnName="event_time",
        )
    )
    rows = timed.select("customer_id", OWNER, "transaction_id", "event_time").withWatermark("event_time", watermark)
    # In a second with several rows, only the first looks back to an earlier second.
    gap = F.when(F.col("transaction_id") == F.col("first_id"), F.col("seconds_since_last_txn")).otherwise(F.lit(0))
    return rows.join(totals, [OWNER, "event_time"]).select(
        "customer_id", "transaction_id", *MEASURES, gap.cast("bigint").alias("seconds_since_last_txn")
    )


def stream_new_entity(
    stream: DataFrame, kind: EntityKind = DEVICE, watermark: str = WATERMARK, known: DataFrame | None = None
) -> DataFrame:
    """Point-in-time flag ``is_new_<prefix>``: is this the customer's first use of the device (or IP)?

    A row without an entity is always new. ``known`` (customer_id, entity key) lists pairs that were
    in use before the stream began.
    """
    missing = "\u0000"
    timed = _timed(stream).withColumn(ENTITY, F.coalesce(F.col(kind.key), F.lit(missing)))
    earliest = F.min(F.struct("timestamp", "transaction_id"))
    seeds = None
    if known is not None:
        pairs = with_owner(known.select("customer_id", kind.key)).withColumnRenamed(kind.key, ENTITY)
        seeds = pairs.select(OWNER, ENTITY).distinct().groupBy(OWNER, ENTITY)
    firsts = (
        timed.withWatermark("timestamp", watermark)
        .groupBy(F.window("timestamp", "1 second"), OWNER, ENTITY)
        .agg(earliest.alias("earliest"))
        .select(OWNER, ENTITY, F.window_time("window").alias("event_time"), F.col("earliest.transaction_id").alias("first_id"))
        .groupBy(OWNER, ENTITY)
        .transformWithState(
            statefulProcessor=FirstUseProcessor(),
            outputStructType=f"{OWNER} string, {ENTITY} string, event_time timestamp, first_id string",
            outputMode="Append",
            timeMode="EventTime",
            initialState=seeds,
            eventTimeColumnName="event_time",
        )
    )
    rows = timed.select("customer_id", OWNER, "transaction_id", ENTITY, "event_time").withWatermark("event_time", watermark)
    first = F.coalesce(F.col("first_id") == F.col("transaction_id"), F.lit(False))
    return rows.join(firsts, [OWNER, ENTITY, "event_time"]).select(
        "customer_id",
        "transaction_id",
        F.when(F.col(ENTITY) != missing, F.col(ENTITY)).alias(kind.key),
        ((F.col(ENTITY) == missing) | first).alias(f"is_new_{kind.prefix}"),
    )
