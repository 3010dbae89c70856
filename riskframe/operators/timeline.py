"""Per-customer ordered computations that stay linear and split hot customers.

Rolling sums use arrival and expiry events: a row adds to every window when it arrives and
subtracts from the window of length W one tick after W has passed. A running sum over the
events then *is* the sliding sum. Spark re-aggregates the whole frame for each row of a
``rangeBetween(-W, 0)`` window, which is quadratic in the rows per frame; a running sum is
incremental, so a dense customer costs a sort and one pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.functions.columns import cents, epoch_micros, from_cents
from riskframe.operators.skew import DEFAULT_POLICY, SLICE, WHOLE, SkewPolicy, add_slice, row_cuts


@dataclass(frozen=True)
class RollingWindow:
    """A trailing window of ``ticks``; both ends belong to it."""

    ticks: int
    count_as: str
    sum_as: str


def rolling_cuts(
    df: DataFrame, ticks: Sequence[int], *, tick: Column, key: str, row_id: str = "transaction_id", policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Borders for rolling sums over windows of these lengths: a row counts when it arrives and when it expires."""
    expiries = [tick + F.lit(length + 1).cast("bigint") for length in ticks]
    moments = F.when(tick.isNull(), F.array(tick)).otherwise(F.array(tick, *expiries))
    return row_cuts(df, key, moments, row_id, policy)


def rolling_sums(
    df: DataFrame,
    windows: Sequence[RollingWindow],
    *,
    tick: Column,
    counted: Column,
    key: str = "customer_id",
    row_id: str = "transaction_id",
    amount: str = "amount",
    previous_tick_as: str | None = None,
    keep_slice: bool = False,
    policy: SkewPolicy = DEFAULT_POLICY,
    cuts: DataFrame | None = None,
) -> DataFrame:
    """Append, per window, the number of other rows and the sum of ``amount`` in it.

    The row itself is part of the sum but not of the count; rows tied in time see each other,
    and rows without time form a group of their own. ``previous_tick_as`` also appends the
    tick of the preceding row (null for the first). One shuffle on (key, slice) and one sort
    serve all windows; ``cuts`` may bring borders found on a cheaper input. ``keep_slice`` leaves
    ``_slice`` in place, so that later joins can use the partitioning.
    """
    kept = df.columns
    if cuts is None:
        cuts = rolling_cuts(df, [w.ticks for w in windows], tick=tick, key=key, row_id=row_id, policy=policy)
    numbers = range(1, len(windows) + 1)
    lifetimes = F.array(F.lit(0).cast("bigint"), *[F.lit(w.ticks + 1).cast("bigint") for w in windows])

    # Kind 0 is an arrival, kind i the expiry from window i. The row itself travels with its
    # arrival, packed in one column, so expiry events stay narrow in the shuffle and the sort.
    arrival = F.col("_kind") == 0
    measures = [tick.alias("_tick"), counted.cast("bigint").alias("_one"), cents(F.col(amount)).alias("_cents")]
    moments = (
        df.select("*", *measures)
        .withColumn("_kind", F.explode(F.array(*[F.lit(i) for i in (0, *numbers)])))
        .filter(arrival | F.col("_tick").isNotNull())
        .withColumn("_at", F.col("_tick") + F.element_at(lifetimes, F.col("_kind") + 1))
    )
    carried_by = [
        F.col(key),
        "_at",
        F.when(arrival, F.col("_tick")).alias("_seen"),
        "_kind",
        "_one",
        "_cents",
    ]
    events = add_slice(moments, key, F.col("_at"), F.col(row_id), cuts).select(
        *carried_by,
        SLICE,
        F.when(arrival, F.col(row_id)).alias("_id"),
        F.when(arrival, F.struct(*[c for c in kept if c != key])).alias("_row"),
    )

    def change(of: str, i: int) -> Column:
        """What an event adds to window ``i``."""
        return F.expr(f"CASE WHEN _kind IN (0, -{i}) THEN {of} WHEN _kind = {i} THEN -{of} ELSE 0 END")

    changed = {f"_n{i}": change("_one", i) for i in numbers} | {f"_s{i}": change("_cents", i) for i in numbers}

    sliced = add_slice(moments, key, F.col("_at"), F.col(row_id), cuts, only_cut=True, opens_as="_opens")
    carried = _context(sliced.select(*carried_by, SLICE, "_opens"), key, changed, numbers)

    # Timeless rows are a group of their own, outside every running sum.
    # Sorting here settles the order of ties for the row frame; the window's own requirement is a
    # prefix of it, so one sort and one window operator serve everything.
    group = [key, SLICE, "_timeless"]
    so_far = Window.partitionBy(*group).orderBy("_at")
    before = so_far.rowsBetween(Window.unboundedPreceding, -1)
    running = (
        events.unionByName(carried, allowMissingColumns=True)
        .withColumn("_timeless", F.col("_at").isNull())
        .repartition(F.col(key), F.col(SLICE))
        .sortWithinPartitions(*group, "_at", "_id", "_kind")
        .select(
            key,
            SLICE,
            "_row",
            "_kind",
            *[F.sum(changed[f"_n{i}"]).over(so_far).alias(f"_n{i}") for i in numbers],
            *[F.sum(changed[f"_s{i}"]).over(so_far).alias(f"_s{i}") for i in numbers],
            *([F.max("_seen").over(before).alias(previous_tick_as)] if previous_tick_as else []),
        )
        .filter(arrival)
    )

    result = [F.col(key) if c == key else F.col(f"_row.{c}") for c in kept]
    for i, window in zip(numbers, windows):
        # The count leaves the row itself out.
        result.append((F.col(f"_n{i}") - 1).alias(window.count_as))
        result.append(from_cents(F.coalesce(F.col(f"_s{i}"), F.lit(0))).alias(window.sum_as))
    if previous_tick_as:
        result.append(F.col(previous_tick_as))
    if keep_slice:
        result.append(F.col(SLICE))
    return running.select(*result)


def _context(events: DataFrame, key: str, changed: Mapping[str, Column], numbers: Sequence[int]) -> DataFrame:
    """The rows that make each slice's running sums those of the whole key, from one total for each slice.

    A slice opens with all earlier slices. Peers see each other across borders: where the next slice opens within an
    instant, what lies at that instant behind the border is added to this slice at that instant. Timeless rows see
    those of the other slices. Kind -i stands for window i.
    """
    timed, timeless, at_border = F.col("_at").isNotNull(), F.col("_at").isNull(), F.col("_at") == F.col("_opens")
    kinds = {"_all": timed, "_head": at_border, "_idle": timeless}
    totals = events.groupBy(key, SLICE).agg(
        F.first("_opens").alias("_opens"),
        F.max("_seen").alias("_seen"),
        *[F.sum(F.when(those, added)).alias(kind + name) for kind, those in kinds.items() for name, added in changed.items()],
    )
    in_order = Window.partitionBy(key).orderBy(SLICE)
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.partitionBy(key, "_opens").orderBy(F.desc(SLICE)).rowsBetween(Window.unboundedPreceding, 0)
    everywhere = Window.partitionBy(key)
    zero = F.lit(0).cast("bigint")
    summed = totals.select(
        key,
        SLICE,
        "_opens",
        F.max("_seen").over(earlier).alias("_seen"),
        *[F.sum(f"_all{name}").over(earlier).alias(f"_all{name}") for name in changed],
        *[F.sum(f"_head{name}").over(onward).alias(f"_head{name}") for name in changed],
        *[
            (F.sum(f"_idle{name}").over(everywhere) - F.coalesce(f"_idle{name}", zero)).alias(f"_idle{name}")
            for name in changed
        ],
    )
    behind = summed.select(
        "*",
        F.lead("_opens").over(in_order).alias("_border"),
        *[F.lead(f"_head{name}").over(in_order).alias(f"_next{name}") for name in changed],
    )

    def rows(kind: str, at: Column, seen: Column) -> list[Column]:
        return [
            F.struct(
                at.alias("_at"),
                seen.cast("bigint").alias("_seen"),
                F.lit(-i).alias("_kind"),
                F.col(f"{kind}_n{i}").alias("_one"),
                F.col(f"{kind}_s{i}").alias("_cents"),
            )
            for i in numbers
        ]

    nothing = F.lit(None).cast("bigint")
    openings = F.when(F.col("_opens").isNotNull(), F.array(*rows("_all", F.col("_opens"), F.col("_seen"))))
    closings = F.when(F.col("_border").isNotNull(), F.array(*rows("_next", F.col("_border"), nothing)))
    others = F.array(*rows("_idle", nothing, nothing))
    none = F.filter(others, lambda row: F.lit(False))
    together = F.concat(F.coalesce(openings, none), F.coalesce(closings, none), others)
    return behind.select(key, SLICE, F.inline(together))


def look_back(
    df: DataFrame,
    previous: Sequence[str] = (),
    bursts: Mapping[str, tuple[int, int]] | None = None,
    *,
    key: str = "customer_id",
    row_id: str = "transaction_id",
    time: str = "timestamp",
    keep_slice: bool = False,
    policy: SkewPolicy = DEFAULT_POLICY,
    cuts: DataFrame | None = None,
) -> DataFrame:
    """Append what each row sees of the rows before it, in (time, row id) order.

    ``previous`` adds ``prev_<column>`` of the row before, null for the first. ``bursts`` maps a
    flag to ``(n, seconds)``: true if the n-th row before lies less than ``seconds`` back. A row without
    time precedes and follows nothing: it has no previous row and is nobody's.

    A slice of a hot key opens with context rows: copies of the last rows before it, as many as a burst counts.
    """
    kept = df.columns
    bursts = bursts or {}
    at = epoch_micros(F.col(time))
    cuts = row_cuts(df, key, F.array(at), row_id, policy) if cuts is None else cuts
    depth = max([n for n, _ in bursts.values()] + [1])
    timed = F.col(time).isNotNull()

    # Each slice hands on at most ``depth`` rows; as none of them is empty, so many slices before are enough.
    context = [time, row_id, *sorted({*previous} - {key, row_id, time})]
    mine = add_slice(df.filter(timed).select(key, *context), key, at, F.col(row_id), cuts, only_cut=True)
    backward = Window.partitionBy(key, SLICE).orderBy(F.desc(time), F.desc(row_id))
    reached = Window.partitionBy(key).orderBy(SLICE).rowsBetween(-depth, -1)
    before = F.reverse(F.flatten(F.collect_list("_tail").over(reached)))
    carried = (
        mine.withColumn("_back", F.row_number().over(backward))
        .filter(F.col("_back") <= depth)
        .groupBy(key, SLICE)
        .agg(F.array_sort(F.collect_list(F.struct(*context))).alias("_tail"))
        .select(key, SLICE, before.alias("_before"))
        .select(key, SLICE, F.inline(F.slice("_before", 1, depth)))
        .withColumn("_context", F.lit(True))
    )
    rows = add_slice(df, key, at, F.col(row_id), cuts).withColumn("_context", F.lit(False))
    rows = rows.unionByName(carried, allowMissingColumns=True)

    order = Window.partitionBy(key, SLICE, timed).orderBy(F.col(time), F.col(row_id))
    seen = [F.when(timed, F.lag(c).over(order)).alias(f"prev_{c}") for c in previous]
    for name, (n, seconds) in bursts.items():
        recent = at - epoch_micros(F.lag(time, n).over(order)) < seconds * 1_000_000
        seen.append(F.coalesce(recent, F.lit(False)).alias(name))
    names = [f"prev_{c}" for c in previous] + list(bursts)
    return (
        rows.repartition(F.col(key), F.col(SLICE))
        .select(*kept, SLICE, "_context", *seen)
        .filter(~F.col("_context"))
        .select(*kept, *names, *([SLICE] if keep_slice else []))
    )
