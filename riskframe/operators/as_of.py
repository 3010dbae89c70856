"""Features as of the transaction: only what happened strictly before it counts, so nothing looks ahead.

Rows never enter a window. Each key's rows are first added up per tick (one row for each key and instant, combined
before the shuffle), first uses of an entity by a customer being events of their own; the running totals before each
tick are prefix sums over the ticks, and transactions look theirs up by (key, instant). A burst of millions of rows
within one instant is one tick.

A key with more ticks than ``SkewPolicy.hot_rows`` is cut into slices of about that many ticks. Their borders are
quantiles of its own ticks, not of the clock, so a dense hour is many slices and a sparse year is one.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.columns import cents, epoch_micros, from_cents
from riskframe.operators.entity import DEVICE, IP, EntityKind
from riskframe.operators.skew import DEFAULT_POLICY, SLICE, SkewPolicy, splittable
from riskframe.sources.schemas import require

#: Quantiles of a key's ticks among which borders are chosen, and the accuracy of the sketch.
QUANTILES, ACCURACY = 1024, 10_000


def row_borders(ticks: DataFrame, key: str, at: str, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """(_hot_key, _borders): ascending instants that cut the ticks of each large key into slices of ``hot_rows``.

    Large keys are found first, so the sketch is built for them alone. All borders together are about as many as
    the ticks of large keys over ``hot_rows``, and the table may be broadcast. A border opens its slice.
    """
    sizes = ticks.groupBy(F.col(key).alias("_hot_key")).agg(F.count(F.lit(1)).alias("_ticks")).filter(F.col("_ticks") > policy.hot_rows)
    shares = [i / QUANTILES for i in range(1, QUANTILES)]
    hot = ticks.join(F.broadcast(sizes), F.col(key) == F.col("_hot_key"))
    sketches = hot.groupBy("_hot_key").agg(F.first("_ticks").alias("_ticks"), F.percentile_approx(at, shares, ACCURACY).alias("_cuts"))
    wanted = F.least(F.lit(QUANTILES), F.ceil(F.col("_ticks") / policy.hot_rows))
    opens = lambda x, i: F.floor((i + 1) * wanted / QUANTILES) > F.floor(i * wanted / QUANTILES)
    return sketches.select("_hot_key", F.array_sort(F.array_distinct(F.filter("_cuts", opens))).alias("_borders"))


def totals_before(
    ticks: DataFrame, key: str, at: str, sums: Mapping[str, str], maxima: Mapping[str, str], policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """(key, at, totals): for each tick the sums and maxima over the key's earlier ticks; null where there are none.

    ``ticks`` has one row for each (key, at), neither null. ``sums`` and ``maxima`` map a new name to a column.
    """
    borders = F.broadcast(row_borders(ticks, key, at, policy))
    number = F.coalesce(F.size(F.filter("_borders", lambda b: b <= F.col(at))), F.lit(0))
    sliced = ticks.join(borders, F.col(key) == F.col("_hot_key"), "left")
    sliced = sliced.withColumn(SLICE, F.when(F.col("_borders").isNull(), 0).otherwise(number))
    measures = [(name, c, F.sum) for name, c in sums.items()] + [(name, c, F.max) for name, c in maxima.items()]

    earlier = Window.partitionBy(key).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    per_slice = sliced.filter(F.col("_borders").isNotNull()).groupBy(key, SLICE).agg(*[f(c).alias(name) for name, c, f in measures])
    opening = per_slice.select(key, SLICE, *[f(name).over(earlier).alias(f"_opening_{name}") for name, _, f in measures])

    before = Window.partitionBy(key, SLICE).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    inside = sliced.select(key, at, SLICE, *[f(c).over(before).alias(name) for name, c, f in measures])
    joined = inside.join(opening, [key, SLICE], "left")
    both = []
    for name, _, f in measures:
        mine, carried = F.col(name), F.col(f"_opening_{name}")
        total = F.greatest(mine, carried) if f is F.max else F.coalesce(mine + carried, mine, carried)
        both.append(total.alias(name))
    return joined.select(key, at, *both)


def _entity_ticks(rows: DataFrame, kind: EntityKind) -> tuple[DataFrame, DataFrame]:
    """Ticks of an entity (transactions, frauds, customers seen for the first time), and each pair's first use."""
    timed = rows.filter(F.col(kind.key).isNotNull() & F.col("_at").isNotNull())
    first = timed.filter(F.col("customer_id").isNotNull()).groupBy("customer_id", kind.key).agg(F.min("_at").alias("_first"))
    seen = timed.select(kind.key, "_at", F.lit(1).alias("_n"), F.coalesce(F.col("is_fraud"), F.lit(False)).cast("int").alias("_fraud"), F.lit(0).alias("_new"))
    fresh = first.select(kind.key, F.col("_first").alias("_at"), F.lit(0).alias("_n"), F.lit(0).alias("_fraud"), F.lit(1).alias("_new"))
    ticks = seen.unionByName(fresh).groupBy(kind.key, "_at").agg(*[F.sum(c).alias(c) for c in ("_n", "_fraud", "_new")])
    return ticks, first


def entity_as_of(rows: DataFrame, kind: EntityKind, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Append what was known of the row's entity before ``_at``, and whether its customer had used it."""
    p = kind.prefix
    ticks, first = _entity_ticks(rows, kind)
    before = totals_before(ticks, kind.key, "_at", {"_txns": "_n", "_frauds": "_fraud", "_customers": "_new"}, {}, policy)
    joined = rows.join(splittable(before), [kind.key, "_at"], "left").join(splittable(first), ["customer_id", kind.key], "left")
    count = lambda name: F.coalesce(name, F.lit(0).cast("bigint"))
    known = F.coalesce(F.col("_first") < F.col("_at"), F.lit(False))
    risk = F.when(count("_txns") > 0, kind.risk(count("_customers"))).otherwise(F.lit(0.0))
    return joined.select(
        *rows.columns,
        count("_customers").alias(f"{p}_customers_before"),
        count("_txns").alias(f"{p}_txns_before"),
        F.when(count("_txns") > 0, F.col("_frauds") / F.col("_txns")).otherwise(F.lit(0.0)).alias(f"{p}_fraud_rate_before"),
        risk.alias(f"{p}_risk_before"),
        (~known).alias(f"is_new_{p}_then"),
    )


def _deviation(n: Column, total: Column, squares: Column) -> Column:
    """Sample deviation from exact sums of cents and of their squares; null below two values."""
    spread = n.cast("decimal(12,0)") * squares.cast("decimal(25,0)") - total.cast("decimal(18,0)") * total.cast("decimal(18,0)")
    return F.when(n > 1, F.sqrt(spread.cast("double") / (n.cast("double") * (n - 1).cast("double"))) / 100.0)


def customer_as_of(rows: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Append number, mean, deviation and maximum of the customer's amounts before ``_at``."""
    amount = cents(F.col("amount"))
    timed = rows.filter(F.col("customer_id").isNotNull() & F.col("_at").isNotNull())
    ticks = timed.groupBy("customer_id", "_at").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count(amount).alias("_amounts"),
        F.coalesce(F.sum(amount), F.lit(0)).alias("_sum"),
        F.coalesce(F.sum(amount.cast("decimal(19,0)") * amount), F.lit(0)).cast("decimal(25,0)").alias("_squares"),
        F.max("amount").alias("_max"),
    )
    sums = {"_txns": "_n", "_known": "_amounts", "_total": "_sum", "_square": "_squares"}
    before = totals_before(ticks, "customer_id", "_at", sums, {"_most": "_max"}, policy)
    joined = rows.join(splittable(before), ["customer_id", "_at"], "left")
    mean = F.when(F.col("_known") > 0, from_cents(F.col("_total")) / F.col("_known"))
    deviation = F.coalesce(_deviation(F.col("_known"), F.col("_total"), F.col("_square")), F.lit(1.0))
    return joined.select(
        *rows.columns,
        F.coalesce("_txns", F.lit(0).cast("bigint")).alias("cust_txns_before"),
        mean.alias("cust_avg_before"),
        deviation.alias("cust_std_before"),
        F.col("_most").alias("cust_max_before"),
        F.when(mean > 0, F.col("amount") / mean).otherwise(F.lit(1.0)).alias("amount_vs_avg_before"),
        F.when(mean.isNotNull() & (deviation > 0), (F.col("amount") - mean) / deviation).otherwise(F.lit(0.0)).alias("z_score_before"),
    )


#: What identifies the transaction in the result.
IDENTITY = ("transaction_id", "customer_id", "device_id", "ip_address", "timestamp", "amount")


def fraud_features_as_of(txns: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Device, IP and customer history of each transaction as it stood right before it, one row for each row.

    Transactions of one instant do not see each other. A row without time sees nothing and is seen by nobody; a
    missing entity or customer has no history, so its counts are 0 and the entity is new. Customers without id count
    as transactions of an entity, not as its customers. Without earlier amounts the mean and maximum are null, the
    deviation is 1.0 below two amounts, the ratio 1.0 and the score 0.0.
    """
    require(txns, *IDENTITY, "is_fraud")
    rows = txns.select(*IDENTITY, "is_fraud", epoch_micros(F.col("timestamp")).alias("_at"))
    for kind in (DEVICE, IP):
        rows = entity_as_of(rows, kind, policy)
    return customer_as_of(rows, policy).drop("_at", "is_fraud")
