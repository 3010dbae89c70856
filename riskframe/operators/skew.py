"""Hot keys: cutting their timeline into slices of rows.

A window function puts a whole key into one task, so a customer that owns a third of
all rows would own a third of the run time. The timeline of a large customer, in (time, row id) order, is
therefore cut after about every ``SkewPolicy.hot_rows`` rows; what a slice needs from earlier ones enters it as a few
context rows made from per-slice aggregates. Borders lie between rows, not on the clock: a burst of one second
is cut like any other stretch. Joins need none of this: adaptive execution splits their
skewed partitions. Aggregations combine on the map side.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SLICE = "_slice"
OWNER = "_owner"
MOST_CUTS = 200_000
SAMPLES = 16  # sampled rows for each slice
WHOLE = -1  # the slice number of an undivided key


@dataclass(frozen=True)
class SkewPolicy:
    """``hot_rows``: rows of a slice on average, with a standard deviation of a quarter; smaller keys stay whole."""

    hot_rows: int = 2_000_000


DEFAULT_POLICY = SkewPolicy()


def row_cuts(df: DataFrame, key: str, moments: Column, row_id: str, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """(_hot_key, _width, _cuts): where the timelines of large keys are cut, in chunks of ``_width`` ascending borders.

    A row stands at each instant of the array ``moments``, under its ``row_id``; a border opens its slice. A sample by
    hash of one in ``hot_rows / SAMPLES`` is numbered within its key, and every ``SAMPLES``-th becomes a border, so one
    scan finds both the large keys and their borders. The table is broadcast: it has at most ``MOST_CUTS`` borders,
    of the largest keys. Borders beyond are left out, which costs time and changes no result: borders steer the layout
    only, so they may also come from the raw scan. Rows equal in key, time and id stay together.
    """
    rate = max(1, policy.hot_rows // SAMPLES)
    stride = max(1, policy.hot_rows // rate)
    points = df.select(F.col(key).alias("_hot_key"), F.explode(moments).alias("at"), F.col(row_id).alias("id"))
    of_key = Window.partitionBy("_hot_key")
    borders = (
        points.filter(F.pmod(F.xxhash64("at", "id"), F.lit(rate)) == 0)
        .select(
            "*",
            F.row_number().over(of_key.orderBy("at", "id")).alias("_place"),
            F.floor(F.count(F.lit(1)).over(of_key) / stride).alias("_borders"),
        )
        .filter(F.col("_place") % stride == 0)
        .orderBy(F.desc("_borders"), "_hot_key", "_place")
        .limit(MOST_CUTS)
        .withColumn("_width", F.ceil(F.sqrt("_borders")).cast("int"))
    )
    number = F.floor((F.col("_place") / stride - 1) / F.col("_width"))
    chunks = borders.groupBy("_hot_key", "_width", number.alias("_number")).agg(
        F.array_sort(F.collect_list(F.struct("at", "id"))).alias("_chunk")
    )
    keys = chunks.groupBy("_hot_key", "_width").agg(F.array_sort(F.collect_list(F.struct("_number", "_chunk"))).alias("_all"))
    return keys.select("_hot_key", "_width", F.transform("_all", lambda c: c["_chunk"]).alias("_cuts"))


def add_slice(
    df: DataFrame, key: str, at: Column, row_id: Column, cuts: DataFrame, *, only_cut: bool = False, opens_as: str | None = None
) -> DataFrame:
    """Append ``_slice``: the number of borders up to the row for keys that are cut, ``WHOLE`` for all other rows.

    ``only_cut`` keeps rows of keys that are cut and no others. ``opens_as`` also appends the instant of the border
    that opens the slice, null in the first one. The search looks at the first border of each chunk, then
    into one chunk: about twice the root of the number of borders.
    """
    me = F.struct(at.alias("at"), row_id.alias("id"))
    joined = df.join(F.broadcast(cuts), F.col(key).eqNullSafe(F.col("_hot_key")), "inner" if only_cut else "left")
    entered = F.size(F.filter("_cuts", lambda chunk: F.get(chunk, F.lit(0)) <= me))
    found = joined.withColumn("_entered", F.when(F.col("_cuts").isNotNull(), entered))
    found = found.withColumn("_chunk", F.when(F.col("_entered") > 0, F.get("_cuts", F.col("_entered") - 1)))
    passed = F.size(F.filter("_chunk", lambda border: border <= me))
    found = found.withColumn("_passed", F.when(F.col("_chunk").isNotNull(), passed))
    inside = (F.col("_entered") - 1) * F.col("_width") + F.col("_passed")
    number = F.when(F.col("_entered").isNull(), WHOLE).otherwise(F.coalesce(inside, F.lit(0))).cast("bigint")
    found = found.withColumn(SLICE, number)
    if opens_as:
        found = found.withColumn(opens_as, F.get("_chunk", F.col("_passed") - 1)["at"])
    return found.drop("_hot_key", "_width", "_cuts", "_entered", "_chunk", "_passed")


def with_owner(df: DataFrame, key: str = "customer_id") -> DataFrame:
    """Append ``_owner``: the key with a stand-in for null, so that rows without a key can be joined
    on plain equality, which is what reuses a partitioning."""
    return df.withColumn(OWNER, F.coalesce(F.col(key), F.lit("\u0000")))


def sliced_keys(df: DataFrame, at: Column, row_id: str, cuts: DataFrame, *columns: str) -> DataFrame:
    """Distinct (customer_id, owner, slice, columns) in use.

    Lookups expanded to these keys can be joined to rows that are already partitioned by
    (owner, slice): the wide rows stay where they are, and a hot key's lookups are spread like its
    rows. The key table is narrow and combines on the map side.
    """
    narrow = with_owner(df.select("customer_id", at.alias("_time"), F.col(row_id).alias("_order"), *columns))
    sliced = add_slice(narrow, OWNER, F.col("_time"), F.col("_order"), cuts)
    return sliced.select("customer_id", OWNER, SLICE, *columns).distinct()


def join_columns(keys: DataFrame) -> list[str]:
    """What to join on: the owner stands for the customer where there is one."""
    return [c for c in keys.columns if c != "customer_id" or OWNER not in keys.columns]


def splittable(lookup: DataFrame) -> DataFrame:
    """Let adaptive execution split the partitions of a join with ``lookup``.

    It does so only if both sides come straight from a shuffle made for that join. A lookup that was
    just aggregated, ranked or joined by (part of) the join columns is partitioned already: Spark would
    send the other side to those partitions, popular keys whole. Rebalancing drops that partitioning
    at the cost of moving the lookup, the smaller side, once more.
    """
    return lookup.hint("rebalance")


def attach(df: DataFrame, keys: DataFrame | None, lookups: Sequence[tuple[DataFrame, list[str]]]) -> DataFrame:
    """Left-join lookups (table, join columns) to ``df``; each must be unique in its columns.

    With ``keys`` (distinct combinations of join columns in ``df``, owner included) the lookups are
    joined to those first, which leaves a single join for the wide rows.
    """
    if not lookups:
        return df

    def joined(left: DataFrame) -> DataFrame:
        return reduce(lambda rows, lookup: rows.join(splittable(lookup[0]), lookup[1], "left"), lookups, left)

    return joined(df) if keys is None else join_spread(df, joined(keys), keys)


def join_spread(df: DataFrame, lookup: DataFrame, keys: DataFrame) -> DataFrame:
    """Left-join a lookup that was spread over ``keys``. Sliced keys are even by construction and meet
    ``df`` where it is; others are left to adaptive splitting."""
    on = join_columns(keys)
    lookup = lookup.drop(*[c for c in keys.columns if c not in on])
    return df.join(lookup if SLICE in on else splittable(lookup), on, "left")
