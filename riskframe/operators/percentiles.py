"""Exact percentiles for every key by selection in histograms: no key's amounts are ever sorted or held together.

Amounts become whole cents and are counted per (key, value), combined before the shuffle. A wanted rank is then
followed downwards through bins of 2^32, 2^16 and one cent: each step counts the bins inside the bin found so far,
so a window holds at most 2^16 rows of a key beside its bins of the top level.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.columns import cents
from riskframe.operators.skew import splittable
from riskframe.sources.schemas import require

SHARES = (0.25, 0.5, 0.75, 0.9, 0.99)
#: Bits of a value below its bin, from the coarsest bins to single values.
LEVELS = (32, 16, 0)


def _descend(targets: DataFrame, counts: DataFrame, bits: int, parent_bits: int | None) -> DataFrame:
    """Move each target from its bin to the bin of ``bits`` inside it that holds its rank."""
    parent = F.lit(0).cast("bigint") if parent_bits is None else F.shiftright("_value", parent_bits)
    bins = counts.groupBy("_key", parent.alias("_in"), F.shiftright("_value", bits).alias("_bin")).agg(F.sum("_n").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy("_key", "_in").orderBy("_bin"))
    spans = bins.select(F.col("_key").alias("_of"), F.col("_in").alias("_inside"), "_bin", (upto - F.col("_n")).alias("_from"), upto.alias("_to"))
    holds = (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))
    found = targets.join(splittable(spans), F.col("_key").eqNullSafe(F.col("_of")) & (F.col("_in") == F.col("_inside")) & holds)
    return found.select("_key", "_share", "_weight", (F.col("_rank") - F.col("_from")).alias("_rank"), F.col("_bin").alias("_in"))


def amount_percentiles(
    txns: DataFrame, shares: Sequence[float] = SHARES, *, key: str = "customer_id", amount: str = "amount"
) -> DataFrame:
    """(key, amounts, p<share>...): percentiles of each key's amounts, linear between neighbouring ranks.

    Rows without a usable amount do not count; a key that has no other rows is absent. Rows without key form one
    group. Equal amounts count as often as they occur.
    """
    require(txns, key, amount)
    values = txns.select(F.col(key).alias("_key"), cents(F.col(amount)).alias("_value")).filter("_value is not null")
    counts = values.groupBy("_key", "_value").agg(F.count(F.lit(1)).alias("_n"))
    coarser = counts.groupBy("_key", (F.shiftright("_value", LEVELS[1]) * (1 << LEVELS[1])).alias("_value")).agg(F.sum("_n").alias("_n"))
    sizes = coarser.groupBy("_key").agg(F.sum("_n").alias("_amounts"))

    # A percentile lies between two ranks; each is a target whose weight is its nearness.
    targets = []
    for i, share in enumerate(shares):
        place = (F.col("_amounts") - 1) * F.lit(float(share))
        low = F.floor(place)
        for rank, weight in ((low, low + 1 - place), (F.least(low + 1, F.col("_amounts") - 1), place - low)):
            targets.append(F.struct(F.lit(i).alias("_share"), weight.alias("_weight"), rank.cast("bigint").alias("_rank")))
    found = sizes.select("_key", F.inline(F.array(*targets))).filter("_weight > 0").withColumn("_in", F.lit(0).cast("bigint"))
    for bits, parent_bits in zip(LEVELS, (None, *LEVELS)):
        found = _descend(found, coarser if bits else counts, bits, parent_bits)

    part = F.col("_in").cast("double") * F.col("_weight") / 100.0
    names = [f"p{100 * share:g}".replace(".", "_") for share in shares]
    picked = found.groupBy("_key").agg(*[F.sum(F.when(F.col("_share") == i, part)).alias(n) for i, n in enumerate(names)])
    whole = sizes.withColumnRenamed("_key", "_of").join(picked, F.col("_of").eqNullSafe(F.col("_key")))
    return whole.select(F.col("_of").alias(key), F.col("_amounts").alias("amounts"), *names)
