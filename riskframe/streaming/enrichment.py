"""Enrichment of a stream from tables that change: each row meets the version that held at its time.

The versions of a key are one row: its scores in order of the time from which they hold. A row so meets one partner,
however many versions there are, and takes the last score that is not later than itself.

Streams are planned without adaptive splitting, so hot keys are dealt with in the plan: rows without a key
are spread by their id, and rows of a listed popular key over ``salts`` copies of that key's row. Any other key
has one copy. The list is broadcast, hence bounded; what is not in it is joined whole, with the same result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.plans.views import UNMAPPED_RISK

MOST_POPULAR = 100_000
_NULL_SALTS = 1 << 16


def histories(versions: DataFrame, key: str, score: str, valid_from: str = "valid_from") -> DataFrame:
    """(key, ``history``): the scores of each key by the time from which they hold.

    A null score ends the one before: the key is unknown from then on. Of several scores for one time the greatest
    holds, null last. Rows without key or time are left out. The array has one entry for each version of the key.
    """
    one = versions.filter(F.col(key).isNotNull() & F.col(valid_from).isNotNull()).groupBy(key, valid_from).agg(F.max(score).alias("score"))
    entry = F.struct(F.col(valid_from).alias("since"), F.col("score"))
    return one.groupBy(key).agg(F.array_sort(F.collect_list(entry)).alias("history"))


def popular_keys(rows: DataFrame, key: str, hot_rows: int) -> DataFrame:
    """Keys with more than ``hot_rows`` of ``rows``, at most ``MOST_POPULAR`` of them, the largest."""
    counts = rows.filter(F.col(key).isNotNull()).groupBy(key).count().filter(F.col("count") > hot_rows)
    return counts.orderBy(F.desc("count"), key).limit(MOST_POPULAR).select(key)


@dataclass(frozen=True)
class Lookup:
    """``history`` as from :func:`histories`; the score goes to column ``output``, ``default`` where none holds."""

    history: DataFrame
    key: str
    output: str
    popular: DataFrame | None = None
    default: float = UNMAPPED_RISK


def enriched_as_of(
    rows: DataFrame, lookups: Sequence[Lookup], *, time: str = "timestamp", row_id: str = "transaction_id", salts: int = 64
) -> DataFrame:
    """``rows`` (a stream or a table) with one score for each lookup, as of the row's time.

    A row without key or time gets the default. Every row comes out once.
    """
    outputs = [lookup.output for lookup in lookups]
    found = rows
    for lookup in lookups:
        key = lookup.key
        spread = F.xxhash64(row_id)
        salt = F.when(F.col(key).isNull(), F.pmod(spread, F.lit(_NULL_SALTS)))
        held = lookup.history.select(F.col(key), F.col("history").alias("_history"))
        if lookup.popular is None:
            held = held.withColumn("_salt", F.lit(0).cast("bigint"))
        else:
            listed = F.broadcast(lookup.popular.select(key).distinct().withColumn("_popular", F.lit(True)))
            found = found.join(listed, key, "left")
            salt = salt.when(F.col("_popular"), F.pmod(spread, F.lit(salts)))
            copies = F.when(F.col("_popular"), F.lit(salts)).otherwise(F.lit(1)).cast("bigint")
            held = held.join(listed, key, "left").select(key, "_history", F.explode(F.sequence(F.lit(0).cast("bigint"), copies - 1)).alias("_salt"))
        past = F.filter("_history", lambda h: h["since"] <= F.col(time))
        found = (
            found.withColumn("_salt", salt.otherwise(F.lit(0)).cast("bigint"))
            .join(held, [key, "_salt"], "left")
            .withColumn(lookup.output, F.coalesce(F.get(past, F.size(past) - 1)["score"], F.lit(lookup.default)))
            .drop("_salt", "_history", "_popular")
        )
    return found.select(*[c for c in rows.columns if c not in outputs], *outputs)
