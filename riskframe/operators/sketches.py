"""Distinct counts over any span of days, from sketches that merge.

A sketch stands for the different values of one key and day; those of several days unite to that of the span without
the rows behind them, so a new day is added without reading the old ones. Several columns take one aggregate each
in a single pass, where exact distinct counts make a copy of every row for each column.

Sketches are HyperLogLog with 2^``SIZE`` registers. A few hundred values and fewer are counted nearly exactly; beyond, the
standard error is at most 1.04 / sqrt(2^SIZE), 1.6 % for the default, and of a million estimates about one errs by
five times that (:func:`error_bound`).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIZE = 12
DAY = "day"


def error_bound(count: Column, size: int = SIZE) -> Column:
    """Five standard errors of an estimate of ``count`` values, at least one value."""
    return F.greatest(F.lit(1.0), count * F.lit(5 * 1.04 / 2 ** (size / 2)))


def daily_sketches(rows: DataFrame, key: str, counted: Mapping[str, str], time: str = "timestamp", size: int = SIZE) -> DataFrame:
    """(key, ``day``, ``row_count``, one sketch for each of ``counted``: output name -> column).

    Nulls are not counted; a column of nulls gives an empty sketch. Rows without key are left out, those without time
    have a null day, which belongs to no bounded span.
    """
    sketches = [F.hll_sketch_agg(F.col(column), F.lit(size)).alias(name) for name, column in counted.items()]
    day = F.to_date(time).alias(DAY)
    return rows.filter(F.col(key).isNotNull()).groupBy(key, day).agg(F.count(F.lit(1)).alias("row_count"), *sketches)


def merged(sketches: DataFrame, key: str) -> DataFrame:
    """Sketches of one (key, day) from several loads united into one row."""
    names = [c for c in sketches.columns if c not in (key, DAY, "row_count")]
    return sketches.groupBy(key, DAY).agg(F.sum("row_count").alias("row_count"), *[F.hll_union_agg(n).alias(n) for n in names])


def distinct_between(sketches: DataFrame, key: str, first: Column | None = None, last: Column | None = None) -> DataFrame:
    """(key, ``row_count``, one estimate for each sketch) over the days from ``first`` to ``last``, both included.

    Without bounds all days count. Keys without a row in the span are absent.
    """
    names = [c for c in sketches.columns if c not in (key, DAY, "row_count")]
    within = sketches
    if first is not None:
        within = within.filter(F.col(DAY) >= first)
    if last is not None:
        within = within.filter(F.col(DAY) <= last)
    estimates = [F.hll_sketch_estimate(F.hll_union_agg(n)).alias(n) for n in names]
    return within.groupBy(key).agg(F.sum("row_count").alias("row_count"), *estimates)
