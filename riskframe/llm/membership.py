"""Bloom filters: which rows can have a partner at all, asked before the rows move.

A filter has ``BITS`` bits (32 MB) at most, which tasks get with their code. A fuller filter lets more rows
through; the join that follows decides, so no row is lost at any size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import Batches, arrow_type, batch, mix64

BITS, PROBES = 2**28, 6


class Filter:
    """A Bloom filter over 64-bit hashes: ``bits`` (a power of two) and the words of 64 of them."""

    def __init__(self, bits: int, words: np.ndarray) -> None:
        self.bits, self.words = bits, words

    @staticmethod
    def places(hashes: np.ndarray, bits: int, probe: int) -> np.ndarray:
        return mix64(hashes + np.uint64(probe * 0x9E3779B97F4A7C15 % 2**64)) & np.uint64(bits - 1)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        """Places of the hashes that may be in the set."""
        at = np.arange(len(hashes))
        for probe in range(PROBES):
            if not len(at):
                break
            place = self.places(hashes[at], self.bits, probe)
            at = at[(self.words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)]
        return at


def bloom(hashes: DataFrame, n: int, most: int = BITS) -> Filter:
    """The filter of one column of distinct hashes; its words are joined by Spark, at most ``most`` / 64 of them."""
    bits = min(most, 1 << max(10, (20 * n).bit_length()))

    def run(batches: Batches) -> Batches:
        for b in batches:
            own = b.column(0).to_numpy().view(np.uint64)
            place = np.concatenate([Filter.places(own, bits, probe) for probe in range(PROBES)])
            word, bit = (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63))
            yield batch(arrow_type("word long, bit long"), (word, bit.view(np.int64)))

    words = np.zeros(bits // 64, np.uint64)
    rows = hashes.mapInArrow(run, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    words[rows.column(0).to_numpy()] = rows.column(1).to_numpy().view(np.uint64)
    return Filter(bits, words)


def may_hold(known: Filter, key: Column) -> Column:
    """Whether a 64-bit key without nulls may be in the filter; only the key goes through Python."""

    @F.arrow_udf("boolean")
    def held(keys: pa.Array) -> pa.Array:
        found = np.zeros(len(keys), bool)
        found[known.holds(keys.to_numpy().view(np.uint64))] = True
        return pa.array(found)

    return held(key)


def split(df: DataFrame, key: Column, known: Filter) -> tuple[DataFrame, DataFrame]:
    """Rows that may have a partner, and rows that have none for sure."""
    may = may_hold(known, key)
    return df.filter(may), df.filter(~may)
