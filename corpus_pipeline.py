"""From raw documents to packed training sequences, in five stages.

Each stage reads what its predecessor wrote and returns the columns of ``documents``; the last returns
token pieces with their places in sequences.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from riskframe.llm import mixing, packing, quality, simhash, substrings
from riskframe.llm.common import short_batches, table
from riskframe.session import remove, scratch, staged, work_path

Step = Callable[[SparkSession, DataFrame, str], DataFrame]

_done: list[str] = []


def tidy(first: bool = False) -> Callable[[Step], Step]:
    """A step that removes what the step before it has staged on the way.

    A step's ``docs`` are the stored rows of the step before, so nothing reads that any more. One pipeline runs at
    a time in a Python process; what the last step staged stays, since its result is read after it returns.
    """

    def around(step: Step) -> Step:
        @wraps(step)
        def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            short_batches(spark)
            if not first:
                for folder in _done:
                    remove(spark, folder)
            _done.clear()
            with scratch(spark, step.__name__) as folder:
                _done.append(folder)
                return step(spark, docs, sf_dir)

        return run

    return around


@tidy(first=True)
def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts.

    Null and empty texts are scored like any other, repeated rows alike; a table without labels or rows is fine.
    """
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


@tidy()
def near_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the least id, a null id last; rows without words stay."""
    return simhash.keep_one(docs)


@tidy()
def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that also stand elsewhere; every row stays, a null text null."""
    return substrings.deduplicate(docs)


@tidy()
def to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them; repeated rows share their fate, a null source is one."""
    return mixing.mixed(docs)


@tidy()
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences; a null text is an empty document of one token."""
    return packing.pack_documents(docs, with_ids=False)


STAGES = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", near_distinct),
    ("substring dedup", without_repeats),
    ("mixing sources to target weights", to_weights),
    ("best-fit packing", packed),
]

ORACLE_SQL = None  # a learned classifier, fingerprints and token ids are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage's rows are written and read again, and go when the next are stored."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, step in STAGES[:-1]:
        path = work_path(spark, name.replace(" ", "-"))
        docs = staged(step(spark, docs, sf_dir), path)
        if before:
            remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
