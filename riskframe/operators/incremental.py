"""Entity counters and usage maps that take a batch of transactions without reading the ones before.

What is kept is one row for each (entity, customer): first and last use, uses and frauds. All of it merges by
minimum, maximum and sum, so the counters per entity and the usage map follow from it as from all transactions.
The rows are stored in buckets by entity. A batch is added up, met with the buckets that it touches, and only those
are written anew; the new version refers to the old files for all other buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.operators.entity import EntityKind
from riskframe.session import remove
from riskframe.sources.snapshots import Snapshots, Version

BUCKETS = 256

_MERGE = {"first_used": F.min, "last_used": F.max, "use_count": F.sum, "fraud_count": F.sum}


def _bucket(kind: EntityKind, buckets: int) -> Column:
    return F.pmod(F.xxhash64(kind.key), F.lit(buckets)).cast("int")


def partial_uses(txns: DataFrame, kind: EntityKind) -> DataFrame:
    """(entity, customer_id, first_used, last_used, use_count, fraud_count); a null customer is a row of its own."""
    return txns.filter(F.col(kind.key).isNotNull()).groupBy(kind.key, "customer_id").agg(
        F.min("timestamp").alias("first_used"),
        F.max("timestamp").alias("last_used"),
        F.count(F.lit(1)).alias("use_count"),
        F.count_if(F.col("is_fraud")).alias("fraud_count"),
    )


class EntityUses:
    """The stored partial aggregates of one kind of entity."""

    def __init__(self, store: Snapshots, kind: EntityKind, buckets: int = BUCKETS) -> None:
        self.store, self.kind, self.buckets = store, kind, buckets
        self.table = f"{kind.prefix}_uses"

    def add(self, txns: DataFrame, batch: str) -> Version:
        """Take in a batch; one that is already in, by its id, changes nothing."""
        before = self.store.latest()
        name = f"{self.table}:{batch}"
        if name in before.batches:
            return before
        spark = txns.sparkSession
        # The delta is written first: it is read for the touched buckets and for the merge.
        path = self.store.folder()
        partial_uses(txns, self.kind).withColumn("bucket", _bucket(self.kind, self.buckets)).write.parquet(f"{path}/delta")
        delta = spark.read.parquet(f"{path}/delta")
        touched = sorted(r["bucket"] for r in delta.select("bucket").distinct().collect())  # at most ``buckets``
        rows = delta.drop("bucket")
        if self.table in before.tables:
            rows = rows.unionByName(self.store.read(self.table, before, [str(b) for b in touched]))
        merged = rows.groupBy(self.kind.key, "customer_id").agg(*[f(c).alias(c) for c, f in _MERGE.items()])
        # Rebalancing by bucket splits large buckets and joins small ones: few files for each, none from one huge task.
        dealt = merged.withColumn("bucket", _bucket(self.kind, self.buckets)).hint("rebalance", "bucket")
        dealt.write.partitionBy("bucket").parquet(f"{path}/rows")
        remove(spark, f"{path}/delta")
        parts = dict(before.tables.get(self.table, {})) | {str(b): f"{path}/rows/bucket={b}" for b in touched}
        return self.store.commit(before, {self.table: parts}, {self.table: merged.schema.json()}, name)

    def rows(self) -> DataFrame:
        return self.store.read(self.table)

    def stats(self) -> DataFrame:
        """As ``entity.refresh_stats`` over all batches."""
        return self.rows().groupBy(self.kind.key).agg(
            F.min("first_used").alias("first_seen"),
            F.max("last_used").alias("last_seen"),
            F.sum("use_count").alias("transaction_count"),
            F.sum("fraud_count").alias("fraud_count"),
            F.count("customer_id").alias("customer_count"),
        )

    def usage(self) -> DataFrame:
        """As ``entity.usage_map`` over all batches."""
        return self.rows().filter("customer_id is not null").select("customer_id", self.kind.key, "first_used", "last_used", "use_count")
